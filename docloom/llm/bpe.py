"""Encoding and decoding of whole texts with word_bpe_49k."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.tokens import WordBpe


def encode_decode(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, leaf: int = 16
) -> DataFrame:
    """Encode every text and decode its ids again.

    Rows: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded (string). Long text
    without a place to cut is encoded by tree concatenation, see WordBpe. One pass without a shuffle;
    a row needs memory in proportion to its own text.

    Null texts count as empty: no ids, decoded "". Null and repeated ids are passed on, a row for each
    row. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def code(batches):
        bpe = WordBpe(tokenizer, leaf)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = [bpe.encode_decode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // 4 for x, _ in pairs], pa.int64()),
                        pa.array([x for x, _ in pairs], pa.binary()),
                        pa.array([y for _, y in pairs], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(code, "doc_id long, n_tokens long, ids binary, decoded string")
