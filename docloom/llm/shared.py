"""What the operators of this subpackage share: row keys, and tables written in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.scratch import BATCH_BYTES, drop_table, small_batches, written  # noqa: F401  the first three are for the operators


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """task, after which its worker gives freed memory back: workers live on and serve other operators."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            import ctypes
            import ctypes.util

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(ctypes.util.find_library("c") or None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there.

    Hadoop deletes the table when the session ends, drop_table() before.
    """
    return written(df, label)


def with_uid(df: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """Rows as (uid long, doc_id, text string): uid is unique, not null, and ordered as doc_id.

    Where id_col has neither nulls nor repeats it is the uid. Otherwise each row is a document of its
    own: rows are ordered by (id, nulls first; hash of the text; text) with a range shuffle and numbered, so that many
    rows of one id spread; whole repeats stand beside each other in any order, which no result can show. With carry, a
    column row holds all columns of df but the text, whatever their names.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row")] if carry else []),
    )
    ids = rows.groupBy("doc_id").count()
    odd = ids.where("doc_id is null or count > 1").limit(1).count()
    if not odd:
        return rows.select(F.col("doc_id").alias("uid"), "*")
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"
    )
    return materialise(ranged.select(F.monotonically_increasing_id().alias("uid"), "*"), "uid")
