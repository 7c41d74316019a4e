"""Per-document operators: enrichment columns, duplicates, quality flags, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def enrich(docs: DataFrame, text_col: str = "text", mode: str = "intended") -> DataFrame:
    """Adds hash_sha1, token_estimate and pii_risk of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumns({"hash_sha1": F.sha1(text), "token_estimate": T.token_estimate(text)})
    return counted.withColumn("pii_risk", T.pii_risk(text, mode, F.col("token_estimate")))


def quality_flags(docs: DataFrame, max_bytes: int = 8_000_000, max_lines: int = 1000, text_col: str = "text") -> DataFrame:
    """Adds size_bytes_text, line_count and requires_split (over either limit)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns(
        {
            "size_bytes_text": T.size_bytes_text(text),
            "line_count": T.line_count(text),
            "requires_split": T.requires_split(text, max_bytes, max_lines),
        }
    )


def copies(docs: DataFrame, hash_col: str, seq_col: str) -> DataFrame:
    """One row for each content: first and last place and how often; partial sums keep hot contents cheap."""
    return docs.groupBy(hash_col).agg(
        F.min(seq_col).alias("first_seq"), F.max(seq_col).alias("last_seq"), F.count("*").alias("n_copies")
    )


def flag_duplicates(docs: DataFrame, seq_col: str, text_col: str = "text") -> DataFrame:
    """Adds hash_content and is_duplicate: true for all but the first row of equal text, by seq_col.

    seq_col must be unique. The aggregate runs on (hash, seq) alone and is joined back, so a content held by
    a third of all rows is summed where it lies and its rows can be split.
    """
    marked = docs.withColumn("hash_content", F.sha1(F.coalesce(F.col(text_col), F.lit(""))))
    seen = copies(marked, "hash_content", seq_col)
    return (
        marked.join(seen, "hash_content")
        .withColumn("is_duplicate", F.col(seq_col) > F.col("first_seq"))
        .drop("first_seq", "last_seq", "n_copies")
    )


def keep_first(docs: DataFrame, seq_col: str, text_col: str = "text") -> DataFrame:
    return flag_duplicates(docs, seq_col, text_col).where("not is_duplicate").drop("is_duplicate")


def keep_last(docs: DataFrame, seq_col: str, text_col: str = "text") -> DataFrame:
    """Last writer wins: the last row of each text; is_duplicate tells that there were others."""
    marked = docs.withColumn("hash_content", F.sha1(F.coalesce(F.col(text_col), F.lit(""))))
    seen = copies(marked, "hash_content", seq_col)
    return (
        marked.join(seen, "hash_content")
        .where(F.col(seq_col) == F.col("last_seq"))
        .withColumn("is_duplicate", F.col("n_copies") > 1)
        .drop("first_seq", "last_seq", "n_copies")
    )


def chunks(docs: DataFrame, size: int = 450, overlap: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows of size words that share overlap words with the next: (id, idx, start, n_words, chunk).

    The last chunk is the one that reaches the end; blank text has none.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")
    w = T.words(F.coalesce(F.col(text_col), F.lit("")))
    step = size - overlap
    rows = docs.select(F.col(id_col), w.alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - overlap - 1, F.lit(0)), F.lit(step))
    parts = rows.select(id_col, "_w", F.posexplode(starts).alias("idx", "start"))
    piece = F.slice("_w", F.col("start") + 1, size)
    return parts.select(
        id_col, "idx", "start", F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("chunk")
    )


def payload(docs: DataFrame) -> Column:
    """What search returns of a point: fixed fields, each with a default for what is missing."""
    from docloom.schemas import PAYLOAD

    fields = []
    for field in PAYLOAD.split(", "):
        name, kind = field.split(": ")
        default = F.array() if kind.startswith("array") else F.lit({"string": "", "boolean": False}.get(kind, 0))
        value = F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)
        fields.append(F.coalesce(value, default.cast(kind)).alias(name))
    return F.struct(*fields)


def prepare_points(docs: DataFrame, path_col: str = "path") -> DataFrame:
    """Rows ready for embedding: id, text, summary, payload. Blank texts are dropped.

    A blank summary becomes the text's start; source becomes the path of the file that held the record.
    """
    kept = docs.where(~T.blank(F.col("text")))
    summary = F.col("summary") if "summary" in docs.columns else F.lit(None).cast("string")
    hashes = F.col("hash_content") if "hash_content" in docs.columns else F.lit(None).cast("string")
    kept = kept.withColumns({"summary": T.summary_or_preview(summary, F.col("text")), "source": F.col(path_col)})
    return kept.select(
        T.point_id(hashes, F.col(path_col)).alias("id"), "text", "summary", payload(kept).alias("payload")
    )
