"""Exact fingerprints of canonical texts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import materialise, with_uid


def canonical(text: Column) -> Column:
    """NFC, full case folding, NFC again; runs of Unicode white space become one space, ends trimmed."""
    nfc = lambda c: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    fold = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), nfc(text), F.lit(True))
    return F.trim(F.regexp_replace(nfc(fold), r"[\s\x{85}\p{Z}]+", " "))


def wide_hash(canon: Column, words: int = 2) -> Column:
    """words * 64 bits of xxhash, each under its own seed, in lower-case hex."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(n), canon)), 16, "0") for n in range(words)]))


def next_documents(ids: DataFrame, partitions: int) -> DataFrame:
    """(uid, next_uid) for a table with unique uid: the next lower uid; after the lowest, the highest.

    Ids are dealt out by ranges; each range looks one row back, and one row per range closes the gaps.
    """
    ranged = ids.select("uid").repartitionByRange(partitions, "uid").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    within = Window.partitionBy("part").orderBy("uid")
    tops = ranged.groupBy("part").agg(F.max("uid").alias("top"))
    around = Window.orderBy("part")  # one row for each range
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select(
        "part", F.coalesce(F.lag("top").over(around), F.max("top").over(everything)).alias("below")
    )
    return (
        ranged.withColumn("prev", F.lag("uid").over(within))
        .join(F.broadcast(tops), "part")  # as many rows as ranges
        .select("uid", F.coalesce("prev", "below").alias("next_uid"))
    )


def group_exactly(rows: DataFrame) -> DataFrame | None:
    """Byte comparison inside equal buckets: rows (fp, canon) of buckets with two rows or more.

    None where all texts of each bucket are equal; else (fp, canon, nth) for the buckets that hold
    different texts, nth from 0 in the order of the texts.
    """
    ends = rows.groupBy("fp").agg(F.min("canon").alias("lo"), F.max("canon").alias("hi"))
    clash = ends.where("lo <> hi").select("fp")
    if clash.isEmpty():
        return None
    texts = rows.join(clash, "fp", "left_semi").select("fp", "canon").distinct()
    return texts.withColumn("nth", F.row_number().over(Window.partitionBy("fp").orderBy("canon")) - 1)


def fingerprint_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 2, partitions: int | None = None
) -> DataFrame:
    """Fingerprint of every whole text, of its edited text, and how alike they and the next text are.

    A fingerprint is the wide xxhash of the canonical text; documents that share one are compared byte
    by byte, and a bucket that holds different texts is told apart by a suffix. So documents with equal
    fingerprints have equal canonical texts, and an exact digest knows no degrees: likeness is 1.0 or
    0.0. An edited text is compared with its own document byte by byte.

    The edited text is the text with its last floor(n_chars / 3) code points replaced by the first as
    many (or all) of the next document, in descending id order; after the last comes the first.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts cross the network once, by id, and the heads of next texts once; only canonical texts whose
    hash occurs twice or more (narrow rows tell) are then grouped, with partial aggregation.

    Null texts count as empty. Null ids come after all others; rows with equal ids stand in descending order of a hash of
    their texts, and each row is a document. A text may be as long as a task's memory holds a few times. A single row is its own next document. An empty table gives
    no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    partitions = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = with_uid(docs, id_col, text_col)
    prints = materialise(
        rows.select(
            "uid",
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            wide_hash(canonical(F.col("text")), words).alias("fp"),
        ),
        "prints",
    )
    # Written, so that a fingerprint of very many copies can be split in the join below.
    shared = prints.groupBy("fp").count().where("count > 1").select("fp", F.lit(True).alias("shared"))
    shared = materialise(shared, "shared")
    nexts = prints.select(F.col("uid").alias("next_uid"), F.col("fp").alias("next_fp"))
    facts = materialise(
        prints.join(next_documents(prints, partitions), "uid")
        .join(shared, "fp", "left")
        .join(nexts, "next_uid")
        .select("uid", "doc_id", "n_chars", "fp", "next_uid", "next_fp", F.coalesce("shared", F.lit(False)).alias("shared")),
        "facts",
    )
    texts = rows.select("uid", "text")
    heads = (
        facts.select(F.col("uid").alias("of"), F.col("next_uid").alias("uid"), F.expr("CAST(n_chars div 3 AS int)").alias("k"))
        .join(texts, "uid")
        .select(F.col("of").alias("uid"), F.expr("substring(text, 1, k)").alias("head"))
    )
    edited = F.expr("concat(substring(text, 1, CAST(n_chars - n_chars div 3 AS int)), head)")
    out = materialise(
        texts.join(heads, "uid")
        .join(facts, "uid")
        .withColumn("edited", edited)
        .select(
            "*", canonical(F.col("text")).alias("canon"), canonical(F.col("edited")).alias("canon_edited")
        )
        .select(
            "uid",
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "fp",
            wide_hash(F.col("canon_edited"), words).alias("edited_fp"),
            (F.col("canon") == F.col("canon_edited")).alias("same"),
            "next_uid",
            "next_fp",
            F.when(F.col("shared"), F.col("canon")).alias("canon"),
        ),
        "edited",
    )
    nth = group_exactly(out.where("canon is not null").select("fp", "canon"))
    if nth is not None:
        named = F.when(F.col("nth") > 0, F.concat("fp", F.lit("-"), F.col("nth"))).otherwise(F.col("fp"))
        out = out.join(nth, ["fp", "canon"], "left").withColumn("fp", named).drop("nth", "next_fp")
        out = materialise(out, "named")
        out = out.join(out.select(F.col("uid").alias("next_uid"), F.col("fp").alias("next_fp")), "next_uid")
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("fp").alias("fingerprint"),
        F.when(F.col("same"), F.col("fp")).otherwise(F.col("edited_fp")).alias("edited_fingerprint"),
        one(F.col("same")).alias("near_edited"),
        one(F.col("fp") == F.col("next_fp")).alias("near_next"),
    )
