"""Corpus preparation: quality rules, line dedup, near dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that the next stage reads. All but the last
return the columns of documents. Null ids and repeated rows are documents of their own throughout;
n_chars follows the text; a null text, which the quality rules reject, would come back empty. Other columns, whatever
their names, are passed on as they are. An empty table gives an empty table at every stage. A text may be as long as a
task's memory holds a few times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.lines import dedup_lines
from docloom.llm.near import near_components
from docloom.llm.packing import pack_sequences
from docloom.llm.quality import keep_good
from docloom.llm.shared import materialise
from docloom.llm.suffixes import remove_repeats


def restored(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs: the text found and its length, the rest from the struct row."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that resemble an earlier line."""
    return restored(dedup_lines(docs, carry=True), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return restored(near_components(docs, carry=True).where("kept"), docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated passages. Bytes left of a cut character go with it."""
    return restored(remove_repeats(docs, carry=True), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row for each piece of a document."""
    return pack_sequences(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("passage_dedup", passages),
    ("packing", packing),
]

#: SQL has no way to express packing with a public tokenizer, nor sketches: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
