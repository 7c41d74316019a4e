"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.bpe import encode_decode
from docloom.llm import lexical, licenses, negatives, quality, urls
from docloom.llm.fingerprints import fingerprint_documents
from docloom.llm.html import extract_main_text
from docloom.llm.lines import dedup_lines
from docloom.llm.near import near_components
from docloom.llm.neighbours import nearest_neighbours
from docloom.llm.packing import pack_sequences
from docloom.llm.suffixes import remove_repeats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_sequences(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "place", "license", F.round("dice", 6).alias("dice"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(rows.withColumn("label", moved), "vec_id % 50 = 0")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_lines": op3_lines,
    "op4_fingerprints": op4_fingerprints,
    "op5_bpe": op5_bpe,
    "op6_html": op6_html,
    "op7_suffixes": op7_suffixes,
    "op8_near": op8_near,
    "op9_urls": op9_urls,
    "op10_licenses": op10_licenses,
    "op11_neighbours": op11_neighbours,
    "op12_negatives": op12_negatives,
    "op13_lexical": op13_lexical,
}
ORACLE_SQL: dict[str, str] = {
    "op2_quality": quality.ORACLE_SQL,
    "op9_urls": urls.ORACLE_SQL,
    "op10_licenses": licenses.oracle_sql(),
    "op12_negatives": negatives.ORACLE_SQL,
    "op13_lexical": lexical.ORACLE_SQL,
}
