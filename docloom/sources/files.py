"""File scans, record sources and sinks."""

from __future__ import annotations

import os
import re
import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docloom.functions import text as T
from docloom.schemas import CORPUS, INVENTORY, LLM_METADATA
from docloom.sources.parsers import ParserRegistry
from docloom.sources.record_files import last_of_each

SUFFIXES = (".pdf", ".docx", ".msg")
#: Files of records: what the writers below make, and what others call such files.
RECORDS = "*.json{,l}"


def pattern_of(suffixes: tuple[str, ...], any_case: bool = False) -> str:
    each = [s.lstrip(".") for s in suffixes]
    if any_case:
        each = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s) for s in each]
    return "*.{" + ",".join(each) + "}"


def local_path(path):
    """Paths without a scheme, as the caller gave them."""
    return F.regexp_replace(path, r"^file:(//)?", "")


#: Paths of a batch, and bytes of content after which a batch is sent on.
NAMES, BYTES = 4096, 4 << 20


def glob_of(pattern: str) -> re.Pattern:
    """A file system's glob of names, with braces, as a regular expression."""
    out, at, depth = "", 0, 0
    while at < len(pattern):
        c, end = pattern[at], pattern.find("]", at + 2)
        if c == "[" and end > 0:
            inner, at = pattern[at + 1 : end], end
            out += "[" + ("^" + inner[1:] if inner[0] in "!^" else inner) + "]"
        elif c == "\\" and at + 1 < len(pattern):
            at += 1
            out += re.escape(pattern[at])
        else:
            depth += (c == "{") - (c == "}")
            known = {"*": ".*", "?": ".", "{": "(?:", "}": ")"} | ({",": "|"} if depth else {})
            out += known.get(c, re.escape(c))
        at += 1
    return re.compile(out, re.DOTALL)


def names_below(folder: str, fits: re.Pattern, recursive: bool) -> Iterator[str]:
    """Paths of files below a local folder; what begins with a dot or a line is hidden, as Spark's readers have it."""
    open_folders = [folder]
    while open_folders:
        with os.scandir(open_folders.pop()) as found:
            for f in found:
                if f.name[0] == "." or (f.name[0] == "_" and "=" not in f.name) or f.name.endswith("._COPYING_"):
                    continue
                if f.is_dir():
                    open_folders += [f.path] if recursive else []
                elif fits.fullmatch(f.name):
                    yield f.path


def listing(folder: str, fits: re.Pattern, recursive: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = []
        for batch in batches:
            for name in names_below(folder, fits, recursive) if batch.num_rows else ():
                some.append(name)
                if len(some) == NAMES:
                    yield pa.RecordBatch.from_arrays([pa.array(some)], names=["path"])
                    some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some)], names=["path"])

    return task


def reading(content: bool):
    """Rows (path) with length and time of change, and the bytes where they are asked for; a batch is a few MB, or one file."""
    shape = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())] + [("content", pa.binary())] * content)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                about = os.stat(path)
                row = (f"file:{path}", about.st_mtime_ns // 1_000_000 * 1000, about.st_size)
                if content:
                    with open(path, "rb") as f:
                        row = (*row, f.read())
                    held += len(row[3])
                rows.append(row)
                if held >= BYTES or len(rows) == NAMES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), shape.types)], schema=shape)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), shape.types)], schema=shape)

    return task


def local_folder(spark: SparkSession, root: str) -> str | None:
    """root as a path of the local file system, if it is a folder there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        return None
    plain = os.path.abspath(path.toUri().getPath())
    return plain if os.path.isdir(plain) else None


def scan(spark: SparkSession, root: str, pattern: str, content: bool = True, recursive: bool = True) -> DataFrame:
    """Files below root whose names fit: path, modificationTime, length and content, as Spark's binary files have them.

    A folder of a local file system, which all machines see, is listed by one task and its names dealt to as many as there are
    shuffle partitions: the driver holds no list of files, and small files don't make a task for a few of them each.
    Other places are listed by Spark's reader, on the driver.
    """
    folder = local_folder(spark, root)
    if folder is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern)
        return reader.load(root) if content else reader.load(root).drop("content")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    names = spark.range(1, numPartitions=1).mapInArrow(listing(folder, glob_of(pattern), recursive), "path string").repartition(n, "path")
    return names.mapInArrow(reading(content), "path string, modificationTime timestamp, length long" + ", content binary" * content)


def ingest(spark: SparkSession, root: str, suffixes: tuple[str, ...] = SUFFIXES, any_case: bool = False) -> DataFrame:
    """Files below root: path, size_bytes, modified_ts, content."""
    files = scan(spark, root, pattern_of(suffixes, any_case))
    return files.select(
        local_path(F.col("path")).alias("path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_ts"),
        "content",
    )


def all_files(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Every file with a dot in its name."""
    files = scan(spark, root, "*.*", content)
    return files.withColumn("path", local_path(F.col("path")))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, suffix, size_bytes, modified, error of every file with a dot; folders aren't listed."""
    return all_files(spark, root, content=False).select(
        "path",
        T.suffix(F.col("path")).alias("suffix"),
        F.col("length").alias("size_bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("modified"),
        F.lit(None).cast("string").alias("error"),
    ).to(spark.createDataFrame([], INVENTORY).schema)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def snippets(files: DataFrame, read_bytes: int = 50_000, chars: int = 800) -> DataFrame:
    """The first characters of each file as text; malformed bytes are left out, unreadable files empty."""
    head = F.make_valid_utf8(F.substring("content", 1, read_bytes).cast("string"))
    text = F.substring(F.replace(head, F.lit("\ufffd"), F.lit("")), 1, chars)
    return files.withColumn("snippet", F.coalesce(text, F.lit(""))).drop("content")


def parse(files: DataFrame, registry: ParserRegistry | None = None, keep_content: bool = False) -> DataFrame:
    """Adds text, subject, error and seconds. One pass; a file that fails has an error and no text."""
    registry = registry or ParserRegistry()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, subjects, errors, seconds = [], [], [], []
            for path, content in zip(b["path"], b["content"]):
                began = time.perf_counter()
                try:
                    name = path.rsplit("/", 1)[-1]
                    found = registry.get("." + name.rpartition(".")[2] if "." in name else "").parse(content)
                    texts.append(found["text"])
                    subjects.append(found.get("subject"))
                    errors.append(None)
                except Exception as e:
                    texts.append(None)
                    subjects.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
                seconds.append(time.perf_counter() - began)
            rest = b if keep_content else b.drop(columns="content")
            yield rest.assign(text=texts, subject=subjects, error=errors, seconds=seconds)

    kept = files.select("path", "size_bytes", "modified_ts", "content")
    content = "content binary, " if keep_content else ""
    return kept.mapInPandas(run, f"path string, size_bytes long, modified_ts timestamp, {content}text string, subject string, error string, seconds double")


def read_jsonl(spark: SparkSession, path: str, recursive: bool = False, pattern: str = RECORDS) -> DataFrame:
    """Corpus records with path and _corrupt (the text of a line that is no record)."""
    reader = (
        spark.read.schema(CORPUS + ", _corrupt string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("pathGlobFilter", pattern)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path).withColumn("path", local_path(F.col("_metadata.file_path")))


def read_record_files(spark: SparkSession, path: str, recursive: bool = False, pattern: str = RECORDS) -> DataFrame:
    """What read_jsonl() reads, of a folder with very many small files: they are read whole, by scan()."""
    files = scan(spark, path, pattern, recursive=recursive)
    lines = files.select(local_path(F.col("path")).alias("path"), F.explode(F.split(F.col("content").cast("string"), "\r\n|\n|\r")).alias("line"))
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    records = lines.where(F.trim("line") != "").select("path", F.from_json("line", CORPUS + ", _corrupt string", how).alias("r"))
    return records.select("r.*", "path")


def write_jsonl(docs: DataFrame, path: str, seq_col: str | None = None, append: bool = False) -> None:
    """Corpus records, one a line. With seq_col, of records with equal hash_sha1 only the last is written."""
    if seq_col:
        docs = last_of_each(docs, "hash_sha1", seq_col).drop(seq_col)
    docs.write.mode("append" if append else "overwrite").json(path)


def read_ground_truth(spark: SparkSession, path: str, clean: bool = False) -> DataFrame:
    """(query, expected_doc_id), trimmed; rows with either blank leave. clean also drops stray quotes in ids."""
    rows = spark.read.option("header", "true").option("escape", '"').csv(path)
    wanted = F.col("expected_doc_id")
    rows = rows.select(T.strip(F.col("query")).alias("query"), T.strip(F.regexp_replace(wanted, '"', "") if clean else wanted).alias("expected_doc_id"))
    return rows.where(~T.blank(F.col("query")) & ~T.blank(F.col("expected_doc_id")))


def with_point_ids(truth: DataFrame) -> DataFrame:
    """Ground truth whose content hashes became point ids."""
    return truth.withColumn("expected_doc_id", T.expected_id(F.col("expected_doc_id")))


def sorted_files(spark: SparkSession, root: str, pattern: str = RECORDS) -> DataFrame:
    """Paths of matching files below root in order; no file is opened."""
    return scan(spark, root, pattern, content=False).select(local_path(F.col("path")).alias("path")).orderBy("path")


def load_raw_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata records of a folder of JSON files, one record or a list of them each, or a record a line; with their file."""
    each = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", RECORDS).text(folder, wholetext=True)
    shape = StructType.fromDDL(LLM_METADATA).simpleString()
    whole = F.trim("value")
    listed = F.when(whole.startswith("["), F.from_json(whole, f"array<{shape}>"))
    boxed = F.concat(F.lit("["), whole, F.lit("]"))
    one = F.when(F.json_array_length(boxed) == 1, F.from_json(boxed, f"array<{shape}>"))
    lines = F.transform(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != ""), lambda x: F.from_json(x, shape))
    rows = each.select(local_path(F.col("_metadata.file_path")).alias("path"), F.explode(F.coalesce(listed, one, lines)).alias("r"))
    return rows.select("path", "r.*")


def save_ground_truth(truth: DataFrame, path: str) -> None:
    """Ground truth whose content hashes became point ids, as CSV."""
    write_csv(with_point_ids(truth), path)
