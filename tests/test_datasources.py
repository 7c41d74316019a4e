"""A file for each record, and the stream of a folder's changes."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from docloom.sources import files as S
from docloom.sources.record_files import last_of_each, write_files, write_record_files
from docloom.streaming.changes import current_files, watch_changes


def files_of(path):
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_a_file_for_each_record(spark, tmp_path):
    rows = [("a", 1, "old", ["x"]), ("a", 2, "žltý", []), ("b", 1, "two", None), (None, 1, "nameless", None), ("c/d", 1, "odd", None)]
    docs = spark.createDataFrame(rows, "hash_sha1 string, seq int, text string, tags array<string>").repartition(3)
    out = str(tmp_path / "out")
    write_record_files(docs, out, "seq")
    assert files_of(out) == [".jsonl", "a.jsonl", "b.jsonl", "c%2Fd.jsonl"]
    assert (tmp_path / "out" / "a.jsonl").read_text(encoding="utf-8") == '{"text":"žltý","tags":[]}\n'
    assert {r.text for r in S.read_jsonl(spark, out).collect()} == {"žltý", "two", "odd"}  # a file that begins with a dot is hidden
    write_record_files(docs.where("text = 'two'").withColumn("text", F.lit("three")), out, "seq")
    assert len(files_of(out)) == 4 and json.loads((tmp_path / "out" / "b.jsonl").read_text()) == {"text": "three"}
    write_record_files(docs.where("text = 'two'"), out, "seq", overwrite=True)
    assert files_of(out) == ["b.jsonl"]
    write_record_files(docs.limit(0), out, "seq")
    assert files_of(out) == ["b.jsonl"]


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    out = str(tmp_path / "out")
    write_record_files(spark.createDataFrame([("kept", "x")], "hash_sha1 string, text string"), out)
    docs = spark.range(40, numPartitions=4).select(F.col("id").cast("string").alias("hash_sha1"), F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise("t").alias("text"))
    for overwrite in (False, True):
        with pytest.raises(Exception, match="lost"):
            write_record_files(docs, out, overwrite=overwrite)
        assert files_of(out) == ["kept.jsonl"]


def test_the_last_of_each(spark):
    docs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, seq int, text string")
    got = sorted(map(tuple, last_of_each(docs, "k", "seq").select("k", "seq").collect()), key=str)
    assert got == [("a", 2), ("b", None)]
    assert last_of_each(docs, "k", "seq").collect() == last_of_each(docs.repartition(3), "k", "seq").collect()


def test_changes_of_a_folder(spark, tmp_path):
    root, state, check, out = (tmp_path / x for x in ("in", "state", "check", "out"))
    (root / "deep").mkdir(parents=True)

    def run():
        rows = watch_changes(spark, str(root), str(state), content=True)

        def write(batch, number):
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(str(out))

        q = rows.writeStream.foreachBatch(write).option("checkpointLocation", str(check)).trigger(availableNow=True).start()
        assert q.awaitTermination(120)

    def seen():
        rows = spark.read.parquet(str(out)).collect() if out.exists() else []
        return sorted((r.batch, r.path.rsplit("/", 1)[1], r.change, r.size_bytes, None if r.content is None else bytes(r.content).decode()) for r in rows)

    (root / "a.pdf").write_text("one")
    (root / "deep" / "b.DOCX").write_text("two")
    (root / "c.txt").write_text("no")
    (root / "_hidden.pdf").write_text("no")
    run()
    first = [(0, "a.pdf", "added", 3, "one"), (0, "b.DOCX", "added", 3, "two")]
    assert seen() == first
    run()  # nothing has happened
    assert seen() == first
    # While no query runs: one file changes, one goes, one comes.
    (root / "a.pdf").write_text("longer")
    (root / "deep" / "b.DOCX").unlink()
    (root / "d.msg").write_text("new")
    run()
    second = [(1, "a.pdf", "changed", 6, "longer"), (1, "b.DOCX", "deleted", None, None), (1, "d.msg", "added", 3, "new")]
    assert seen() == first + second
    run()  # the deleted file was seen once
    assert seen() == first + second
    for n in range(8):
        (root / "a.pdf").write_text("x" * n)
        os.utime(root / "a.pdf", (time.time(), 1000 + n))
        run()
    assert len(seen()) == 13 and len(files_of(str(state))) <= 6
    there = current_files(spark.read.parquet(str(out)))
    assert sorted((r.path.rsplit("/", 1)[1], r.size_bytes) for r in there.collect()) == [("a.pdf", 7), ("d.msg", 3)]


def test_the_driver_holds_no_list_of_files(spark, tmp_path):
    """Files are moved and listed by tasks; a scan has as many tasks as there are shuffle partitions, and finds what Spark's reader finds."""
    rows = spark.range(500, numPartitions=3).select(F.concat(F.lit("n"), "id").alias("name"), F.col("id").cast("string").alias("value"))
    root = str(tmp_path / "in")
    write_files(rows, root, ".pdf")
    assert len(files_of(root)) == 500 and (tmp_path / "in" / "n7.pdf").read_text() == "7\n"
    (tmp_path / "in" / "deep").mkdir()
    for name in ("deep/x.docx", "deep/_y.docx", "z.PDF", ".pdf", "n 1%2F.pdf", "other.txt"):
        (tmp_path / "in" / name).write_text("é")
    found = S.scan(spark, root, S.pattern_of((".pdf", ".docx")))
    assert "FileScan" not in found._jdf.queryExecution().toString() and "binaryFile" not in found._jdf.queryExecution().toString()
    assert found.rdd.getNumPartitions() == max(4, spark.sparkContext.defaultParallelism)
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{pdf,docx}").load(root)
    columns = ["path", "modificationTime", "length", "content"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    assert found.count() == 502


def test_record_files_are_read_as_lines(spark, tmp_path):
    for name, text in (("a.jsonl", '{"text": "t", "tags": ["x"]}\n\nnot json\r\n{"text": 5}'), ("b.json", '{"summary": "s", "ocr": "no"}\n'), ("c.txt", "{}")):
        (tmp_path / name).write_text(text)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(S.read_record_files(spark, str(tmp_path))) == rows(S.read_jsonl(spark, str(tmp_path)))


def test_rich_text_leaves_runs_of_ascii_whole(spark):
    """Characters are coded as one by one before, and only those beyond ASCII are told apart."""
    from docloom.flow_queries import rich_text

    texts = ["", None, "plain {a} \\b\nc\r\t\x00\x7f", "žltý kôň", "\u0080\u00ff\ufffd", "a\U0001f600b\U0001f600\U0001f601", "e\u0301\u0301x", "日本 語"]
    escape = str.maketrans({"\\": "\\\\", "{": "\\{", "}": "\\}", "\n": "\\par "})
    coded = lambda t: "".join(f"\\u{ord(c)}?" if ord(c) > 127 else c for c in (t or "").translate(escape))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", rich_text(F.col("text")).alias("rich"))
    assert [r.rich for r in df.orderBy("id").collect()] == ["{\\rtf1\\ansi " + coded(t) + "}" for t in texts]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "regexp_extract_all" in plan
