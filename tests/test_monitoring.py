"""Counts come from the jobs that do the work; models are asked once, and what fails is said."""

import json
import urllib.request

import pytest
from pyspark.sql import functions as F

from docloom.functions import plugins
from docloom.monitoring import BUCKETS, Monitor
from docloom.plans import corpus as C
from docloom.sources import files as S
from test_sources import docx, pdf


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "in"
    (root / "A").mkdir(parents=True)
    for n in range(6):
        (root / "A" / f"{n}.docx").write_bytes(docx(f"This is text {n // 2} of a file."))
    (root / "b.pdf").write_bytes(pdf("hello"))
    (root / "bad.docx").write_bytes(b"no zip")
    return root


def jobs(spark, action):
    """The action's result, and how many jobs it started."""
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = action()
    return out, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)


def test_metrics_of_a_run(spark, tree, tmp_path):
    monitor, out = Monitor(), str(tmp_path / "out")
    done, started = jobs(spark, lambda: C.run_pipeline(spark, str(tree), out, monitor=monitor, file_per_record=True))
    m = done.metrics
    assert (m.processed, m.duplicates, m.failed) == (7, 3, 1) == (done.records.count(), done.records.where("is_duplicate").count(), done.dead.count())
    parse = monitor.stage("parse")
    assert (parse.rows, parse.failed) == (8, 1) and 0 < parse.row_seconds and parse.buckets == sorted(parse.buckets)
    assert 0 < parse.seconds < m.seconds and set(monitor.stages) == {"parse", "enrich", "write"}
    assert len(list((tmp_path / "out").iterdir())) == 4 and S.read_jsonl(spark, out).count() == 4
    # Counting starts no job of its own: a run that counts nothing has as many.
    plain = Monitor()
    plain.observe = lambda name, rows, *_, **__: rows
    plain.stage("enrich").counts["duplicates"] = 0
    assert jobs(spark, lambda: C.run_pipeline(spark, str(tree), out, monitor=plain, file_per_record=True))[1] == started
    text = monitor.text()
    assert 'docs_processed_total{stage="parse"} 7' in text and 'docs_failed_total{stage="parse"} 1' in text
    assert 'doc_process_seconds_bucket{stage="parse",le="+Inf"} 8' in text and text.count("_bucket{") == len(BUCKETS) + 1


def test_a_failed_stage(spark):
    monitor = Monitor()
    rows = monitor.observe("s", spark.range(3).select(F.raise_error(F.lit("no")).alias("x")))
    with pytest.raises(Exception, match="no"):
        monitor.run("s", rows.collect)
    assert monitor.stage("s").counts == {"failed_jobs": 1} and monitor.stage("s").rows == 0 and monitor.stage("s").seconds > 0
    rows = monitor.observe("s", spark.range(3), F.col("id") == 1)
    assert len(monitor.run("s", rows.collect)) == 3 and (monitor.stage("s").rows, monitor.stage("s").failed) == (3, 1)


def test_metrics_of_a_stream_and_their_address(spark, tmp_path):
    source, monitor = str(tmp_path / "in"), Monitor()
    listener = monitor.listen(spark)
    try:
        for part in (range(5), range(5, 9)):
            spark.createDataFrame([(i,) for i in part], "id int").write.mode("append").parquet(source)
            rows = monitor.observe("arrive", spark.readStream.schema("id int").parquet(source), F.col("id") > 6)
            q = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
            assert q.awaitTermination(60)
        for _ in range(100):  # events come a moment later
            if monitor.stage("arrive").rows == 9:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert (monitor.stage("arrive").rows, monitor.stage("arrive").failed) == (9, 2)
    server = monitor.serve(0)
    try:
        said = urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics").read().decode()
        assert 'docs_failed_total{stage="arrive"} 2' in said
    finally:
        server.shutdown()


def test_metadata_of_a_model(spark, tree, tmp_path):
    class Model:
        """Answers with JSON in fences; notes every prompt in a file."""

        def __init__(self, path):
            self.path = path

        def complete(self, prompts):
            with open(self.path, "a") as f:
                f.writelines(json.dumps(p) + "\n" for p in prompts)
            said = [json.dumps({"nazov_suboru": "N " + p.split("|")[0], "tagy": "a, b,", "sumar": "s"}) for p in prompts]
            return ["no json" if "bad" in p else f"```json\n{s}\n```" for p, s in zip(prompts, said)]

    log = str(tmp_path / "prompts")
    model = plugins.MetadataModel(Model(log), "{file_name}|{file_type}|{snippet}")
    found = {r.cesta_k_suboru.rsplit("/", 1)[1]: r for r in C.extract_metadata(spark, str(tree), str(tmp_path / "meta"), model).collect()}
    assert found["b.pdf"].nazov_suboru == "N b.pdf" and found["b.pdf"].tagy == ["a", "b"] and found["b.pdf"].typ_suboru == ".pdf" and found["b.pdf"].sumar == "s"
    assert found["bad.docx"].nazov_suboru == "bad.docx" and found["bad.docx"].tagy is None
    prompts = [json.loads(x) for x in open(log)]
    assert len(prompts) == 8 and "b.pdf|.pdf|%PDF-1.4" in "".join(p[:19] for p in prompts)
    assert spark.read.json(str(tmp_path / "meta")).count() == 8

    class Broken:
        def complete(self, prompts):
            raise RuntimeError("down")

    df = spark.createDataFrame([("n", ".x", "t")], "n string, x string, t string")
    said = df.select(plugins.describe(F.col("n"), F.col("x"), F.col("t"), plugins.MetadataModel(Broken())).alias("s")).first().s
    assert said.nazov_suboru is None and said.tagy is None
