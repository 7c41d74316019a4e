"""The inverted-file index, exact search by parts, and what the store does with both."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import search as R
from docloom.operators.index import VectorIndex, overlap
from docloom.operators.store import VectorStore
from docloom.schemas import PAYLOAD


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hits(df):
    return sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 16))
    rows = [(i, (centers[i % 20] + 0.4 * rng.normal(size=16)).tolist()) for i in range(2000)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [1.0, 2.0]), (2003, [float("nan")] * 16)]
    return spark.createDataFrame(rows, "id long, body array<double>")


def asked_of(points, every):
    return points.where(f"id % {every} = 0").select(F.col("id").alias("query_id"), F.col("body").alias("query_vector"))


def test_search_gives_the_same_by_block_and_by_parts(spark, points):
    good = points.where("id < 2000")
    asks = asked_of(good, 40).unionByName(spark.createDataFrame([(-1, None), (-2, [0.0] * 16), (-3, [1.0])], "query_id long, query_vector array<double>"))
    held = R.top_k(asks, good, 7)
    dealt = R.top_k(asks, good, 7, block=3)
    assert hits(held) == hits(dealt) and held.select("query_id").distinct().count() == 50
    # Queries are repeated, for parts of the points; points aren't.
    assert plan(dealt).split("== Initial Plan")[0].count("Generate explode") == 1


def test_queries_are_evaluated_once(spark, points):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def costly(v):
        seen.add(1)
        return v

    asks = asked_of(points.where("id < 2000"), 100).withColumn("query_vector", costly("query_vector"))
    R.top_k(asks, points, 3).collect()
    assert seen.value == 20


@pytest.mark.parametrize("block", [4096, 3])
def test_index_finds_most_neighbours_in_few_folders(spark, points, tmp_path, block):
    index = VectorIndex.build(points, str(tmp_path / "index"), cells=40)
    found = index.settings()
    assert found["points"] == 2000 and 1 <= found["probes"] < found["cells"] / 2
    asks = asked_of(points.where("id < 2000"), 50)
    near = index.search(asks, 10, block=block)
    assert overlap(near, R.top_k(asks, points, 10)).first().recall >= 0.9
    # One query: only its cells' folders are read.
    one = index.search(asks.limit(1), 10)
    text = plan(one)
    assert "PartitionFilters: [" in text and "cell" in text.split("PartitionFilters: [")[1].split("]")[0]
    every = index.search(asks, 10, probes=10**6, block=block)
    assert hits(every) == hits(R.top_k(asks, points.where("id < 2000"), 10))


def test_index_of_the_embeddings(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("body"))
    index = VectorIndex.build(rows, str(tmp_path / "index"))
    asks = asked_of(rows, 50)
    assert overlap(index.search(asks, 10), R.top_k(asks, rows, 10)).first().recall >= 0.9


def test_index_of_next_to_nothing(spark, points, tmp_path):
    for n in (0, 1, 2, 5):
        index = VectorIndex.build(points.where(f"id < {n}"), str(tmp_path / f"index{n}"))
        assert index.search(asked_of(points, 50), 10, probes=9).select("id").distinct().count() == n
    assert index.search(asked_of(points, 50).limit(0), 10).count() == 0


def of_store(spark, n):
    empty = F.from_json(F.lit("{}"), f"struct<{PAYLOAD}>")
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(f"p{i}", rng.normal(size=8).tolist()) for i in range(n)], "id string, v array<double>")
    body = F.col("v").cast("array<float>")
    return rows.select("id", body.alias("body"), body.alias("summary_vec"), empty.withField("text", F.col("id")).alias("payload"))


def test_store_index_and_lookup(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path))
    store.create(8, buckets=16)
    rows = of_store(spark, 300)
    store.upsert(rows)
    asks = rows.limit(5).select(F.col("id").alias("query_id"), F.col("body").alias("query_vector"))
    with pytest.raises(LookupError):
        store.search(asks, 3, approximate=True)
    store.build_index(cells=6)
    near, exact = store.search(asks, 3, approximate=True, probes=6), store.search(asks, 3)
    assert hits(near) == hits(exact) and {r.text for r in near.collect()} == {r.id for r in near.collect()}
    one = store.get("p7")
    assert [r.id for r in one.collect()] == ["p7"] and len({f.rsplit("/", 2)[1] for f in one.inputFiles()}) == 1
    assert store.get("p7000").count() == 0
    store.upsert(rows.limit(1))
    with pytest.raises(LookupError):  # the points have changed since
        store.search(asks, 3, approximate=True)
    store.build_index(cells=6)
    assert store.search(asks, 3, approximate=True).count() == 15 and len(store._names("indexes")) == 1


def test_failed_writes_are_tried_again_with_longer_delays(spark, tmp_path, monkeypatch):
    import docloom.operators.store as module

    store = VectorStore(spark, str(tmp_path), max_retries=3, retry_delay=0.5)
    store.create(8)
    rows, waited, merge, fails = of_store(spark, 20), [], VectorStore._merge, [3]
    monkeypatch.setattr(module, "time", SimpleNamespace(sleep=waited.append))

    def shaky(self, *args):
        fails[0] -= 1
        if fails[0] >= 0:
            raise OSError("lost")
        return merge(self, *args)

    monkeypatch.setattr(VectorStore, "_merge", shaky)
    assert store.upsert(rows) == 20 and waited == [0.5, 1.0, 2.0] and store.read().count() == 20
    fails[0] = 9
    with pytest.raises(OSError):
        store.upsert(rows)
    assert store._names("staged") == [] and store.read().count() == 20
