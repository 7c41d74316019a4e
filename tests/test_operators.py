import math
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import plugins
from docloom.functions.gazetteer import gazetteer
from docloom.functions.vectors import cosine
from docloom.operators import documents as D
from docloom.operators import search as R
from docloom.operators import taxonomy as X
from docloom.operators.store import VectorStore
from docloom.operators.terms import tf_idf
from docloom.settings import Settings


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "Hello"), (2, "Hello"), (3, "World"), (4, None)], "seq int, text string")
    df = df.withColumns({"summary": F.lit("sum"), "tags": F.array(F.lit("tag"))})
    flagged = {r.seq: r for r in D.flag_duplicates(df, "seq").collect()}
    assert [flagged[k].is_duplicate for k in (1, 2, 3, 4)] == [False, True, False, False]
    assert flagged[2].summary == "sum" and flagged[2].tags == ["tag"]
    assert {r.seq for r in D.keep_first(df, "seq").collect()} == {1, 3, 4}
    assert {(r.seq, r.is_duplicate) for r in D.keep_last(df, "seq").collect()} == {(2, True), (3, False), (4, False)}


def test_one_first_row_for_each_hash(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.choice("abcdef")) for k in range(200)]
    got = D.flag_duplicates(spark.createDataFrame(rows, "seq int, text string"), "seq").collect()
    assert sum(not r.is_duplicate for r in got) == len({t for _, t in rows})


def test_chunks_match_python(spark):
    rows = [(n, " ".join(f"w{k}" for k in range(n))) for n in (0, 1, 9, 10, 11, 17, 18, 30)]
    got = D.chunks(spark.createDataFrame(rows, "doc_id int, text string"), 10, 3).orderBy("doc_id", "idx").collect()
    want = []
    for n, text in rows:
        w, start, idx = text.split(), 0, 0
        while w:
            want.append((n, idx, start, " ".join(w[start : start + 10])))
            if start + 10 >= len(w):
                break
            start, idx = start + 7, idx + 1
    assert [(r.doc_id, r.idx, r.start, r.chunk) for r in got] == want
    with pytest.raises(ValueError):
        D.chunks(spark.createDataFrame(rows, "doc_id int, text string"), 10, 10)


def test_taxonomy_document(spark):
    rows = [
        ("Zmluva s Českom a SR", "s", ["pobyt", "pobyt", ""], "c1", "a/b", "sk"),
        ("česko", "", ["zákon"], "c1", "a/c", None),
        ("", "", ["x"], "c2", "a", "sk"),
    ]
    schema = "text string, summary string, tags array<string>, category string, source string, language string"
    t = X.taxonomy_document(spark.createDataFrame(rows, schema))
    assert t["metadata"].pop("generated_at") and t["metadata"] == {"total_documents": 3, "empty_documents": 1, "bounded": False}
    short = X.taxonomy_document(spark.createDataFrame(rows, schema), most=1)
    assert short["metadata"]["bounded"] and len(short["sources"]["overview"]) == 1 and short["statistics"] == t["statistics"]
    assert t["categories"]["detailed"] == {"c1": {"count": 2, "tags": ["pobyt", "zákon"], "sources": ["a/b", "a/c"]}}
    assert t["tags"]["overview"] == {"pobyt": 2, "zákon": 1}
    assert t["countries"]["by_region"]["európska_únia"] == {"slovensko": 1, "česko": 1}
    assert t["sources"]["hierarchy"] == {"a": ["a/b", "a/c"]}
    assert t["languages"] == {"sk": 1, "unknown": 1}
    assert X.rag_document(t)["tag_hierarchy"]["procedures"] == ["pobyt"]


def test_gazetteer_size():
    assert len(gazetteer()) == 58 and sum(len(v) for _, v in gazetteer()) == 172


def test_tag_tfidf_and_clusters(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "c"])], "id long, tags array<string>")
    rows, words = tf_idf(docs, "id", F.col("tags"))
    assert rows.select("id").distinct().count() == 2 and words.count() == 3
    assert X.tag_clusters(docs, 2, "id").select("cluster").distinct().count() == 2


def exact(queries, points, k):
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    out = {}
    for q, v in queries:
        scored = sorted((-cos(v, w), p) for p, w in points if w and any(w))
        out[q] = [p for _, p in scored[:k]]
    return out


def test_a_failed_batch_costs_its_own_texts_only(spark):
    class Fragile(plugins.HashingEmbedder):
        def embed(self, texts):
            if "bad" in texts:
                raise RuntimeError
            return super().embed(texts)

    df = spark.createDataFrame([(k, "bad" if k == 5 else f"text {k}") for k in range(12)], "id int, t string").coalesce(1)
    rows = df.select("id", plugins.embed(F.col("t"), Fragile(), batch_size=4).alias("v")).collect()
    assert {r.id for r in rows if r.v is None} == {4, 5, 6, 7}
    with pytest.raises(RuntimeError):
        plugins.ModelEmbedder("no such model", 8).load()
    assert plugins.available_device("cuda") in ("cpu", "cuda") and plugins.embedder_of(Settings()).dim == 64
    assert plugins.embedder_of(Settings(embedder="a/b:768")).dim == 768


def test_replies_of_a_model_become_summaries(spark):
    class Canned:
        def complete(self, prompts):
            said = {"a": '```json\n{"sumar": "S", "tagy": "x, y,,"}\n```', "b": "no json", "c": '{"sumar": null, "tagy": ["z", " "]}'}
            return [said[p.removeprefix("Sum up: ")] for p in prompts]

    model = plugins.PromptSummarizer(Canned(), "Sum up: {text}", "sumar", "tagy")
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string").select("t", plugins.summarize(F.col("t"), model).alias("s"))
    assert {r.t: (r.s.summary, r.s.tags) for r in df.collect()} == {"a": ("S", ["x", "y"]), "b": ("", []), "c": ("", ["z"])}


def test_found_and_boosted_filters(spark):
    ranked = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, True)], "query_id int, found boolean, was_boosted boolean")
    assert [r.query_id for r in R.not_found(ranked).collect()] == [3] and [r.query_id for r in R.boosted_and_found(ranked).collect()] == [1]
    assert R.boosted_counts(ranked).where("n_boosted = 1").count() == 2


def test_top_k_is_exact_with_ties_and_odd_vectors(spark):
    rnd = random.Random(2)
    points = [(k, [rnd.choice([-1.0, 0.5, 1.0]) for _ in range(3)]) for k in range(60)] + [(98, [0.0] * 3), (99, None)]
    queries = [(k, points[k][1]) for k in range(7)]
    q = spark.createDataFrame(queries, "query_id long, query_vector array<double>")
    p = spark.createDataFrame(points, "id long, body array<double>").repartition(3)
    got = {}
    for r in R.top_k(q, p, 5, block=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    for query, want in exact(queries, points, 5).items():
        assert len(got[query]) == 5
        assert {i for i, s in got[query] if s > got[query][-1][1]} <= set(want)
    empty = R.top_k(q.limit(0), p, 5)
    assert empty.count() == 0


def test_boost_reorders_within_the_top_k_only(spark):
    hits = [(1, 10, 0.9, 1, ["a"], ["b"]), (1, 11, 0.8, 2, ["a"], ["a", "c"]), (1, 12, -0.5, 3, ["a"], ["a"]), (1, 13, -0.55, 4, ["a"], None)]
    df = spark.createDataFrame(hits, "query_id int, id int, score double, rank int, user_tags array<string>, tags array<string>")
    got = R.boost(df, 0.25).orderBy("rank").collect()
    assert [r.id for r in got] == [11, 10, 13, 12]
    assert [r.was_boosted for r in got] == [True, False, False, True]
    assert got[0].matched_tags == ["a"] and got[0].original_score == 0.8
    assert [r.id for r in R.boost(df, 0.0).orderBy("rank").collect()] == [10, 11, 12, 13]


def test_recall(spark):
    results = spark.createDataFrame([(1, 5, 1, True), (2, 6, 7, False)], "query_id int, id int, rank int, was_boosted boolean")
    truth = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "query_id int, expected_id int")
    row = R.recall(R.ranks_of_expected(results, truth), 5, 10).first()
    assert (row.total, row.found) == (3, 2)
    assert (round(row.recall_at_5, 3), round(row.recall_at_10, 3), round(row.boost_rate, 3)) == (0.333, 0.667, 0.333)
    assert R.recall(R.ranks_of_expected(results, truth.limit(0)), 5).first().recall_at_5 == 0.0


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 4) for r in df.select(cosine(F.col("a"), F.col("b"))).collect()] == [0.7071, 0.0]


def test_store(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    assert store.stats() == {} and store.create(2) and not store.create(2)
    payload = D.payload(spark.createDataFrame([("x",)], "text string"))
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "id string, seq int").select(
        "id", "seq", F.array(F.col("seq").cast("float"), F.lit(0.0).cast("float")).alias("body"),
        F.lit(None).cast("array<float>").alias("summary_vec"), F.col("id").alias("text"),
    )
    rows = rows.withColumn("payload", D.payload(rows)).drop("text")
    assert store.upsert(rows, "seq") == 3 and store.read().count() == 2
    assert store.upsert(rows.where("id = 'b'"), "seq") == 1 and store.read().count() == 2
    assert store.get("a").first().body == [3.0, 0.0] and store.get("zz").count() == 0
    assert store.stats()["points_count"] == 2 and store.stats()["dim"] == 2
    assert payload is not None and store.sample().count() == 2
    assert store.drop() and not store.drop()


def test_plugins(spark):
    df = spark.createDataFrame([("the cat is on the mat and it is that of all",), ("",), (None,)], "text string")
    assert [r[0] for r in df.select(plugins.detect_language(F.col("text"))).collect()] == ["en", "unknown", "unknown"]
    vectors = [r[0] for r in df.select(plugins.embed(F.col("text"), plugins.HashingEmbedder(8))).collect()]
    assert vectors[1] is None and abs(sum(x * x for x in vectors[0]) - 1) < 1e-6

    class Broken:
        def summarize(self, texts):
            raise RuntimeError

    assert df.select(plugins.summarize(F.col("text"), Broken()).alias("s")).first().s.asDict() == {"summary": "", "tags": []}
    said = df.select(plugins.summarize(F.col("text"), plugins.ExtractiveSummarizer()).alias("s")).first().s
    assert said.summary.startswith("the cat")


def test_tree_proposer():
    class Stub:
        def propose(self, tags):
            return {"root": tags}

    assert plugins.propose_tree(["b", "a", "b"], Stub()) == {"root": ["a", "b"]}
    assert plugins.propose_tree(["a"], None) == {}


def test_plans_stay_cheap(spark, tmp_path):
    """No Python in the text operators, no window over copies, filters that reach the scan."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, extra string").write.parquet(path)
    docs = spark.read.parquet(path)
    flagged = plan(D.flag_duplicates(D.quality_flags(D.enrich(docs)), "doc_id").select("doc_id", "is_duplicate"))
    assert "Python" not in flagged and "Pandas" not in flagged and "Window" not in flagged and "extra" not in flagged
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in plan(R.by_id(spark.read.schema("id long").parquet(path), 7))
    taxonomy = plan(X.counters(docs))
    assert taxonomy.count("Exchange") == 1


def test_settings():
    assert Settings.from_env({"docloom_tag_boost": "0.5", "DOCLOOM_LOG_LEVEL": "debug"}).tag_boost == 0.5
    assert Settings(log_level="debug").log_level == "DEBUG"
    for bad in ({"batch_size": 0}, {"chunk_size": 60, "chunk_overlap": 60}, {"device": "tpu"}, {"search_limit": 101}, {"log_level": "x"}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_a_summarizer_is_given_few_texts_at_a_time(spark):
    class Counting:
        def summarize(self, texts):
            return [(f"{len(texts)} {t}", [t]) for t in texts]

    rows = spark.range(0, 3000, 1, 1).select(F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("t"), "id")
    got = {r.id: r.s for r in rows.select("id", plugins.summarize(F.col("t"), Counting()).alias("s")).collect()}
    assert len(got) == 3000 and all(int(s.summary.split(" ")[0]) <= 256 for s in got.values())
    assert all(s.summary.split(" ")[1] == s.tags[0] == (str(i) if i % 7 else "") for i, s in got.items())
