"""Tf-idf, main directions, tag trees, languages and summaries against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import search as R
from docloom.operators import taxonomy as X
from docloom.operators import terms as M
from docloom.operators.language import LanguageModel, counts_of
from docloom.operators.summary import scored, sentences_of, summaries, weighed_words

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_dense_and_ordered(spark):
    rnd = random.Random(1)
    rows = [(k, [f"t{rnd.randint(0, 300):03d}" for _ in range(rnd.randint(0, 6))]) for k in range(500)] + [(500, None), (501, ["", None])]
    docs = spark.createDataFrame(rows, "k long, tags array<string>").repartition(5)
    found, words = M.tf_idf(docs, "k", F.col("tags"))
    df = Counter(t for _, tags in rows for t in set(tags or []) if t)
    order = sorted(df)
    assert sorted((r.term_id, r.term, r.df) for r in words.collect()) == [(n, t, df[t]) for n, t in enumerate(order)]
    want = {(k, order.index(t)): (c, c * math.log((len(rows) + 1) / (df[t] + 1))) for k, tags in rows for t, c in Counter(x for x in tags or [] if x).items()}
    got = {(r.k, r.term_id): (r.tf, r.weight) for r in found.collect()}
    assert got.keys() == want.keys() and all(got[x][0] == want[x][0] and abs(got[x][1] - want[x][1]) < 1e-9 for x in want)
    assert "CountVectorizer" not in plan(found) and M.tf_idf(docs.limit(0), "k", F.col("tags"))[0].count() == 0


def matrix(rows, terms, idf):
    out = np.zeros((len(rows), len(terms)))
    for n, counts in enumerate(rows):
        for t, c in counts.items():
            if t in idf:
                out[n, terms.index(t)] = (1 + math.log(c)) * idf[t]
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def test_directions_are_those_of_a_whole_decomposition(spark):
    rng = np.random.default_rng(2)
    topics = rng.dirichlet(np.full(60, 0.05), size=4)
    rows = [Counter(f"w{t}" for t in rng.choice(60, size=40, p=topics[n % 4])) for n in range(240)]
    counts = spark.createDataFrame([(n, t, c) for n, x in enumerate(rows) for t, c in x.items()], "k long, term string, tf long").repartition(4)
    model = M.LatentModel.fit(counts, "k", dims=4)
    df = Counter(t for x in rows for t in x)
    terms = sorted(t for t in df if df[t] >= 2)
    a = matrix(rows, terms, {t: math.log(241 / (df[t] + 1)) for t in terms})
    _, _, right = np.linalg.svd(a, full_matrices=False)
    true = a @ right[:4].T
    got = {r.k: r.vector for r in model.embed(counts, "k").collect()}
    mine = np.array([got[n] for n in range(240)])
    true /= np.linalg.norm(true, axis=1, keepdims=True)
    # Likeness of documents, which turns and signs of the directions don't change.
    assert np.abs(mine @ mine.T - true @ true.T).max() < 0.05
    assert np.allclose(np.linalg.norm(mine, axis=1), 1)
    again = {r.k: r.vector for r in M.LatentModel.fit(counts.repartition(3), "k", dims=4).embed(counts, "k").collect()}
    assert np.abs(np.array([again[n] for n in range(240)]) @ mine[0] - mine @ mine[0]).max() < 1e-6 or np.allclose(np.abs(again[0]), np.abs(mine[0]), atol=1e-6)


def test_near_copies_rank_first(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 400").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = list({t: (i, t) for i, t in rows}.values())
    copies = [(10_000 + i, " ".join(w for n, w in enumerate(t.split()) if n % 20)) for i, t in rows]
    table = spark.createDataFrame(rows + copies, "doc_id long, text string")
    counts = M.counted(table, "doc_id", M.words_of(F.col("text")))
    vectors = M.LatentModel.fit(counts, "doc_id").embed(counts, "doc_id")
    asks = vectors.where("doc_id >= 10000").select(F.col("doc_id").alias("query_id"), F.col("vector").alias("query_vector"))
    first = {}
    for r in R.top_k(asks, vectors.where("doc_id < 10000"), 1, point_id="doc_id", vector="vector").collect():
        first[r.query_id] = r.id
    assert sum(first[i] == i - 10_000 for i in first) >= 0.9 * len(first) and len(first) > 20


def test_models_of_next_to_nothing(spark):
    none = spark.createDataFrame([], "k long, term string, tf long")
    model = M.LatentModel.fit(none, "k")
    assert model.embed(none, "k").count() == 0
    one = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (2, "b", 1), (3, "b", 1)], "k long, term string, tf long")
    assert M.LatentModel.fit(one, "k", min_df=1).embed(one, "k").count() == 3


def test_clusters_need_no_vocabulary(spark):
    rows = [(n, [f"g{n % 2}", f"g{n % 2}b", f"x{n}"]) for n in range(60)] + [(60, []), (61, None)]
    docs = spark.createDataFrame(rows, "k long, tags array<string>")
    got = {r.k: r.cluster for r in X.tag_clusters(docs, 2, "k", dims=2).collect()}
    assert len(got) == 62 and got[60] is None and got[61] is None
    assert len({got[n] for n in range(0, 60, 2)}) == len({got[n] for n in range(1, 60, 2)}) == 1 and got[0] != got[1]


def test_tag_tree(spark):
    rows = [(n, ["animal", "dog"]) for n in range(4)] + [(n, ["animal", "cat"]) for n in range(4, 8)] + [(n, ["animal", "dog", "poodle", "poodle"]) for n in range(8, 11)]
    rows += [(20, ["twin a", "twin b"]), (21, ["twin a", "twin b"]), (22, ["alone"]), (23, None), (24, [])]
    edges = M.tag_tree(spark.createDataFrame(rows, "k long, tags array<string>"), "k", F.col("tags"))
    got = {r.child: (r.parent, r.n_child, r.n_parent, r.n_both) for r in edges.collect()}
    assert got == {
        "animal": (None, 11, None, None), "dog": ("animal", 7, 11, 7), "cat": ("animal", 4, 11, 4), "poodle": ("dog", 3, 7, 3),
        "twin a": (None, 2, None, None), "twin b": ("twin a", 2, 2, 2), "alone": (None, 1, None, None),
    }
    paths = {r.tag: "/".join(r.path) for r in M.tree_paths(edges).collect()}
    assert paths["poodle"] == "animal/dog/poodle" and paths["twin b"] == "twin a/twin b" and len(paths) == 7


def test_languages_of_texts_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 20")
    model = LanguageModel.fit(docs.where("doc_id % 5 <> 0"), "lang", F.col("text"))
    got = docs.where("doc_id % 5 = 0").join(model.detect(docs.where("doc_id % 5 = 0"), "doc_id", F.col("text")), "doc_id")
    right, every = got.agg(F.count_if(F.col("lang") == F.col("detected")), F.count("*")).first()
    assert every > 150 and right >= 0.9 * every


def test_language_of_odd_texts(spark):
    known = spark.createDataFrame([("a", "aba aba"), ("b", "bcb bcb"), (None, "zzz")], "lang string, text string")
    model = LanguageModel.fit(known, "lang", F.col("text"))
    odd = spark.createDataFrame([(1, "ABA"), (2, "bcb!"), (3, ""), (4, None), (5, "12"), (6, "q"), (7, "𐐨𐐨 x")], "k long, text string")
    got = {r.k: (r.detected, r.score) for r in model.detect(odd, "k", F.col("text")).collect()}
    assert [got[k][0] for k in (1, 2, 3, 4, 5)] == ["a", "b", "unknown", "unknown", "unknown"] and len(got) == 7
    none = LanguageModel.fit(known.limit(0), "lang", F.col("text")).detect(odd, "k", F.col("text")).collect()
    assert {r.detected for r in none} == {"unknown"} and len(none) == 7


def test_summaries(spark):
    text = "Common words here. Zebra quagga okapi stand apart! Zebra quagga okapi stand apart, too. Common words again? Rare gnu."
    docs = spark.createDataFrame([(1, text), (2, "Common words here again"), (3, "common words"), (4, ""), (5, None), (6, "!?")], "k long, text string")
    got = {r.k: r for r in summaries(docs, "k", F.col("text"), sentences=2, tags=3).collect()}
    assert got[1].summary == "Zebra quagga okapi stand apart! Rare gnu." or "Zebra quagga okapi stand apart" in got[1].summary
    assert got[1].summary.count("Zebra") == 1  # the second is too much alike
    assert set(got[1].tags) <= {"zebra", "quagga", "okapi", "stand", "apart"} and len(got[1].tags) == 3
    assert [(got[k].summary, got[k].tags) for k in (4, 5)] == [("", []), ("", [])] and got[6].summary == "" and len(got) == 6


@pytest.mark.parametrize("text", ["One. Two\nthree!  Four?", "", None, " \n\n a"])
def test_sentences(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(sentences_of(F.col("t")).alias("s")).first().s
    want = [x.strip(" ") for x in re.sub(r"([.!?])\s+", r"\1\n", text or "").split("\n")]
    assert got == [x for x in want if x]


def test_scores_are_whole_numbers(spark):
    docs = spark.createDataFrame([(1, "a b. b c"), (2, "a")], "k long, text string")
    got = {(r.k, r.s): r.score for r in scored(weighed_words(docs, "k", F.col("text")), "k").collect()}
    idf = lambda n: math.floor(1000 * math.log(3 / (n + 1)))
    assert got == {(1, 0): (idf(2) + 2 * idf(1)) // 5, (1, 1): (2 * idf(1) + idf(1)) // 5, (2, 0): idf(2) // 4}


def test_reports_say_when_a_list_was_cut(spark):
    docs = spark.createDataFrame([("t", "c", f"a/b{n}/c{n}", ["x"]) for n in range(5)], "text string, category string, source string, tags array<string>")
    assert not X.taxonomy_document(docs, most=20)["metadata"]["bounded"]
    deep = spark.createDataFrame([("t", "c", "/".join("abcdefgh"), ["x"])], "text string, category string, source string, tags array<string>")
    assert X.taxonomy_document(deep, most=5)["metadata"]["bounded"] and not X.taxonomy_document(deep, most=9)["metadata"]["bounded"]


def test_words_are_counted_where_documents_lie(spark):
    """What a sentence score writes are blocks of numbers and each block's distinct words, not a row for each word of a document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    blocks = weighed_words(docs, "doc_id", F.col("text"))
    total = blocks.agg(F.sum(F.size("keys")), F.sum(F.size("terms")), F.sum(F.size("codes"))).first()
    assert total[0] == docs.count() and total[1] < total[2] / 2
    got = {(r.doc_id, r.s): r.score for r in scored(blocks, "doc_id").collect()}
    rows = docs.select("doc_id", sentences_of(F.col("text")).alias("l")).collect()
    words = {(r.doc_id, s): [w for w in re.split(r"\W+", x.lower()) if w] for r in rows for s, x in enumerate(r.l)}
    tf, df = Counter((k, w) for (k, _), ws in words.items() for w in ws), Counter()
    df.update(w for _, w in tf)
    weight = {(k, w): n * math.floor(1000 * math.log((len(rows) + 1) / (df[w] + 1))) for (k, w), n in tf.items()}
    want = {(k, s): int(sum(weight[k, w] for w in set(ws)) / (len(set(ws)) + 3)) for (k, s), ws in words.items() if ws}
    assert len(got) == len(want) and sum(got[x] != want[x] for x in want) <= len(want) // 100  # \W differs between Java and Python for a few signs


def test_rows_of_equal_keys_are_one_document(spark):
    docs = spark.createDataFrame([(1, "a b. c"), (1, "b\nd e. f"), (2, "a")], "k long, text string")
    got = {(r.k, r.s): r.score for r in scored(weighed_words(docs, "k", F.col("text")), "k").collect()}
    idf = lambda n: math.floor(1000 * math.log(4 / (n + 1)))
    assert got == {(1, 0): (idf(2) + 2 * idf(1)) // 5, (1, 1): 3 * idf(1) // 6, (1, 2): idf(1) // 4, (2, 0): idf(2) // 4}


def test_trigrams_are_counted_where_texts_lie(spark):
    """A row for each trigram of a text leaves the task that reads it, and there is no shuffle before; signs of all planes count."""
    texts = ["Aba  ABA!", "ž𐐨ž𐐨", "", None, "1 2", "q", "ée " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    rows = counts_of(docs, "k", F.col("text"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    signs = lambda g: "".join(chr(g >> s & (1 << 21) - 1) for s in (42, 21, 0))
    got = {(r.k, signs(r.gram)): r.n for r in rows.collect()}
    low = [" aba aba ", " ž𐐨ž𐐨 ", "", "", "", " q ", " " + "ée " * 5000]
    assert got == dict(Counter((k, t[i : i + 3]) for k, t in enumerate(low) for i in range(len(t) - 2)))


def test_blocks_of_documents_hold_their_counts(spark):
    rows = [(n % 40, f"w{n % 7} w{n % 3}  W{n % 3} x{n}") for n in range(50)] + [(90, None), (91, " "), (None, "a b a")]
    docs = spark.createDataFrame(rows, "k long, text string").repartition(3)
    want = Counter()
    for k, t in rows:
        for w in re.findall(r"\w+", (t or "").lower()):
            want[k, w] += 1
    blocks = M.bags(docs, "k", M.words_of(F.col("text"))).collect()
    got, df = Counter(), Counter()
    for b in blocks:  # each small enough for one row
        at = 0
        for k, size in zip(b["keys"], b.sizes):
            for c, tf in zip(b.codes[at : at + size], b.tf[at : at + size]):
                assert (k, b.terms[c]) not in got
                got[k, b.terms[c]] = tf
            at += size
        assert len(set(b.terms)) == len(b.terms)
        df.update(dict(zip(b.terms, b.df)))
    assert got == want and df == Counter(w for _, w in want)
    # Vectors go to blocks by term; no row for each term of a document is shuffled.
    counts = M.counted(docs, "k", M.words_of(F.col("text")))
    found = M.LatentModel.fit(counts, "k", dims=3).embed(counts, "k")
    assert "sum(" not in plan(found) and found.count() > 30


def test_a_task_makes_few_blocks(monkeypatch):
    import pyarrow as pa

    batch = lambda k, words: pa.RecordBatch.from_arrays([pa.array(k), pa.array(words), pa.array([[]] * len(k), pa.list_(pa.int64()))], names=["k", "t", "n"])
    some = [M.tallied(batch([1, 2, 3], [["b", "a", "b"], [], ["c"]])), M.tallied(batch([4], [["c", "d", "c"]]))]
    b = next(M.block_of(5, some)).to_pylist()[0]
    assert b["keys"] == [1, 3, 4] and b["sizes"] == [2, 1, 2] and [b["terms"][c] for c in b["codes"]] == ["b", "a", "c", "c", "d"]
    assert b["tf"] == [2, 1, 1, 2, 1] and dict(zip(b["terms"], b["df"])) == {"b": 1, "a": 1, "c": 2, "d": 1}
    monkeypatch.setattr(M, "ROW", 2)
    rows = [r.to_pylist()[0] for r in M.block_of(5, some)]
    assert [r["keys"] for r in rows] == [[1], [3], [4]] and sum((r["codes"] for r in rows), []) == b["codes"] and [len(r["terms"]) for r in rows] == [4, 0, 0]


def test_terms_are_dealt_to_parts_that_a_task_holds(spark, monkeypatch):
    """However many terms, a task holds SLAB bytes of their vectors; documents with the same words get the same vector, to the last bit."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    both = docs.union(docs.select(F.col("doc_id") + 10_000, "text")).repartition(5)
    words, found = M.words_of(F.col("text")), []
    for slab, row, many in ((M.SLAB, M.ROW, M.MANY), (1 << 17, 1 << 12, 20)):
        monkeypatch.setattr(M, "SLAB", slab)
        monkeypatch.setattr(M, "ROW", row)
        monkeypatch.setattr(M, "MANY", many)
        blocks = M.bags(both, "doc_id", words)
        model = M.LatentModel.fit_bags(blocks, spent=True)
        rows = model.slabs.select("part", F.size("idf").alias("n"), F.size("v").alias("size")).collect()
        held = Counter()
        for r in rows:
            assert r["size"] == 40 * r.n
            held[r.part] += 8 * r["size"]
        assert max(held.values()) <= slab + 8 * 40 and len(held) == model.parts
        assert model.rows.agg(F.max(F.size("keys"))).first()[0] <= many
        found.append({r.doc_id: r.vector for r in model.embed_bags(blocks, "doc_id").collect()})
    assert model.parts > 4 and model.rows.count() > 20
    plain, small = found
    assert plain.keys() == small.keys() and len(plain) > 150
    keys = sorted(plain)
    a, b = (np.array([x[k] for k in keys]) for x in (plain, small))
    assert np.abs(a @ a.T - b @ b.T).max() < 1e-9
    for x in found:
        assert all(x[k] == x[k + 10_000] for k in x if k < 10_000)
    # Other documents than those fitted go the same way, by their words.
    counts = M.counted(docs.where("doc_id < 100"), "doc_id", words)
    again = {r.doc_id: r.vector for r in model.embed(counts, "doc_id").collect()}
    assert again and all(np.allclose(again[k], small[k], atol=1e-12) for k in again)


def test_row_groups_of_large_rows_are_small(spark):
    """A reader decodes a row group at once; a writer looks at its size only after a hundred rows unless it is told otherwise."""
    import pyarrow.parquet as pq

    rows = spark.range(60).repartition(1).select(F.expr("transform(sequence(1, 100000), x -> hash(id, x))").alias("x"))
    table = M.written(rows, "large", M.LARGE_ROWS)
    file = pq.ParquetFile(table.inputFiles()[0].removeprefix("file://"))
    assert file.num_row_groups > 2 and max(file.metadata.row_group(n).num_rows for n in range(file.num_row_groups)) < 40
    assert table.count() == 60
