"""Searches against brute force: neighbours, hard negatives, ranked lexical search."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from docloom.llm.lexical import MaxTree, Top, lexical_search, search_tree
from docloom.llm.negatives import hard_negatives
from docloom.llm.neighbours import Polytopes, hadamard, met, nearest_neighbours, widths_for

VECTORS = "vec_id long, embedding array<float>, label int, extra string"
ASKS = "vec_id % 100 = 0"


def true_neighbours(rows, k=10):
    out = {}
    for q, v in rows:
        if q is not None and q % 100 == 0:
            far = [(float(np.sqrt(((np.array(v, float) - np.array(w, float)) ** 2).sum())), i) for i, w in rows if (i, w) != (q, v) and len(w) == len(v)]
            out[q] = sorted(far, key=lambda x: (x[0], x[1] is None, x[1]))[:k]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for _, i in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def answered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_neighbours_of_the_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    got = answered(nearest_neighbours(rows, ASKS))
    want = true_neighbours([(r.vec_id, r.embedding) for r in rows.collect()])
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert recall(got, want) >= 0.9
    exact = {(q, i): d for q, near in want.items() for d, i in near}
    assert all(abs(exact.get((q, i), d) - d) < 1e-12 for q, x in got.items() for i, d in x)


def test_neighbours_of_vectors_with_many_norms_and_a_cluster(spark):
    rng = np.random.default_rng(3)
    scale = np.exp(rng.normal(size=(3000, 1)))
    some = np.concatenate([rng.normal(size=(3000, 24)) * scale, 3 + 0.01 * rng.normal(size=(1500, 24))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(some)]
    got = answered(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), ASKS))
    assert recall(got, true_neighbours(rows)) >= 0.9


def test_neighbours_of_odd_rows(spark):
    rows = [(100, [1.0, 0.0]), (200, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [0.0, 2.0]), (None, [1.0, 0.1]), (100, [1.0, 0.0]), (9, [1.0, 0.1]), (9, [5.0, 5.0])]
    odd = [(300, None), (400, []), (500, [0.0, 0.0]), (600, [1.0, None]), (700, [1.0, float("nan")]), (800, [float("inf"), 1.0]), (900, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows + odd], VECTORS)
    got = answered(nearest_neighbours(df.withColumnRenamed("extra", "uid"), ASKS))
    root = float(np.sqrt(np.float64(np.float32(0.1)) ** 2))
    near = [(9, root), (None, root), (8, math.sqrt(5)), (9, math.sqrt(41))]
    assert got == {100: [(7, 0.0), (200, 0.0), *near], 200: [(7, 0.0), (100, 0.0), *near]}
    assert nearest_neighbours(df.limit(0), ASKS).count() == 0
    huge = spark.createDataFrame([(100, [3e38, 1.0], 0, "x"), (1, [-3e38, 1.0], 0, "x"), (2, [3e38, 2.0], 0, "x")], VECTORS)
    assert [i for i, _ in answered(nearest_neighbours(huge, ASKS))[100]] == [2, 1]


def test_many_equal_vectors_are_one_point(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(i, [2.0, float(i)]) for i in range(500, 520)]
    got = answered(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ASKS))
    want = {q: [(i, d) for d, i in near] for q, near in true_neighbours(rows).items()}
    assert got == want


def test_large_cells_are_dealt_to_parts(spark, monkeypatch):
    import docloom.llm.neighbours as N

    monkeypatch.setattr(N, "PART", 16)
    rng = np.random.default_rng(5)
    rows = [(i, i, v.tolist(), 1) for i, v in enumerate(rng.normal(size=(200, 4)))]
    table = spark.createDataFrame(rows, "uid long, least long, v array<double>, cell long")
    hits = met(table, table.where("uid < 5"), 3)
    best = {}
    for r in sorted(hits.collect(), key=lambda r: r.score):
        best.setdefault(r.asked, []).append(r.uid)
    for q in range(5):
        far = sorted(range(200), key=lambda i: np.linalg.norm(np.array(rows[i][2]) - np.array(rows[q][2])))
        assert best[q][:3] == far[:3]


def test_rotations_keep_lengths_and_probes_begin_with_the_own_cell():
    x = np.random.default_rng(1).normal(size=(50, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert widths_for(1000, 64) == [64] and widths_for(10**8, 64)[:2] == [64, 64]
    kind = Polytopes(16, [16, 4], np.array([3.0, 5.0]), 3, 1)
    probes = kind.probes(x, 10**6)
    assert (probes[:, :, 0] == kind.codes(x)).all() and probes.shape[2] == kind.cells()
    assert all(len(set(p)) == kind.cells() for p in probes[:, 1])


def true_negatives(rows):
    rows = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in rows]
    dot = lambda v, w: sum(a * b for a, b in zip(v, w))
    out = []
    for a, label, v in rows:
        if a % 50 == 0:
            scored = sorted((-dot(v, w), i, lab) for i, lab, w in rows if i != a and len(w) == len(v))
            for s, p, _ in [x for x in scored if x[2] == label][:5]:
                fit = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
                out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(fit)]
    return sorted(out)


def mined(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in hard_negatives(df, "vec_id % 50 = 0").select(cols).collect())


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_negatives_against_brute_force(spark, spread, monkeypatch):
    """Norms that are alike, and norms that differ, so that buckets and parts are left out; ties among few values."""
    import docloom.llm.negatives as N

    monkeypatch.setattr(N, "BUCKET", 32)
    rng = np.random.default_rng(2)
    table = np.round(rng.normal(size=(400, 6)) * np.exp(spread * rng.normal(size=(400, 1))), 1)
    rows = [(i, int(rng.integers(3)), v.tolist()) for i, v in enumerate(table)]
    df = spark.createDataFrame([(i, v, lab, "x") for i, lab, v in rows], VECTORS)
    got = mined(df.withColumnRenamed("extra", "norm"))
    assert got and got == true_negatives(rows)


def test_negatives_of_odd_rows(spark):
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.1]), (3, 2, [0.9, 0.1]), (4, 1, [-1.0, 0.0]), (50, 3, [1e30, 1.0]), (5, 3, [1e30, 1.0])]
    odd = [(100, None, [1.0, 0.0]), (150, 1, None), (200, 1, [1.0, None]), (250, 1, [float("nan"), 0.0]), (None, 2, [0.9, 0.0]), (6, 2, [0.9])]
    df = spark.createDataFrame([(i, v, lab, "x") for i, lab, v in good + odd], VECTORS)
    got = mined(df)
    assert [r for r in got if r[0] == 0] == [r for r in true_negatives(good[:5]) if r[0] == 0]
    # Beyond 2^26 a component counts as 2^26.
    assert {r[4] for r in got if r[0] == 50} <= {(1 << 52) + 256 * 256}
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 1")) == []


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def true_ranks(docs, items, k=10):
    terms = {d: TERM.findall((t or "").translate(LOWER)) for d, t in docs}
    total, tokens = sum(map(bool, terms.values())), sum(map(len, terms.values()))
    df = Counter(t for x in terms.values() for t in set(x))
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, x in terms.items():
            tf = Counter(x)
            m = 10 + (90 * len(x) * total) // tokens if tokens else 10
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked if tf[t])
            scores += [(-s, d)] if s > 0 else []
        out += [(item, n + 1, d, -s) for n, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("block", [4096, 3])
def test_lexical_search_against_brute_force(spark, block):
    """Few words, so that many scores tie; items in one block and in several."""
    rng = np.random.default_rng(4)
    words = np.array("a b C d e1 Éa éa x2 ž Z".split() + [f"w{i}" for i in range(30)])
    text = lambda n: " ,-".join(rng.choice(words, n))
    docs = [(i, text(int(rng.integers(0, 30)))) for i in range(600)] + [(600, None), (601, ""), (602, "!?")]
    items = [(i, text(int(rng.integers(0, 6)))) for i in range(12)] + [(12, None), (13, "nowhere")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as item", "1 as n").repartition(3)
    assert found(lexical_search(d, spark.createDataFrame(items, "item_id long, text string"), block_items=block)) == true_ranks(docs, items)


def test_lexical_search_of_odd_rows(spark, monkeypatch):
    import docloom.llm.lexical as L

    monkeypatch.setattr(L, "CHUNK", 7)
    docs = spark.createDataFrame([(None, "cat dog"), (2, "cat dog"), (1, "cat dog"), (1, "cat"), (5, "bird " * 50)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Cat"), (1, "Cat"), (None, "bird")], "item_id long, text string")
    got = lexical_search(docs, items).collect()
    assert [(r.item_id, r.doc_id) for r in sorted(got, key=lambda r: (r.item_id is None, r.rank))] == [(1, 1), (1, 1), (1, 2), (1, None), (None, 5)]
    assert lexical_search(docs.limit(0), items).count() == 0 and lexical_search(docs, items.limit(0)).count() == 0


def test_trees_prune_and_open_equal_bounds():
    rng = np.random.default_rng(6)
    n, terms = 5000, 40
    have = rng.random((n, terms)) < 0.1
    have[:4] = False
    have[700:704, :8] = True
    have[650, :] = False
    doc, term = np.nonzero(have)
    value = np.where((doc >= 700) & (doc < 704), 100, rng.integers(1, 9, len(doc))).astype(np.int64)
    tree, docs = MaxTree(doc, term, value), [(0, n - i) for i in range(n)]
    top, asked = Top(3), np.arange(8)
    opened = search_tree(tree, docs, asked, top)
    assert sorted(top.heap, reverse=True) == [(800, (0, -(n - i))) for i in (703, 702, 701)]
    assert opened < 10
