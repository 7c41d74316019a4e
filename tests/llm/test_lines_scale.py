"""Line dedup: tallies of tokens at sizes that no test can reach, and whole tables against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import lines as L

SF = "/root/testdata"


def texts_of(sf, n):
    import pyarrow.parquet as pq

    return [t.encode() for t in pq.read_table(f"{SF}/sf{sf}/documents.parquet", columns=["text"]).column(0).to_pylist()[:n] if t]


def tallies_of(words, counters, times=1):
    total = np.bincount((words & np.uint64(counters - 1)).astype(np.int64), minlength=counters) * times
    ranks = np.minimum(np.ceil(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
    return L.Tallies(ranks, np.packbits(total > 0, bitorder="little"), int(total.sum()), 3)


@pytest.mark.parametrize("times", [1, 20, 1000, 40_000, 4_000_000])
def test_records_of_a_line_do_not_grow_with_the_input(times):
    """25 MB of text, and as much as 1 TB and 100 TB by its counts: in as many counters as that much text gets."""
    texts = texts_of("0.1", 10_000)
    size = sum(map(len, texts)) * times
    counters = L.counters_for(size)
    every = L.tokens_of(texts, 3)[2]
    # As many tokens a counter as there would be: those of a larger text are spread over more words.
    tallies = tallies_of(every, L.LEAST, 1)
    more = max(1, times * L.LEAST // counters)
    ranks = np.minimum(tallies.ranks.astype(int) + np.where(tallies.ranks > 0, np.ceil(8 * np.log2(more)).astype(int), 0), 255).astype(np.uint8)
    tallies = L.Tallies(ranks, tallies.met, tallies.total * more, 3)
    lines = L.Lines(*L.by_rarity(texts[:1500], tallies))
    owner, *_ = L.keys_of(lines, np.ones(len(lines.head), bool), tallies, 75, L.Tuning())
    assert len(owner) / len(lines.head) < (12 if times < 10**6 else 30)


def test_counters_follow_the_input():
    assert L.counters_for(0) == L.counters_for(300_000_000) == L.LEAST and L.counters_for(30 * 10**9) == 1 << 26 == L.counters_for(10**14)


def test_tallies_are_the_same_however_they_are_held(monkeypatch):
    rng = np.random.default_rng(1)
    cells = [rng.integers(0, L.LEAST, 5000) for _ in range(20)]
    rows = lambda: pa.Table.from_batches(list(L.tallied(iter(cells), L.LEAST))).to_pydict()
    dense = rows()
    monkeypatch.setattr(L, "DENSE", 1)
    assert rows() == dense and list(L.tallied(iter([]), L.LEAST)) == []


def brute(docs, percent=75):
    """doc_id -> the lines that stay."""
    seen, out = [], {}
    for uid, text in sorted(docs):
        kept = []
        for line in (text or "").split("\n"):
            words = frozenset("".join(c.lower() if "A" <= c <= "Z" else c for c in line).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").split(" ")) - {""}
            n = len(words)
            same = n and any(100 * len(words & s) >= percent * len(words | s) for s in seen if 4 * min(len(s), n) >= 3 * max(len(s), n))
            if not same:
                kept.append(line)
            if n:
                seen.append(words)
        out[uid] = "\n".join(kept)
    return out


@pytest.mark.parametrize("counters", [None, 1 << 23])
def test_whole_documents_against_brute_force(spark, counters, monkeypatch):
    docs = spark.read.parquet(f"{SF}/sf0.001/documents.parquet")
    if counters:
        monkeypatch.setattr(L, "counters_for", lambda size: counters)
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_words_made_to_collide_are_told_apart(spark):
    """Two words of one unseeded hash: an earlier line or text with the one doesn't take that with the other."""
    from docloom.llm.near import near_components
    from docloom.llm.words import word_hashes

    pair = ["rzzlfo5aaaapaaaa", "sxhfubmmh1p6q7th"]
    unseeded = [word_hashes(w.encode(), 0)[1][0] for w in pair]
    assert unseeded[0] == unseeded[1] and len({int(word_hashes(w.encode(), 5)[1][0]) for w in pair}) == 2
    docs = spark.createDataFrame([(k, f"{w} b c") for k, w in enumerate(pair)], "doc_id long, text string")
    assert {r.n_removed for r in L.dedup_lines(docs).collect()} == {0}
    docs = spark.createDataFrame([(k, f"{w} b c d e") for k, w in enumerate(pair)], "doc_id long, text string")
    assert {r.kept for r in near_components(docs).collect()} == {True}


def test_counting_needs_no_places_of_words(monkeypatch):
    from docloom.llm.words import word_hashes

    texts = ["a b a\nc", "", "x " * 300_000, "é \t b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(texts)], names=["uid", "text"])
    monkeypatch.setattr(L, "tokens_of", None)
    found = np.zeros(L.LEAST, np.int64)
    for b in L.count_tokens(L.LEAST, 3)(iter([batch])):
        for r in b.to_pylist():
            found[r["chunk"] * L.CHUNK + np.frombuffer(r["cells"], "<u2").astype(np.int64)] += np.frombuffer(r["counts"], "<u4")
    every = word_hashes("\n".join(texts).encode(), 3)[1]
    assert (found == np.bincount((every & np.uint64(L.LEAST - 1)).astype(np.int64), minlength=L.LEAST)).all()


def some_tallies(ranks):
    return L.Tallies(ranks, np.full(len(ranks) // 8, 255, np.uint8), 1000, 3)


@pytest.mark.parametrize("ranks", [np.zeros(L.LEAST, np.uint8), np.random.default_rng(1).integers(0, 90, L.LEAST).astype(np.uint8)])
def test_words_of_a_line_are_ordered_by_rank_and_whole_hash(ranks, monkeypatch):
    """Also where the bits of hash in the sorted number don't tell words apart: then by the plain order."""
    rng = np.random.default_rng(2)
    texts = [" \n".join(" ".join(f"w{k}" for k in rng.integers(0, 400, 30)) for _ in range(20)).encode() for _ in range(30)]
    plain, tallies = L.tokens_of, some_tallies(ranks)

    def alike(texts, seed):
        doc, line, word = plain(texts, seed)
        return doc, line, (word & np.uint64(0xFFFFF)) | np.uint64(7 << 60)  # words differ in their lowest bits only

    for tokens in (plain, alike):
        monkeypatch.setattr(L, "tokens_of", tokens)
        doc, line, word = tokens(texts, 3)
        wanted = sorted({(d, n, int(r), w) for d, n, r, w in zip(doc.tolist(), line.tolist(), tallies.rank(word), word.tolist())})
        got = list(zip(*(x.tolist() for x in L.by_rarity(texts, tallies))))
        assert got == [(d, n, w) for d, n, _, w in wanted]


def test_a_bucket_is_held_little_more_than_twice():
    import tracemalloc

    rng = np.random.default_rng(4)
    n = 200_000
    kinds = dict(L.FIELDS)
    c = {name: rng.integers(0, 1 << 31, n).astype(kinds[name]) for name in kinds}
    c |= {"size": rng.integers(1, 60, n).astype("<u4"), "uid": np.sort(rng.integers(0, 1 << 20, n)), "place": np.zeros(n, "<u4")}
    blobs = [L.packed({k: v[a : a + 20_000] for k, v in c.items()}, L.FIELDS) for a in range(0, n, 20_000)]
    raw = sum(v.nbytes for v in c.values())
    tracemalloc.start()
    group = L.Group(L.unpacked(blobs, L.FIELDS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(group.key) == n and peak < 2.5 * raw, peak / raw


def test_arrow_batches_of_the_line_join_are_small(spark, monkeypatch):
    from docloom.llm import shared

    rows = spark.range(0, 40, numPartitions=1).select("id", F.repeat(F.concat(F.lit("word "), "id"), 30_000).alias("text"))
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"]) for b in batches)
    before = spark.conf.get(shared.BATCH_BYTES)
    with shared.small_batches(spark):
        assert max(r.n for r in rows.mapInArrow(sizes, "n long").collect()) < 6 << 20
    assert spark.conf.get(shared.BATCH_BYTES) == before
    seen = []
    monkeypatch.setattr(L, "counted", lambda *a: seen.append(spark.conf.get(shared.BATCH_BYTES)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        L.dedup_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert int(seen[0]) == 4 << 20 and spark.conf.get(shared.BATCH_BYTES) == before
