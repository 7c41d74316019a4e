"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.components import components
from docloom.llm.shared import drop_table, materialise, released, with_uid
from docloom.llm.words import BLOCK, SPREAD, U, blocks, mix, new_seed, stir, word_hashes

SKETCHES = "uid long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingles_of(texts: list[bytes], words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash): distinct word shingles sorted by both. A text of fewer words has one, of all of them."""
    whose, hashes = [], []
    for first, pieces in blocks(texts):
        data = b"\n".join(pieces)
        ends = np.cumsum([len(p) + 1 for p in pieces])
        start, h = word_hashes(data, seed)
        whose.append(np.searchsorted(ends, start, side="right") + first)
        hashes.append(h)
    doc = np.concatenate(whose) if whose else np.zeros(0, np.int64)
    word = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    count = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    place = np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    left = count[doc] - place
    # Words from here to the shingle's end: as many as asked for, or all of a text that has fewer.
    at = np.flatnonzero((left >= words) | (place == 0))
    out = np.zeros(len(at), np.uint64)
    for n in range(words):
        have = left[at] > n
        step = np.where(have, word[np.minimum(at + n, len(word) - 1)], U(0))
        out = stir(out * SPREAD + step + U(n + 1)) if len(at) else out
    d = doc[at]
    o = np.lexsort((out, d))
    d, out = d[o], out[o]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (out[1:] != out[:-1])
    return d[new], out[new]


def sketch(doc: np.ndarray, shingle: np.ndarray, docs: int, bins: int) -> np.ndarray:
    """Fast similarity sketch of each set: a matrix of docs x bins.

    In round i < bins every element is placed in the bin that its i-th hash names; in round bins + j
    every element is placed in bin j. A bin keeps its least (round, hash). A set is done after the
    round in which its last bin filled, so after 2 * bins rounds all sets are; values of two sets agree
    in a bin with probability of their Jaccard similarity, as concentrated as for as many draws.
    """
    empty = U(0xFFFFFFFFFFFFFFFF)
    out = np.full(docs * bins, empty, np.uint64)
    for i in range(2 * bins):
        h = mix(shingle + U((int(SPREAD) * (i + 1)) & (1 << 64) - 1))
        at = doc * bins + ((h & U(0xFFFFFFFF)) * U(bins) >> U(32)).astype(np.int64) if i < bins else doc * bins + (i - bins)
        np.minimum.at(out, at, (U(i) << U(54)) | (mix(h) >> U(10)))
        undone = (out.reshape(docs, bins) == empty).any(axis=1)[doc]
        if not undone.any():
            break
        doc, shingle = doc[undone], shingle[undone]
    return out.reshape(docs, bins)


def band_hashes(table: np.ndarray, rows: int) -> np.ndarray:
    docs, bins = table.shape
    parts = table.reshape(docs, bins // rows, rows)
    out = np.broadcast_to(np.arange(bins // rows, dtype=np.uint64), (docs, bins // rows))
    for r in range(rows):
        out = mix(out * SPREAD + parts[:, :, r])
    return out


def text_groups(batches, column: int):
    """(slice of a batch, its texts as bytes), about a block of text at a time."""
    for batch in batches:
        texts, first, size = [], 0, 0
        for n, text in enumerate(batch.column(column)):
            data = text.as_buffer().to_pybytes()
            if texts and size + len(data) > BLOCK:
                yield batch.slice(first, len(texts)), texts
                texts, first, size = [], n, 0
            texts.append(data)
            size += len(data)
        if texts:
            yield batch.slice(first, len(texts)), texts


def sketches(words: int, bands: int, rows: int, seed: int):
    def task(batches):
        for part, texts in text_groups(batches, 2):
            doc, h = shingles_of(texts, words, seed)
            docs = len(texts)
            n = np.bincount(doc, minlength=docs)
            some = np.flatnonzero(n)
            dense = np.cumsum(n > 0) - 1
            a, b = np.zeros(docs, np.uint64), np.zeros(docs, np.uint64)
            lists = np.zeros((docs, 0), np.int64)
            offsets = np.zeros(docs + 1, np.int32)
            values = np.zeros(0, np.int64)
            if len(some):
                starts = (np.cumsum(n) - n)[some]
                a[some] = np.add.reduceat(mix(h), starts)
                b[some] = np.add.reduceat(mix(h ^ SPREAD), starts)
                lists = band_hashes(sketch(dense[doc], h, len(some), bands * rows), rows)
                values = lists.reshape(-1).view(np.int64)
                offsets[1:] = np.cumsum(np.where(n > 0, bands, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(n.astype(np.int64)),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=["uid", "doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return task


def whole_sets(words: int, seed: int):
    def task(batches):
        for part, texts in text_groups(batches, 1):
            doc, h = shingles_of(texts, words, seed)
            n = np.bincount(doc, minlength=len(texts))
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
                names=["uid", "shingles"],
            )

    return task


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (u, v) whose whole sets are similar enough."""
    a = sets.select(F.col("uid").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("uid").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(a, "u").join(b, "v")
        .withColumn("both", both)
        .where(100 * F.col("both") >= percent * (F.size("a") + F.size("b") - F.col("both")))
        .select("u", "v")
    )


#: Documents, and shingles, of a block of one leader's followers.
FOLLOWERS, BLOCK_SHINGLES = 1024, 1 << 20


def across(led: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components, among the followers of each leader; see near_components(), step 3."""
    root_of = roots.select(F.col("node").alias("u"), "root")
    lead_root = roots.select(F.col("node").alias("v"), F.col("root").alias("lead_root"))
    both = led.select("u", "v", "n").unionByName(led.groupBy("v").agg(F.max("m").alias("n")).select(F.col("v").alias("u"), "v", "n"))
    both = (
        both.join(root_of, "u", "left").join(lead_root, "v", "left")
        .select("v", "u", "n", F.coalesce("root", "u").alias("root"), F.coalesce("lead_root", "v").alias("lead_root"))
        .withColumn("out", F.col("root") != F.col("lead_root"))
    )
    both = materialise(both, "followers")
    blocks_of = F.greatest(F.ceil(F.count("*") / FOLLOWERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    parts = both.groupBy("v").agg(blocks_of.alias("parts"), F.count_if("out").alias("n_out")).where("n_out > 0")
    dealt = both.join(parts, "v").select("v", "u", "root", "out", "parts")
    # Every follower stands in one block; those outside the leader's component are compared with all blocks.
    every = dealt.select("v", "u", "root", F.pmod(F.xxhash64("u"), "parts").cast("int").alias("j"), F.lit(0).alias("side"))
    outer = dealt.where("out").select("v", "u", "root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), F.lit(1).alias("side"))
    rows = every.unionByName(outer).withColumnRenamed("u", "uid").join(sets, "uid")
    rows = rows.withColumn("cell", F.xxhash64("v", "j")).select("cell", "side", "uid", "root", "shingles")
    sorted_rows = rows.repartition("cell").sortWithinPartitions("cell", "side", "uid")
    found = materialise(sorted_rows.mapInArrow(released(linked(percent)), "u long, v long").distinct(), "across")
    drop_table(both)
    return found


class Cell:
    """Sets of side 0 of a cell, held; sets of side 1 are compared with them one by one."""

    def __init__(self, percent: int):
        self.percent, self.uid, self.root, self.lists = percent, [], [], []
        self.held, self.parent = None, {}

    def top(self, x: int) -> int:
        while self.parent.get(x, x) != x:
            x = self.parent[x]
        return x

    def add(self, uid: int, root: int, shingles: np.ndarray) -> None:
        self.uid.append(uid)
        self.root.append(root)
        self.lists.append(shingles)

    def links(self, uid: int, root: int, shingles: np.ndarray):
        """Links of one set to those held, one for each two components that it joins."""
        n = len(self.uid)
        if not n:
            return
        if self.held is None:
            self.size = np.array([len(x) for x in self.lists])
            held, own = np.concatenate(self.lists), np.repeat(np.arange(n), self.size)
            order = np.argsort(held, kind="stable")
            self.held, self.own, self.lists = held[order], own[order], []
            self.ids = np.array(self.uid)
        a, b = np.searchsorted(self.held, shingles, "left"), np.searchsorted(self.held, shingles, "right")
        span = b - a
        if not span.any():
            return
        at = np.repeat(a - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        both = np.bincount(self.own[at], minlength=n)
        for m in np.flatnonzero((100 * both >= self.percent * (len(shingles) + self.size - both)) & (self.ids != uid)):
            x, y = self.top(root), self.top(self.root[m])
            if x != y:
                self.parent[x] = y
                yield uid, int(self.ids[m])


def linked(percent: int):
    """For rows sorted by cell and side: links of side 1 to side 0."""

    def task(batches):
        last, cell, found = None, None, []
        for batch in batches:
            cells, sides, uids, roots = (batch.column(c).to_pylist() for c in range(4))
            lists = batch.column(4)
            for k in range(batch.num_rows):
                if cells[k] != last:
                    last, cell = cells[k], Cell(percent)
                shingles = lists[k].values.to_numpy()
                if sides[k]:
                    found += cell.links(uids[k], roots[k], shingles)
                else:
                    cell.add(uids[k], roots[k], shingles.copy())
            if found:
                yield pa.RecordBatch.from_pydict({"u": [u for u, _ in found], "v": [v for _, v in found]})
                found = []

    return task


def near_components(
    docs: DataFrame,
    *,
    percent: int = 75,
    words: int = 5,
    bands: int = 48,
    rows: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Components of documents linked by near-duplication, one row for each row.

    Columns: doc_id, n_shingles, component_id, kept (the component's first row), and with carry text
    and row, a struct of the other input columns.

    A text's set are its distinct shingles of ``words`` words (ASCII letters lower-cased, split at ASCII
    white space); a shorter text has one shingle of all its words, a text without words none, and it is
    linked with nothing. Two documents are linked if 100 * |A and B| >= percent * |A or B|.

    1. Sketch every set; documents with equal sets become a class with one representative.
    2. Band: representatives that share a band fall in a bucket, led by the member that shares most bands
       overall. All are paired with their leaders, a row each, and pairs with two bands or more in common
       are verified on whole sets. Two sets at 75 % share no band of 48 with a probability of 1e-8.
    3. Two sets that share a band share its leader. So of each leader's followers those that are not yet in
       its component are compared with the leader and all the others, exactly and in blocks of a bounded size, and
       links between components are kept: none is lost, and no pair leaves a task that isn't a link.
    4. Components by stars over the links; every member takes its class's component.

    Nothing is capped. Null texts count as empty. Null ids come first, rows that share an id are
    documents of their own. An empty table gives no rows.
    """
    base, seed = with_uid(docs, id_col, text_col, carry), new_seed()
    table = materialise(
        base.select("uid", "doc_id", "text").mapInArrow(released(sketches(words, bands, rows, seed)), SKETCHES), "sketches"
    )
    sets_key = ["set_a", "set_b", "n_shingles"]
    # Written, so that a class of very many copies can be split in the join below.
    classes = materialise(table.where("n_shingles > 0").groupBy(*sets_key).agg(F.min("uid").alias("rep")), "classes")
    members = materialise(
        table.join(classes, sets_key, "left").select(
            "uid", "doc_id", "n_shingles", F.coalesce("rep", "uid").alias("rep"), F.when(F.col("rep") == F.col("uid"), F.col("bands")).alias("bands")
        ),
        "members",
    )
    drop_table(classes)
    drop_table(table)
    placed = members.where("bands is not null").select("uid", "n_shingles", F.explode("bands").alias("band"))
    counts = placed.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialise(placed.join(counts, "band"), "bands")
    score = shared.groupBy("uid").agg(F.sum("size").alias("score"))
    lead = (
        shared.join(score, "uid")
        .groupBy("band")
        .agg(F.max(F.struct("score", (-F.col("uid")).alias("uid"), "n_shingles")).alias("lead"))
        .select("band", (-F.col("lead.uid")).alias("v"), F.col("lead.n_shingles").alias("m"))
    )
    led = materialise(
        shared.join(lead, "band").where(F.col("uid") != F.col("v"))
        .groupBy(F.col("uid").alias("u"), "v").agg(F.count("*").alias("bands"), F.first("n_shingles").alias("n"), F.first("m").alias("m")),
        "led",
    )
    alike = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    stars = led.where(alike & (F.col("bands") > 1)).select("u", "v")
    wanted = shared.select("uid").distinct()
    sets = materialise(
        base.select("uid", "text").join(wanted, "uid", "left_semi").mapInArrow(released(whole_sets(words, seed)), "uid long, shingles array<long>"),
        "sets",
    )
    drop_table(shared)
    links = materialise(verified(stars, sets, percent), "verified")
    roots = components(links)
    more = across(led, roots, sets, percent)
    drop_table(led)
    drop_table(sets)
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    placed_in = members.join(roots, F.col("rep") == F.col("node"), "left").select(
        "uid", "doc_id", "n_shingles", F.coalesce("root", "rep").alias("root")
    )
    names = members.select(F.col("uid").alias("root"), F.col("doc_id").alias("component_id"))
    out = placed_in.join(names, "root").select(
        "uid", "doc_id", "n_shingles", "component_id", (F.col("uid") == F.col("root")).alias("kept")
    )
    if carry:
        out = out.join(base.select("uid", "row", "text"), "uid")
        return out.drop("uid")
    return out.drop("uid")
