"""Ranked lexical search: trees of maxima over ranges of documents, searched best first."""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import materialise, released

#: Items, and bytes of their texts, that travel with the tasks at once; more are searched for block by block.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 16 << 20
#: Documents of one tree: 64 in a leaf, 8 leaves in a node, 16 nodes below the root.
FANS = (64, 8, 16)
RANGE = 64 * 8 * 16
#: Bytes of a text that are split into terms at a time.
CHUNK = 4 << 20
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"

#: Every byte as itself or, of those that end a term, a space; A-Z in lower case. Bytes of other characters are terms'.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(data: bytes):
    """Terms of a UTF-8 text, some at a time."""
    data, at = data.translate(FOLD), 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def counted(number: dict[bytes, int]):
    """(doc_id, terms of the document with repeats, numbers of its listed terms, how often each occurs)."""

    def task(batches):
        for batch in batches:
            sizes, lengths, found, often = [], [], [], []
            for text in batch.column(1):
                n, tf = 0, Counter()
                for part in terms_of(text.as_buffer().to_pybytes()) if text.is_valid else ():
                    n += len(part)
                    tf.update(map(number.get, part))
                tf.pop(None, None)
                sizes.append(n)
                lengths.append(len(tf))
                found.extend(tf.keys())
                often.extend(tf.values())
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return task


class MaxTree:
    """For every term a tree of the greatest contributions in ranges of documents.

    A level is a sorted list of keys (term, node) with their maxima; level 0 has the documents themselves.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.levels, width = [], RANGE
        key = term.astype(np.int64) * width + doc
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        self.levels.append((width, key, value))
        for fan in FANS:
            term, node = key // width, key % width // fan
            width //= fan
            key = term * width + node
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            value = np.maximum.reduceat(value, first) if len(first) else value
            key = key[first]
            self.levels.append((width, key, value))

    def below(self, level: int, node: int, terms: np.ndarray) -> tuple[int, np.ndarray]:
        """(first child, summed maxima of each child) of a node of level + 1."""
        width, key, value = self.levels[level]
        fan = FANS[level] if level < len(FANS) else 1
        a = np.searchsorted(key, terms * width + node * fan)
        span = np.searchsorted(key, terms * width + node * fan + fan) - a
        at = np.repeat(a - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        sums = np.zeros(fan, np.int64)
        np.add.at(sums, key[at] % width - node * fan, value[at])
        return node * fan, sums


class Top:
    """The k best (score, document) of an item so far: higher scores, then lower places in order."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc: tuple) -> None:
        entry = (score, tuple(-x for x in doc))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def search_tree(tree: MaxTree, docs: list[tuple], terms: np.ndarray, top: Top) -> int:
    """Add the tree's documents that belong among an item's best; returns how many leaves were opened.

    The node with the highest bound is opened first. A node whose bound equals the k-th score may hold a document
    that ties with it and has a smaller id, so it is opened too.
    """
    opened = 0
    _, root = tree.below(len(FANS), 0, terms)
    frontier = [(-int(root[0]), len(FANS), 0)]
    while frontier and -frontier[0][0] >= top.least:
        _, level, node = heapq.heappop(frontier)
        first, bounds = tree.below(level - 1, node, terms)
        good = np.flatnonzero(bounds >= top.least)
        if level > 1:
            for x in good:
                heapq.heappush(frontier, (-int(bounds[x]), level - 1, first + int(x)))
            continue
        opened += 1
        for x in good:
            top.add(int(bounds[x]), docs[first + int(x)])
    return opened


def searched(items: list[tuple[int, np.ndarray]], weight: np.ndarray, total: int, tokens: int, k: int):
    """The k best documents of a task for each item (item, terms)."""

    def task(batches):
        tops = {item: Top(k) for item, _ in items}
        held = {"docs": [], "doc": [], "term": [], "value": []}

        def search() -> None:
            if held["docs"]:
                tree = MaxTree(*(np.concatenate(held[c]) for c in ("doc", "term", "value")))
                for item, terms in items:
                    search_tree(tree, held["docs"], terms, tops[item])
                for part in held.values():
                    part.clear()

        for batch in batches:
            # A document without an id comes after all others.
            ids = [(1, 0) if i is None else (0, i) for i in batch.column(0).to_pylist()]
            m = np.array([10 + 90 * n * total // tokens for n in batch.column(1).to_pylist()], np.int64)
            lists, tfs = batch.column(2), batch.column(3).flatten().to_numpy()
            size = np.diff(lists.offsets.to_numpy())
            term = lists.flatten().to_numpy()
            value = weight[term] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, size)))
            ends = np.concatenate([[0], np.cumsum(size)])
            at = 0
            while at < len(ids):
                have = len(held["docs"])
                stop = min(len(ids), at + RANGE - have)
                a, z = ends[at], ends[stop]
                held["doc"].append(have + np.repeat(np.arange(stop - at), size[at:stop]))
                held["term"].append(term[a:z])
                held["value"].append(value[a:z])
                held["docs"] += ids[at:stop]
                if len(held["docs"]) == RANGE:
                    search()
                at = stop
        search()
        found = [(item, *(-x for x in doc), score) for item, top in tops.items() for score, doc in top.heap]
        if found:
            item, missing, doc, score = zip(*found)
            ids = pa.array([None if gone else d for gone, d in zip(missing, doc)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return task


def term_lists(batches):
    """(item_id, its distinct terms)."""
    for batch in batches:
        terms = [sorted({t for part in terms_of(x.as_buffer().to_pybytes()) for t in part}) if x.is_valid else [] for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, all if fewer score above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. With N
    documents that have a term, L terms with repeats in all, n of a document, df documents with a term and tf of its
    occurrences in one, a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))) and a document's score is the sum of
    w * (10^9 * tf div (1000 * tf + 8m)) over the item's distinct terms, with m = 10 + 90 * n * N div L.

    1. One pass over the texts counts the items' terms in each document; the counts are written, the texts not read again.
    2. N, L and every df come from that table.
    3. Each task takes its documents in ranges of 8192 and builds a tree of maxima for each term; an item opens the node
       with the highest summed bound first, those that equal its k-th score for ties, and what it found in one range
       prunes the next. Tasks send k rows an item. Nothing is shuffled by term, so frequent terms make no large task.

    Exact. Memory of a task: a range's counts. Items travel with the tasks in blocks of bounded size; more than one block
    means a pass for each. Equal scores go by ascending doc_id, documents without an id last; rows that share an id are
    documents of their own. Null texts and items have no terms; an item with no match gives no row; rows of items that
    are equal in id and text are one, others are searched each on its own. Texts are split some megabytes at a time,
    however long. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    asked = materialise(
        asked.mapInArrow(released(term_lists), "item_id long, terms array<binary>").where(F.size("terms") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t))
    n, total_bytes = asked.agg(F.count("*"), F.sum(size)).first()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = max(-(-n // block_items), -(-(total_bytes or 0) // BLOCK_BYTES), 1)
    found, stats = None, None
    for b in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # a block
        number = {t: i for i, t in enumerate(sorted({bytes(t) for r in held for t in r.terms}))}
        if not number:
            continue
        postings = materialise(rows.mapInArrow(released(counted(number)), POSTINGS), "postings")
        stats = stats or postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = np.zeros(len(number), np.int64)
        for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block
            df[r[0]] = r[1]
        total, tokens = stats[0], stats[1] or 0
        weight = np.floor(1000 * np.log((2 * total + 2) / (2 * df + 1))).astype(np.int64)
        lists = [(r.item, np.array([number[bytes(t)] for t in r.terms], np.int64)) for r in held]
        hits = postings.where(F.size("terms") > 0).mapInArrow(
            released(searched(lists, weight, total, tokens, k)), "item long, doc_id long, score long"
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""WITH d AS (SELECT doc_id, {TERMS.format("text")} AS t FROM documents WHERE text IS NOT NULL),
    c AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
    s AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS l FROM c),
    q AS (SELECT DISTINCT item_id, unnest({TERMS.format("text")}) AS term FROM benchmark),
    p AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM c SEMI JOIN q USING (term) GROUP BY doc_id, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
    x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l)))) AS BIGINT) AS score
    FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 10"""
