"""Hard-negative mining: exact inner-product search over buckets sorted by norm."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import materialise, released

#: Candidates that a task holds at once, and those scored at a time.
PART, BUCKET = 1 << 17, 4096
#: Anchors that meet the candidates of a task at a time.
ANCHORS = 256
#: Components are held within this, so that scores of vectors of up to 1024 components are exact in 64 bits.
LIMIT = float(1 << 26)
NONE = np.iinfo(np.int64).min


class Held:
    """Candidates of one part and one vector length, by falling norm."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, norms: np.ndarray, table: np.ndarray):
        order = np.argsort(-norms, kind="stable")
        self.ids, self.labels, self.table = ids[order], labels[order], table[order]
        self.length = np.sqrt(norms[order].astype(np.float64))
        self.top = int(np.abs(table).max(initial=0))

    def scores(self, anchors: np.ndarray, a: int, z: int) -> np.ndarray:
        # As doubles where every sum of products is a whole number that a double holds.
        if int(np.abs(anchors).max(initial=0)) * self.top * max(anchors.shape[1], 1) < 1 << 53:
            return (anchors.astype(np.float64) @ self.table[a:z].T.astype(np.float64)).astype(np.int64)
        return anchors.astype(np.int64) @ self.table[a:z].T.astype(np.int64)


class Best:
    """The k best (score, id) of each of many slots: higher scores, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, NONE, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        good = place < self.k
        last = place == self.k - 1
        self.least[slot[last]] = score[last]
        self.slot, self.score, self.id = slot[good], score[good], ids[good]


def positives_of(held: Held, ids, labels, lengths, table, k: int) -> Best:
    """Each anchor's best candidates of its own label."""
    best = Best(len(ids), k)
    for a in range(0, len(held.ids), BUCKET):
        # |a| |x| bounds the score, and no later bucket has longer vectors.
        if (lengths * held.length[a] * (1 + 1e-9) < best.least).all():
            break
        z = a + BUCKET
        s = held.scores(table, a, z)
        row, at = np.nonzero((s >= best.least[:, None]) & (held.labels[None, a:z] == labels[:, None]) & (held.ids[None, a:z] != ids[:, None]))
        best.add(row, s[row, at], held.ids[a:z][at])
    return best


def negatives_of(held: Held, labels, lengths, table, low: np.ndarray, high: np.ndarray, k: int) -> Best:
    """For every window (anchor x place) its best candidates of another label."""
    width = low.shape[1]
    best = Best(low.size, k)
    for a in range(0, len(held.ids), BUCKET):
        floor = np.maximum(low, best.least.reshape(low.shape))
        floor = np.where(low > high, np.iinfo(np.int64).max, floor)
        if (lengths * held.length[a] * (1 + 1e-9) < floor.min(axis=1, initial=np.iinfo(np.int64).max)).all():
            break
        z = a + BUCKET
        s = held.scores(table, a, z)
        other = held.labels[None, a:z] != labels[:, None]
        for j in range(width):
            row, at = np.nonzero((s >= floor[:, j, None]) & (s <= high[:, j, None]) & other)
            best.add(row * width + j, s[row, at], held.ids[a:z][at])
    return best


def integers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def matrices(batch: pa.RecordBatch, column: int):
    """(rows, matrix) of each length of vectors in a column of lists."""
    lists = batch.column(column)
    size = np.diff(lists.offsets.to_numpy())
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        some = lists if len(at) == len(size) else lists.take(pa.array(at))
        yield at, some.flatten().to_numpy().reshape(len(at), int(d))


def cells(k: int, windows: bool):
    """For rows (part, side, id, label, norm, v, low, high) sorted by part and side: candidates, then anchors."""

    def meet(held: dict, batch: pa.RecordBatch):
        for at, table in matrices(batch, 5):
            if table.shape[1] not in held:
                continue
            for n in range(0, len(at), ANCHORS):
                rows = batch.take(pa.array(at[n : n + ANCHORS]))
                names, labels = integers(rows.column(2)), integers(rows.column(3))
                lengths = np.sqrt(integers(rows.column(4)).astype(np.float64))
                some = table[n : n + ANCHORS]
                if windows:
                    low, high = rows.column(6).to_pylist(), rows.column(7).to_pylist()
                    width = max(map(len, low))
                    # Places that an anchor doesn't have are windows that nothing meets.
                    lo = np.array([x + [1] * (width - len(x)) for x in low], np.int64).reshape(len(low), width)
                    hi = np.array([x + [0] * (width - len(x)) for x in high], np.int64).reshape(len(high), width)
                    best = negatives_of(held[table.shape[1]], labels, lengths, some, lo, hi, k)
                    anchor, place = best.slot // max(width, 1), best.slot % max(width, 1)
                else:
                    best = positives_of(held[table.shape[1]], names, labels, lengths, some, k)
                    anchor, place = best.slot, np.zeros(len(best.slot), np.int64)
                keys = integers(rows.column(8))
                columns = [keys[anchor], place.astype(np.int32), best.id, best.score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "place", "id", "score"])

    def task(batches):
        last, gathered, held = None, {}, None
        for batch in batches:
            part, side = integers(batch.column(0)), integers(batch.column(1))
            cuts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (side[1:] != side[:-1]), True])
            for a, z in zip(cuts[:-1], cuts[1:]):
                if part[a] != last:
                    last, gathered, held = part[a], {}, None
                some = batch.slice(a, z - a)
                if side[a] == 0:
                    for at, table in matrices(some, 5):
                        rows = gathered.setdefault(table.shape[1], [])
                        rows.append((*(integers(some.column(c))[at] for c in (2, 3, 4)), table.copy()))
                    continue
                if held is None:
                    held = {d: Held(*map(np.concatenate, zip(*rows))) for d, rows in gathered.items()}
                    gathered = {}
                yield from meet(held, some)

    return task


FOUND = "anchor long, place int, id long, score long"


def routed(tops: np.ndarray):
    """Rows (norm, least limit) get the number of parts, counted from the longest, that hold a candidate long enough."""
    lengths = np.sqrt(tops.astype(np.float64))

    def task(batches):
        for b in batches:
            least = integers(b.column(2)).astype(np.float64) / np.maximum(np.sqrt(integers(b.column(1)).astype(np.float64)), 1e-300)
            n = np.searchsorted(-lengths, -least * (1 - 1e-9), side="right")
            n = np.where(integers(b.column(2)) <= 0, len(lengths), n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int32))], names=["key", "parts"])

    return task


def hard_negatives(
    rows: DataFrame,
    anchors: str,
    *,
    positives: int = 5,
    negatives: int = 3,
    scale: float = 256.0,
    window: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors, rows where the SQL
    condition ``anchors`` holds.

    A component x counts as floor(scale * x); the score of two rows is their integer inner product. An anchor's positives
    are its best other rows of its label. For each of them the best rows of other labels are returned whose score lies
    within ``window`` per cent of the positive's. Higher scores come first, ties go by smaller id.

    1. Rows are sorted by norm over all parts (ranges of norm, equal norms dealt by id), a part at most a few times PART.
    2. Every part meets all anchors: the part is held, bucket after bucket by falling norm, anchors stream past. A bucket
       is left out, with all after it, once |anchor| |bucket's longest| lies below the running k-th score of every anchor
       at hand. The best of all parts are the positives.
    3. They give each anchor its windows. Anchors go only to parts whose longest row can reach the lowest window, and
       within a part buckets end by the same bound, the windows' lower limits and the running k-th negative of each.

    Exact: nothing is sampled. Rows with a null id, label, vector or component, or one that isn't finite, take no part.
    Scores exist between vectors of equal length. Rows that share an id are all candidates, never each other's positive;
    equal anchor rows are one anchor, others with the same id are anchors of their own. Scaled components beyond 2^26 count
    as 2^26, so that sums stay whole. Other columns, whatever their names, and empty tables are fine: no rows give none.
    """
    spark = rows.sparkSession
    finite = lambda v: F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(LIMIT)), F.lit(-LIMIT))).cast("int")
    clean = (
        rows.withColumn("_anchor", F.coalesce(F.expr(anchors), F.lit(False)))
        .select(
            F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<double>").alias("v"), F.col("_anchor").alias("anchor"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
        .where(finite("v"))
        .withColumn("v", F.transform("v", whole))
        .withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x))
    )
    clean = materialise(clean, "vectors")
    n = clean.count()
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts = max(-(-n // PART), min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64))
    ranged = clean.drop("anchor").repartitionByRange(parts, F.desc("norm"), F.xxhash64("id"))
    candidates = materialise(ranged.withColumn("part", F.spark_partition_id()), "candidates")
    asked = materialise(
        clean.where("anchor").select("id", "label", "norm", "v").distinct().withColumn("key", F.monotonically_increasing_id()), "anchors"
    )
    # A number for each part.
    tops = {r[0]: r[1] for r in candidates.groupBy("part").agg(F.max("norm")).collect()}
    lengths, top = [], 0
    for p in reversed(range(max(tops) + 1)):
        top = max(top, tops.get(p, 0))
        lengths.append(top)
    lengths = np.array(lengths[::-1], np.int64)  # falls from part to part, also past one without rows

    held = candidates.select(
        "part", F.lit(0).alias("side"), "id", "label", "norm", "v", F.lit(None).cast("array<long>").alias("low"),
        F.lit(None).cast("array<long>").alias("high"), F.lit(None).cast("long").alias("key"),
    )

    def search(ask: DataFrame, k: int, windows: bool) -> DataFrame:
        sent = ask.select("part", F.lit(1).alias("side"), "id", "label", "norm", "v", "low", "high", "key")
        both = held.unionByName(sent).repartitionById(len(lengths), "part").sortWithinPartitions("part", "side")
        found = both.mapInArrow(released(cells(k, windows)), FOUND)
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    every = F.explode(F.sequence(F.lit(0), F.lit(len(lengths) - 1)))
    none = F.lit(None).cast("array<long>")
    best = materialise(search(asked.select("*", every.alias("part"), none.alias("low"), none.alias("high")), positives, False), "positives")
    # ceil(window * score / 100) and floor(): whole numbers, whatever the sign.
    ceil = lambda s: F.expr(f"-((-{s} * {window[0]} - pmod(-{s} * {window[0]}, 100)) div 100)")
    floor = lambda s: F.expr(f"({s} * {window[1]} - pmod({s} * {window[1]}, 100)) div 100")
    windows = (
        best.withColumns({"low": ceil("score"), "high": floor("score")}).groupBy("anchor")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))  # as many as positives
        .select(F.col("anchor").alias("key"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    )
    ask = materialise(asked.join(windows, "key"), "windows")
    least = F.array_min(F.transform(F.arrays_zip("low", "high"), lambda w: F.when(w["low"] <= w["high"], w["low"]).otherwise(F.lit((1 << 63) - 1))))
    parts_of = ask.select("key", "norm", least.alias("least")).mapInArrow(routed(lengths), "key long, parts int").where("parts > 0")
    routes = parts_of.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    found = search(ask.join(routes, "key"), negatives, True)
    names = asked.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    mine = best.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(mine, ["anchor", "place"]).join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


DOT = "CAST(list_dot_product(a.v, b.v) AS BIGINT)"
ORACLE_SQL = f"""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, {DOT} AS score
    FROM e a JOIN e b ON b.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
    p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= 5),
    n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
