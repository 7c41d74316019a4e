"""Approximate nearest neighbours: cross-polytope hashing with several probes, exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.negatives import integers, matrices
from docloom.llm.shared import materialise, released

#: Points of a cell that a task holds; a cell with more is dealt to parts. Queries that meet them at a time.
PART, ASKED = 1 << 15, 256
#: A further hash function is added while cells would hold more points than this on average.
CELL = 4096
#: Queries of the sample on which the number of probes is measured, and the share of neighbours it has to find there.
SAMPLE, TARGET = 64, 0.97
#: Shells of norm at most, and the least relative distance between their bounds.
SHELLS, APART = 8, 0.05


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    width, step = x.shape[1], 1
    while step < width:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), width)
        step *= 2
    return x / np.sqrt(max(width, 1))


def widths_for(points: int, dim: int) -> list[int]:
    """Axes of each hash function, so that cells hold about CELL points: full cross-polytopes, the last cut as needed."""
    full = 1 << max(dim - 1, 0).bit_length()
    widths, cells = [full], 2 * full
    while points > CELL * cells:
        most = min(full, 1 << max(0, (points // (CELL * cells)).bit_length() - 2))
        widths.append(most)
        cells *= 2 * most
    return widths


class Polytopes:
    """Tables of concatenated cross-polytope hashes over unit directions, with a shell of norm in front.

    A rotation is three rounds of random signs and a Hadamard transform; a direction's hash is its largest coordinate's
    axis and sign. Signs follow from seed, table and function only, so every task has the same.
    """

    def __init__(self, dim: int, widths: list[int], shells: np.ndarray, tables: int, seed: int):
        self.dim, self.widths, self.shells, self.tables = dim, widths, shells, tables
        self.full = 1 << max(dim - 1, 0).bit_length()
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], (tables, len(widths), 3, self.full))

    def gaps(self, unit: np.ndarray, table: int, function: int) -> np.ndarray:
        """For every row and signed axis how far it stays behind the nearest one, squared."""
        x = np.zeros((len(unit), self.full))
        x[:, : self.dim] = unit
        for signs in self.signs[table, function]:
            x = hadamard(x * signs)
        x = x[:, : self.widths[function]]
        both = np.concatenate([x, -x], axis=1)
        return (both.max(axis=1, keepdims=True) - both) ** 2

    def parts(self, points: np.ndarray):
        """(unit directions, norms)."""
        most = np.abs(points).max(axis=1, keepdims=True, initial=0)
        scaled = points / np.where(most > 0, most, 1)
        size = np.linalg.norm(scaled, axis=1, keepdims=True)
        return scaled / np.where(size > 0, size, 1), (size * most)[:, 0]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """The cell of every row in every table."""
        unit, norm = self.parts(points)
        out = np.empty((len(points), self.tables), np.int64)
        for t in range(self.tables):
            code = np.searchsorted(self.shells, norm, side="right").astype(np.int64)
            for f, width in enumerate(self.widths):
                code = code * (2 * width) + self.gaps(unit, t, f).argmin(axis=1)
            out[:, t] = code * self.tables + t
        return out

    def probes(self, points: np.ndarray, most: int) -> np.ndarray:
        """Of every row and table the nearest cells, nearest first, at most so many: rows x tables x cells."""
        unit, norm = self.parts(points)
        edges = np.r_[0.0, self.shells, np.inf]
        outside = np.maximum(np.maximum(edges[None, :-1] - norm[:, None], norm[:, None] - edges[None, 1:]), 0)
        shell_gap = (outside / np.where(norm > 0, norm, 1)[:, None]) ** 2
        out = []
        for t in range(self.tables):
            gap, code = shell_gap, np.broadcast_to(np.arange(shell_gap.shape[1]), shell_gap.shape)
            for f, width in enumerate(self.widths):
                # A cell among the best has a prefix among the best, so no more prefixes than cells are carried on.
                step = self.gaps(unit, t, f)
                gap = (gap[:, :, None] + step[:, None, :]).reshape(len(points), -1)
                code = (code[:, :, None] * (2 * width) + np.arange(2 * width)).reshape(len(points), -1)
                near = np.argsort(gap, axis=1, kind="stable")[:, :most]
                gap, code = np.take_along_axis(gap, near, 1), np.take_along_axis(code, near, 1)
            out.append(code * self.tables + t)
        return np.stack(out, axis=1)

    def cells(self) -> int:
        """Cells of a table."""
        return int(np.prod([2.0 * w for w in self.widths])) * (len(self.shells) + 1)


def hashed(kinds: dict[int, Polytopes], probes: int):
    """(uid, cells) of rows (uid, v): their own, or those to probe if probes. The vector's length is part of a cell."""

    def task(batches):
        for batch in batches:
            for at, points in matrices(batch, 1):
                d = points.shape[1]
                if d not in kinds:
                    continue
                for a in range(0, len(at), 512):
                    some = points[a : a + 512].astype(np.float64)
                    found = kinds[d].probes(some, probes).reshape(len(some), -1) if probes else kinds[d].codes(some)
                    offsets = np.arange(len(some) + 1, dtype=np.int32) * found.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array((found * 65536 + d).ravel()))
                    rows = batch.take(pa.array(at[a : a + 512]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "cells"])

    return task


def nearest(table: np.ndarray, names: tuple, asked: np.ndarray, k: int):
    """(row of asked, row of table, distance) of the k nearest: distances as sums of squared differences, ties by names."""
    near = np.broadcast_to(True, (len(asked), len(table)))
    if len(table) > k:
        with np.errstate(all="ignore"):
            p, q = (table**2).sum(1), (asked**2).sum(1)
            rough = p[None] + q[:, None] - 2 * (asked @ table.T)
            # The product's rounding is far below this; all within it are measured exactly.
            slack = 1e-9 * (q + p.max())
            near = ~(rough > (np.partition(rough, k - 1, axis=1)[:, k - 1] + slack)[:, None])
    row, at = np.nonzero(near)
    with np.errstate(over="ignore"):
        far = np.concatenate([np.sqrt(((table[at[a : a + 65536]] - asked[row[a : a + 65536]]) ** 2).sum(1)) for a in range(0, len(at), 65536)] or [np.zeros(0)])
    order = np.lexsort((names[1][at], names[0][at], far, row))
    row, at, far = row[order], at[order], far[order]
    good = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[good], at[good], far[good]


HITS = "asked long, uid long, least long, score double"


def in_cells(k: int):
    """For rows (cell, part, side, uid, least, v) sorted by cell, part, side: points, then queries."""

    def task(batches):
        last, points = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part, side = (integers(batch.column(c)) for c in range(3))
            cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1]), True])
            for a, z in zip(cuts[:-1], cuts[1:]):
                if (cell[a], part[a]) != last:
                    last, points = (cell[a], part[a]), []
                some = batch.slice(a, z - a)
                (_, table), = matrices(some, 5)
                table = table.astype(np.float64)
                if side[a] == 0:
                    points.append((integers(some.column(3)), integers(some.column(4)), table))
                    continue
                if not points:
                    continue
                if len(points) > 1:
                    points = [tuple(map(np.concatenate, zip(*points)))]
                uid, least, held = points[0]
                asked = integers(some.column(3))
                for n in range(0, len(table), ASKED):
                    row, at, far = nearest(held, (least, uid), table[n : n + ASKED], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (asked[n : n + ASKED][row], uid[at], least[at], far)], names=["asked", "uid", "least", "score"]
                    )

    return task


def scanned(held: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """The k nearest points of a task for each of a few queries: (asked, uid, least, score, v)."""

    def task(batches):
        for batch in batches:
            for at, table in matrices(batch, 2):
                if table.shape[1] in held:
                    uid, least = integers(batch.column(0))[at], integers(batch.column(1))[at]
                    ids, asked = held[table.shape[1]]
                    for a in range(0, len(at), PART):
                        row, near, far = nearest(table[a : a + PART].astype(np.float64), (least[a:], uid[a:]), asked, k)
                        lists = batch.column(2).take(pa.array(at[a:][near]))
                        columns = [pa.array(ids[row]), pa.array(uid[a:][near]), pa.array(least[a:][near]), pa.array(far), lists]
                        yield pa.RecordBatch.from_arrays(columns, names=["asked", "uid", "least", "score", "v"])

    return task


def first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asked").orderBy("score", "least", "uid")
    return hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def probes_needed(kinds: dict[int, Polytopes], queries: dict[int, tuple], found: list, target: float) -> int:
    """The fewest probes a table that find the target share of the sample's true neighbours."""
    ranks = []
    for d, (ids, asked) in queries.items():
        mine = [r for r in found if len(r.v) == d]
        if mine:
            kind, place = kinds[d], {q: n for n, q in enumerate(ids.tolist())}
            own = kind.codes(np.array([r.v for r in mine], np.float64))
            most = 64
            while True:
                cells = kind.probes(asked, most)
                rank = np.full(len(mine), np.iinfo(np.int64).max)
                for n, r in enumerate(mine):
                    hit = np.flatnonzero((cells[place[r.asked]] == own[n][:, None]).any(axis=0))
                    rank[n] = hit[0] + 1 if len(hit) else rank[n]
                if (rank <= most).mean() >= target or most >= kind.cells():
                    break
                most *= 4
            ranks.append(rank)
    every = np.sort(np.concatenate(ranks)) if ranks else np.ones(1, np.int64)
    return int(every[min(len(every) - 1, int(np.ceil(target * len(every))) - 1)])


def nearest_neighbours(
    rows: DataFrame,
    queries: str,
    k: int = 10,
    *,
    tables: int = 8,
    target: float = TARGET,
    seed: int = 11,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k nearest other rows of each row where the SQL condition ``queries`` holds.

    Nearness is Euclidean distance in double precision on the vectors as they are; ties go to the smaller id.

    1. Equal vectors are one point with its k + 1 least ids: more of them can't be in any result. Equal queries are one.
    2. Points are hashed in ``tables`` tables: the shell of their norm (bounds from the quantiles of all norms; one shell
       where norms hardly differ), and the nearest signed axes of their direction after fast pseudo-rotations. The number
       of axes follows from the number of points. Every point is in every table.
    3. Probes are fitted on a sample of 64 queries: their true neighbours are found among all points in one pass, and
       the least number of cells a table is taken that finds 97 % of them, up to all cells.
    4. Points and probing queries meet by cell; a cell of over 2^15 points is dealt to parts, and queries go to all of them.
       A task holds one part, measures with a matrix product and exactly near the k-th, and sends k rows a query.
    5. A query that met fewer rows than k is searched among all points, in parts. No cell is cut, no candidate dropped.

    Rows whose vector is null, empty, zero or holds a null or non-finite component take no part. Vectors of different
    lengths are at no distance. A row without an id is a candidate after those with one at the same distance. Rows that are
    equal in id and vector are one row; others that share an id are rows of their own, as queries and as answers. Distances beyond double precision are infinite. Other columns, whatever their names, are left out; without
    rows or queries there is no row.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    finite = lambda v: F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = rows.schema[vector_col].dataType.simpleString()
    vector = F.col(vector_col).cast(kind if kind in ("array<float>", "array<double>") else "array<double>")
    clean = (
        rows.withColumn("_asks", F.coalesce(F.expr(queries), F.lit(False)))
        .select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.col("_asks").alias("asks"))
        .where(F.col("v").isNotNull()).where(finite("v") & F.exists("v", lambda x: x != 0))
        .groupBy(F.xxhash64("v").alias("h"), "v", "id").agg(F.bool_or("asks").alias("asks"))
    )
    same = Window.partitionBy("h", "v").orderBy(F.asc_nulls_last("id"))
    few = clean.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    last = F.lit((1 << 63) - 1)
    points = materialise(
        few.groupBy("h", "v").agg(F.array_sort(F.collect_list(F.coalesce("id", last))).alias("ids"), F.count_if(F.col("id").isNull()).alias("nameless"))
        .withColumn("uid", F.monotonically_increasing_id()).withColumn("least", F.element_at("ids", 1)),
        "points",
    )
    asks = materialise(
        clean.where("asks").select(F.col("id").alias("query_id"), "h", "v")
        .join(points.select("h", "v", "uid"), ["h", "v"]).select("query_id", F.col("uid").alias("asked")),
        "asks",
    )
    asked = materialise(asks.select(F.col("asked").alias("uid")).distinct().join(points.select("uid", "least", "v"), "uid"), "asked")
    sample = asked.orderBy(F.xxhash64("uid", F.lit(seed)), "uid").limit(SAMPLE).collect()  # at most SAMPLE rows
    if not sample:
        return empty
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    norms = F.percentile_approx(size, [n / SHELLS for n in range(1, SHELLS)], 1000)
    dims = points.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), norms.alias("q")).orderBy(F.desc("n")).limit(1000).collect()
    kinds = {}
    for r in dims:
        shells = []
        for x in r.q:
            if np.isfinite(x) and (not shells or x > shells[-1] * (1 + APART)) and x > r.q[0] * (1 + APART):
                shells.append(x)
        kinds[r.d] = Polytopes(r.d, widths_for(r.n, r.d), np.array(shells), tables, seed)
    held = {}
    for d in {len(r.v) for r in sample} & kinds.keys():
        mine = [r for r in sample if len(r.v) == d]
        held[d] = (np.array([r.uid for r in mine], np.int64), np.array([r.v for r in mine], np.float64))
    true = first(
        points.select("uid", "least", "v").mapInArrow(released(scanned(held, k + 1)), f"{HITS}, v {points.schema['v'].dataType.simpleString()}"), k + 1
    )
    probes = probes_needed(kinds, held, true.collect(), target)  # k + 1 rows for each of the sample

    placed = materialise(
        points.select("uid", "v", "least").mapInArrow(released(hashed(kinds, 0)), f"uid long, v {points.schema['v'].dataType.simpleString()}, least long, cells array<long>"),
        "placed",
    ).select("uid", "least", "v", F.explode("cells").alias("cell"))
    probing = asked.select("uid", "v", "least").mapInArrow(
        released(hashed(kinds, probes)), f"uid long, v {points.schema['v'].dataType.simpleString()}, least long, cells array<long>"
    ).select("uid", "least", "v", F.explode("cells").alias("cell"))
    found = materialise(first(met(placed, probing, k + 1).groupBy("asked", "uid", "least").agg(F.min("score").alias("score")), k + 1), "found")
    # A point's ids count, so one that many share answers alone.
    rows_of = found.join(points.select("uid", F.size("ids").alias("m")), "uid").groupBy("asked").agg(F.sum("m").alias("m"))
    short = asked.join(rows_of.where(F.col("m") > k), asked["uid"] == F.col("asked"), "left_anti")
    short = materialise(short, "short")
    if not short.isEmpty():
        everywhere = lambda t: t.select("uid", "least", "v", F.size("v").cast("long").alias("cell"))
        more = met(everywhere(points), everywhere(short), k + 1)
        found = found.drop("n").join(short.select(F.col("uid").alias("asked")), "asked", "left_anti").unionByName(more)
        found = first(found, k + 1)
    ids = points.select("uid", "ids", "nameless")
    # Every point's ids with its distance; the k + 1 nearest rows of each query point, itself among them.
    each = found.join(ids, "uid").select("asked", "uid", "score", F.posexplode("ids").alias("n", "id"), (F.size("ids") - F.col("nameless")).alias("named"))
    each = each.withColumn("missing", F.col("n") >= F.col("named"))
    order = Window.partitionBy("asked").orderBy("score", "missing", "id")
    return answers(asks, each.withColumn("n", F.row_number().over(order)), k)


def met(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Hits (asked, uid, least, score) of rows (uid, least, v, cell) that share a cell; large cells are dealt to parts."""
    large = points.groupBy("cell").count().where(F.col("count") > PART)
    parts = large.select("cell", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    parts = materialise(parts, "parts")
    of = F.coalesce("parts", F.lit(1))
    p = points.join(parts, "cell", "left").select("cell", F.pmod(F.xxhash64("uid"), of).cast("int").alias("part"), F.lit(0).alias("side"), "uid", "least", "v")
    q = asked.join(parts, "cell", "left").select("cell", F.explode(F.sequence(F.lit(0), of - 1)).alias("part"), F.lit(1).alias("side"), "uid", "least", "v")
    both = p.unionByName(q).repartition("cell", "part").sortWithinPartitions("cell", "part", "side")
    return both.mapInArrow(released(in_cells(k)), HITS)


def answers(asks: DataFrame, each: DataFrame, k: int) -> DataFrame:
    """The k first of each query's point's rows besides the query itself."""
    listed = each.where(F.col("n") <= k + 1).groupBy("asked").agg(
        F.sort_array(F.collect_list(F.struct("n", "id", "missing", "score", "uid"))).alias("rows")
    )
    own = lambda r: (r["id"] == F.col("query_id")) & ~r["missing"] & (r["uid"] == F.col("asked"))
    others = F.filter("rows", lambda r: ~own(r))
    out = asks.join(listed, "asked").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "r"))
    vec_id = F.when(~F.col("r.missing"), F.col("r.id"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), vec_id.alias("vec_id"), F.col("r.score").alias("score"))
