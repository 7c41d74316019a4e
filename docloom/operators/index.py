"""An inverted-file index: points in folders by their nearest centroid, of which a search reads a few."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import search as R
from docloom.scratch import written

#: Points that centroids are fitted on at most, points that try the number of probes, centroids at most.
FIT, TRIED, CELLS = 1 << 16, 64, 4096
#: Points of a file at most.
FILE = 1 << 18


def unit_rows(table: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(size > 0, size, 1)


def usable(v: str) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and not all zero."""
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def by_hash(rows: DataFrame, name: str, n: int) -> DataFrame:
    """The n rows whose name's hash is least: a sample that doesn't change with the order or the partitions of rows."""
    return rows.orderBy(F.xxhash64(F.col(name).cast("string"), F.lit(7)), name).limit(n)


def centroids_of(points: DataFrame, cells: int, sample: int = FIT, seed: int = 1) -> np.ndarray:
    """At most so many unit centroids of points (id, v) by k-means on directions, fitted on a sample of bounded size."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    some = written(by_hash(points, "id", sample).select(array_to_vector("v").alias("features")), "sample")
    model = KMeans(k=max(cells, 2), seed=seed, distanceMeasure="cosine", maxIter=10).fit(some)
    return unit_rows(np.array(model.clusterCenters()))


def nearest_cells(table: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n nearest cells of every row, nearest first; so many rows at a time as make SCORES products."""
    step = max(1, R.SCORES // max(len(centroids), 1))
    parts = [np.argsort(-(table[a : a + step] @ centroids.T), axis=1, kind="stable")[:, :n].astype(np.int32) for a in range(0, max(len(table), 1), step)]
    return np.concatenate(parts)


def celled(centroids: np.ndarray, n: int):
    """Rows (name, v) with the n nearest cells; those of another length than the centroids, or of length zero, leave."""
    width = centroids.shape[1]

    def task(batches):
        for batch in batches:
            lists = batch.column(1)
            at = np.flatnonzero(np.diff(lists.offsets.to_numpy()) == width)
            for a in range(0, len(at), R.ROWS):
                rows = batch.take(pa.array(at[a : a + R.ROWS]))
                table = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, width)
                some = np.flatnonzero(np.isfinite(table).all(axis=1) & (np.abs(table) > 0).any(axis=1))
                near = nearest_cells(table[some], centroids, n)
                offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * near.shape[1])
                cells = pa.ListArray.from_arrays(offsets, pa.array(near.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([*rows.take(pa.array(some)).columns, cells], names=[*rows.schema.names, "cells"])

    return task


def with_cells(rows: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    name = rows.columns[0]
    return rows.mapInArrow(celled(centroids, n), f"{name} {rows.schema[name].dataType.simpleString()}, v array<double>, cells array<int>")


def probing(held: list, rows: DataFrame, k: int, schema: str) -> DataFrame:
    """Hits of a block of queries (query_id, v, cells), each among the points (id, v, cell) of its cells; points stay where they are."""
    asking: dict[int, list[int]] = {}
    for n, r in enumerate(held):
        for c in r.cells:
            asking.setdefault(c, []).append(n)
    asking = {c: np.array(x, np.int32) for c, x in asking.items()}
    ids, table = [r.query_id for r in held], R.table_of([r.v for r in held])

    def score(batches):
        best = R.Best(ids, table, k)
        for b in batches:
            cell = b.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True]) if len(cell) else []
            for a, z in zip(cuts[:-1], cuts[1:]):
                mine = best.place[asking.get(int(cell[a]), np.zeros(0, np.int32))]
                mine = mine[mine >= 0]
                for c in range(a, z if len(mine) else a, R.ROWS):
                    part = b.slice(c, min(R.ROWS, z - c))
                    best.add(R.names_of(part.column(0)), part.column(1), mine)
        yield from best.rows()

    return rows.select("id", "v", "cell").mapInArrow(score, schema)


class VectorIndex:
    """Points of a folder, in subfolders by cell, and the centroids of the cells.

    Centroids come from k-means over the directions of at most FIT points with the least hashes; every point is indexed. A
    search goes to the cells whose centroids are most alike to the query. How many is measured when the index is built: so
    many as find ``recall`` of the true neighbours of TRIED points, searched exactly among all points.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def build(
        points: DataFrame, path: str, *, id_col: str = "id", vector: str = "body", cells: int | None = None,
        recall: float = 0.95, k: int = 10, seed: int = 1,
    ) -> VectorIndex:
        """Index points; those without a direction or of another length than most aren't found by searches."""
        spark = points.sparkSession
        rows = written(R.pairs_of(points, id_col, vector, "id").where(usable("v")), "points")
        width = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
        same = rows.where(F.size("v") == (width[0].d if width else 0))
        n = same.count()
        cells = min(cells or math.isqrt(n), CELLS, max(n // 2, 1))
        table = centroids_of(same, cells, seed=seed) if n > 3 else np.eye(1, width[0].d if width else 1)
        placed = written(with_cells(same, table, 1).select("id", "v", F.col("cells")[0].alias("cell")), "placed")
        parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / FILE).cast("int").alias("parts"))
        dealt = placed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        dealt.repartition("cell", "part").drop("part", "parts").write.partitionBy("cell").parquet(f"{path}/points")
        index = VectorIndex(spark, path)
        spark.createDataFrame([(c, v.tolist()) for c, v in enumerate(table)], "cell int, v array<double>").coalesce(1).write.parquet(f"{path}/centroids")
        probes = index._probes(placed, table, recall, k) if n else 1
        spark.createDataFrame([(n, len(table), probes)], "points long, cells int, probes int").coalesce(1).write.parquet(f"{path}/settings")
        return index

    def _probes(self, placed: DataFrame, table: np.ndarray, recall: float, k: int) -> int:
        """The least number of cells that hold the share asked for of the neighbours of a few points."""
        tried = by_hash(placed, "id", TRIED).select(F.col("id").alias("query_id"), F.col("v").alias("query_vector"))
        tried = written(tried, "tried")
        near = R.top_k(tried, placed, k + 1, vector="v").where(F.col("id") != F.col("query_id"))
        cells = near.join(placed.select("id", "cell"), "id").select("query_id", "cell").collect()  # TRIED x (k + 1) at most
        held = tried.collect()
        order = nearest_cells(np.array([r.query_vector for r in held]), table, len(table))
        place = {r.query_id: np.argsort(order[n]) for n, r in enumerate(held)}
        ranks = sorted(int(place[r.query_id][r.cell]) + 1 for r in cells)
        return ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)] if ranks else 1

    def settings(self) -> dict:
        """points, cells, probes."""
        return self.spark.read.parquet(f"{self.path}/settings").first().asDict()

    def centroids(self) -> np.ndarray:
        """CELLS rows at most."""
        return np.array([r.v for r in self.spark.read.parquet(f"{self.path}/centroids").orderBy("cell").collect()])

    def points(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/points")

    def search(
        self, queries: DataFrame, k: int = 10, *, probes: int | None = None, query_id: str = "query_id",
        query_vector: str = "query_vector", block: int = R.BLOCK,
    ) -> DataFrame:
        """(query_id, id, score, rank) among the points of each query's ``probes`` nearest cells, by cosine, ties by id.

        A block of queries travels with the tasks, which read the folders of its cells only. More queries are dealt to the
        points' cells, and only cells that someone asks for are read. With as many probes as cells the result is exact.
        """
        k, found = k or 10, self.settings()
        probes = min(probes or found["probes"], found["cells"])
        asked = R.pairs_of(queries, query_id, query_vector, "query_id")
        asked = written(with_cells(asked, self.centroids(), probes), "queries")
        n = asked.count()
        if not found["points"] or not n:
            kind = self.points().schema["id"].dataType.simpleString() if found["points"] else "string"
            schema = f"query_id {asked.schema['query_id'].dataType.simpleString()}, id {kind}, score double, rank int"
            return self.spark.createDataFrame([], schema)
        points = self.points()
        wanted = [r.cell for r in asked.select(F.explode("cells").alias("cell")).distinct().collect()]  # CELLS at most
        read = points.where(F.col("cell").isin(wanted))
        if n <= block:
            return R.ranked_hits(probing(asked.collect(), read, k, R.hit_schema(asked, points)), k)  # at most block rows
        return R.ranked_hits(R.met(read, asked.select("query_id", "v", F.explode("cells").alias("cell")), k), k)


def overlap(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(expected, found, recall): how many of the exact hits (query_id, id) are among those found."""
    both = exact.select("query_id", "id").join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return both.agg(F.count("*").alias("expected"), F.count("hit").alias("found")).withColumn(
        "recall", F.when(F.col("expected") > 0, F.col("found") / F.col("expected")).otherwise(F.lit(1.0))
    )
