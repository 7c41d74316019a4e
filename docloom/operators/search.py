"""Exact vector search with tag boosting, and its evaluation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.scratch import written

#: Queries scored in one pass: bounds what a task holds of them. Up to so many travel with the task itself.
BLOCK = 4096
#: Points scored at a time, and queries that meet the points of a part at a time.
ROWS, QUERIES = 8192, 1024
#: Scores that stand in memory at a time, and hits that wait to be ranked, if k of each query aren't more.
SCORES, WAITING = 1 << 20, 1 << 16
#: Points that a task holds of a cell.
PART = 1 << 17


class Best:
    """The k best points so far of each of a block of queries, ties by id.

    Queries are scored a few at a time, so that memory depends on SCORES and on queries x k.
    """

    def __init__(self, ids: list, table: np.ndarray, k: int):
        lengths = np.linalg.norm(table, axis=1, keepdims=True) if table.size else np.zeros((len(ids), 1))
        usable = np.flatnonzero(lengths[:, 0] > 0)
        self.ids, self.k = [ids[q] for q in usable], k
        self.unit = table[usable] / lengths[usable] if len(usable) else table[:0]
        #: The place of each query among those that can be scored, or -1.
        self.place = np.full(len(ids), -1)
        self.place[usable] = np.arange(len(usable))
        self.floor = np.full(len(usable), -np.inf)
        self.query, self.score, self.name = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object)
        self.new, self.waiting = [], 0

    def add(self, names: np.ndarray, lists: pa.ListArray, queries: np.ndarray | None = None) -> None:
        """Score points for all queries, or those at some places; points of another length than the queries, or of length zero, aren't alike to any."""
        width = self.unit.shape[1] if self.unit.ndim == 2 else 0
        sizes = np.diff(lists.offsets.to_numpy())
        fit = np.flatnonzero(sizes == width)
        if not len(self.ids) or not len(fit):
            return
        if len(fit) < len(sizes):
            lists, names = lists.take(pa.array(fit)), names[fit]
        m = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(names), width)
        size = np.linalg.norm(m, axis=1)
        some = (size > 0) & np.isfinite(size)
        names = names[some]
        if not len(names):
            return
        m = m[some] / size[some, None]
        queries = np.arange(len(self.ids)) if queries is None else queries
        step = max(1, SCORES // len(names))
        for a in range(0, len(queries), step):
            few = queries[a : a + step]
            scores = m @ self.unit[few].T
            floor = self.floor[few]
            if len(names) > self.k:  # all that tie with the k-th
                floor = np.maximum(floor, np.partition(scores, len(names) - self.k, axis=0)[len(names) - self.k])
            at, query = np.nonzero(scores >= floor)
            self.new.append((few[query], scores[at, query], names[at]))
            self.waiting += len(at)
            if self.waiting > max(WAITING, self.k * len(self.ids)):
                self.settle()

    def settle(self) -> None:
        """Rank the hits that wait; from then on a query's hits below its k-th aren't kept."""
        parts = [(self.query, self.score, self.name), *self.new]
        query, score, name = (np.concatenate(x) for x in zip(*parts))
        self.new, self.waiting = [], 0
        order = np.unique(name, return_inverse=True)[1]
        o = np.lexsort((order, -score, query))
        query, score, name = query[o], score[o], name[o]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        best = place < self.k
        self.floor[query[place == self.k - 1]] = score[place == self.k - 1]
        self.query, self.score, self.name = query[best], score[best], name[best]

    def rows(self):
        self.settle()
        if len(self.query):
            names = ["query_id", "id", "score"]
            columns = [[self.ids[q] for q in self.query], self.name.tolist(), self.score.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def names_of(column: pa.Array) -> np.ndarray:
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def table_of(vectors: list) -> np.ndarray:
    """Vectors as a matrix; all of a block's vectors have the length of most, others are zero."""
    width = max(map(len, vectors), default=0)
    return np.array([v if len(v) == width else [0.0] * width for v in vectors], np.float64).reshape(len(vectors), width)


def top_k(
    queries: DataFrame,
    points: DataFrame,
    k: int = 10,
    *,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    point_id: str = "id",
    vector: str = "body",
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, id, score, rank): the k most similar points of each query by cosine, ties by id.

    Exact. A task scores its points against queries as matrix products and sends on its own k best for each query, so
    what is shuffled is tasks x queries x k and never queries x points. At most ``block`` queries travel with the tasks,
    and points stay where they are. More queries go to every part of the points, which are shuffled once; then the driver
    sees only a count. Queries are evaluated once. Null and zero vectors score nothing and don't appear. k = 0 means 10.
    """
    k = k or 10
    rows = pairs_of(points, point_id, vector, "id").where("v is not null")
    # Written before any condition, so that a costly column of queries, such as an embedding, is computed once.
    asked = written(pairs_of(queries, query_id, query_vector, "query_id"), "queries").where("v is not null")
    n = asked.count()
    if not n:
        return queries.sparkSession.createDataFrame([], f"{hit_schema(asked, rows)}, rank int")
    if n <= block:
        return ranked_hits(held_block(asked.collect(), rows, k, hit_schema(asked, rows)), k)  # at most block rows
    return ranked_hits(met(rows.withColumn("cell", F.lit(0)), asked.withColumn("cell", F.lit(0)), k), k)


def pairs_of(rows: DataFrame, name: str, vector: str, as_name: str) -> DataFrame:
    return rows.select(F.col(name).alias(as_name), F.col(vector).cast("array<double>").alias("v"))


def hit_schema(asked: DataFrame, rows: DataFrame) -> str:
    q_type, p_type = asked.schema["query_id"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    return f"query_id {q_type}, id {p_type}, score double"


def ranked_hits(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def held_block(held: list, rows: DataFrame, k: int, schema: str) -> DataFrame:
    """Hits of a block of queries that travels with the tasks."""
    ids, table = [r.query_id for r in held], table_of([r.v for r in held])

    def score(batches):
        best = Best(ids, table, k)
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                part = b.slice(a, ROWS)
                best.add(names_of(part.column(0)), part.column(1))
        yield from best.rows()

    return rows.mapInArrow(score, schema)


def met(points: DataFrame, asked: DataFrame, k: int, part: int = PART) -> DataFrame:
    """(query_id, id, score) of points (id, v, cell) and queries (query_id, v, cell) that share a cell.

    A cell's points are dealt to parts of at most about ``part`` points, and to as many as there are shuffle partitions
    where there is one cell: every point is shuffled once, queries go to all parts of their cells. A task holds the points
    of one part and queries stream past it, so its memory depends on neither side's size.
    """
    spark = points.sparkSession
    counts = written(points.groupBy("cell").count(), "cells")
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) if counts.limit(2).count() == 1 else 1
    few = counts.select("cell", F.greatest(F.ceil(F.col("count") / part), F.lit(least)).cast("int").alias("parts"))
    dealt = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    p = points.join(few, "cell").select("cell", dealt.alias("part"), F.lit(0).alias("side"), none(asked, "query_id"), "id", "v")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    q = asked.join(few, "cell").select("cell", every.alias("part"), F.lit(1).alias("side"), "query_id", none(points, "id"), "v")
    both = p.unionByName(q).repartition("cell", "part").sortWithinPartitions("cell", "part", "side")
    return both.mapInArrow(parts_of_points(k), hit_schema(asked, points))


def parts_of_points(k: int):
    """For rows (cell, part, side, query_id, id, v) sorted by the first three: points are held, queries stream past."""

    def task(batches):
        last, names, lists = None, [], []
        for b in batches:
            cell, part, side = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            if not len(side):
                continue
            cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1]), True])
            for a, z in zip(cuts[:-1], cuts[1:]):
                if (cell[a], part[a]) != last:
                    last, names, lists = (cell[a], part[a]), [], []
                some = b.slice(a, z - a)
                if side[a] == 0:
                    names.append(names_of(some.column(4)))
                    lists.append(some.column(5))
                    continue
                for c in range(0, some.num_rows if names else 0, QUERIES):
                    few = some.slice(c, QUERIES)
                    best = Best(few.column(3).to_pylist(), table_of(few.column(5).to_pylist()), k)
                    for name, column in zip(names, lists):
                        for r in range(0, len(name), ROWS):
                            best.add(name[r : r + ROWS], column.slice(r, ROWS))
                    yield from best.rows()

    return task


def boost(hits: DataFrame, tag_boost: float = 0.2, user_tags: str = "user_tags", tags: str = "tags") -> DataFrame:
    """Boost hits that share a tag with the query, then rank anew: adds the columns of a search result.

    Matching is exact and keeps the order and repeats of user_tags; one boost however many match; it is
    applied after the top k, so nothing enters that wasn't there, and a negative score gets lower.
    """
    none = F.array().cast("array<string>")
    mine, theirs = F.coalesce(user_tags, none), F.coalesce(tags, none)
    matched = F.filter(mine, lambda t: F.array_contains(theirs, t))
    hit = (F.size("matched_tags") > 0) & F.lit(tag_boost > 0)
    out = hits.withColumn("matched_tags", matched).withColumns(
        {
            "original_score": F.col("score"),
            "was_boosted": hit,
            "boost_factor": F.when(hit, F.lit(1.0 + tag_boost)).otherwise(F.lit(1.0)),
            "original_rank": F.col("rank"),
        }
    )
    out = out.withColumn("score", F.col("original_score") * F.col("boost_factor"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "original_rank")
    return out.withColumn("rank", F.row_number().over(order))


def ranks_of_expected(results: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_id, expected_id, found, rank, was_boosted) for each row of truth (query_id, expected_id)."""
    boosted = F.max("was_boosted") if "was_boosted" in results.columns else F.lit(False)
    per_query = results.groupBy("query_id").agg(boosted.alias("was_boosted"))
    ranks = results.select("query_id", F.col("id").alias("expected_id"), "rank").groupBy("query_id", "expected_id").agg(
        F.min("rank").alias("rank")
    )
    return (
        truth.join(ranks, ["query_id", "expected_id"], "left")
        .join(per_query, "query_id", "left")
        .select(
            "query_id",
            "expected_id",
            F.col("rank").isNotNull().alias("found"),
            "rank",
            F.coalesce("was_boosted", F.lit(False)).alias("was_boosted"),
        )
    )


def recall(ranked: DataFrame, *ks: int) -> DataFrame:
    """One row: total, found, recall_at_k for each k, boost_rate; 0 where there are no queries."""
    share = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    at = [share(F.coalesce(F.col("rank") <= k, F.lit(False))).alias(f"recall_at_{k}") for k in ks]
    return ranked.agg(
        F.count("*").alias("total"), F.count_if("found").alias("found"), *at, share(F.col("was_boosted")).alias("boost_rate")
    )


def not_found(ranked: DataFrame) -> DataFrame:
    """Queries whose expected point isn't among the hits."""
    return ranked.where(~F.col("found"))


def boosted_and_found(ranked: DataFrame) -> DataFrame:
    return ranked.where(F.col("was_boosted") & F.col("found"))


def boosted_counts(hits: DataFrame) -> DataFrame:
    """(query_id, n_hits, n_boosted) of boosted hits."""
    return hits.groupBy("query_id").agg(F.count("*").alias("n_hits"), F.count_if("was_boosted").alias("n_boosted"))


def by_id(points: DataFrame, wanted: str) -> DataFrame:
    """The point of an id, with score 1; the filter reaches the scan."""
    return points.where(F.col("id") == wanted).withColumn("score", F.lit(1.0))
