"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import drop_table, materialise


def lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v): root is the least node reachable.

    Alternates large and small stars until nothing changes: each round hangs nodes under the least
    neighbour, by aggregates and joins only, and ends in a written table. The driver sees a count and a
    checksum a round. Roots don't get a row of their own.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    table, before = materialise(ordered, "links"), None
    while True:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(lowest(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
            .distinct()
        )
        small = (
            large.join(lowest(large), "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
            .distinct()
        )
        after = materialise(small, "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        drop_table(table)
        table = after
        if mark == before:
            return table.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
