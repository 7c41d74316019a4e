"""Vector functions over arrays, accumulated in double precision inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is null, empty or zero."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))


def normalized(a: Column) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: (x / length).cast("float"))).otherwise(a)
