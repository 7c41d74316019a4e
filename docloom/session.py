"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution (joins, coalescing, skew) and Arrow transfer."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (fixed | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
