"""Session defaults.

Only settings the engine depends on are fixed (UTC, adaptive execution); sizes of partitions and of
broadcasts are left to the cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "corpuslathe", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and skew-join handling on; further settings by keyword (dots as double underscores)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
