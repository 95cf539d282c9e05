"""Session settings the models are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    # partition counts and join sides are settled from real sizes while the query runs
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a partition that one large key fills is split; lookup joins are shaped for it
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "clickpath", **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` holds further settings or other values, dots as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
