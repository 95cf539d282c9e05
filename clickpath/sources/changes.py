"""Which days of a raw log have changed since they were loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The day in the name of a folder: event_date=20240131, events_20240131.
_DAY = r"(\d{8})/[^/]*$"


def source_files(spark: SparkSession, root: str, layout: str = "partitions", prefix: str = "events_") -> DataFrame:
    """(day, path, length, modified) of every Parquet file of a raw log; the files are listed, not opened.

    ``layout`` is that of ``read_events`` (``partitions``) or ``read_shards`` (``shards``).
    """
    if layout not in ("partitions", "shards"):
        raise ValueError(f"layout must be 'partitions' or 'shards', not {layout!r}")
    folder = f"{root}/event_date=*" if layout == "partitions" else f"{root}/{prefix}*"
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select(
        F.try_to_date(F.regexp_extract("path", _DAY, 1), "yyyyMMdd").alias("day"), "path", "length",
        F.unix_micros("modificationTime").alias("modified"),
    )


def source_log(files: DataFrame) -> dict[str, str]:
    """What the files of each day look like: one entry per day, which is kept with a load."""
    mark = F.concat_ws(":", F.count("*"), F.sum("length"), F.max("modified"), F.bit_xor(F.xxhash64("path", "length", "modified")))
    by_day = files.where(F.col("day").isNotNull()).groupBy("day").agg(mark.alias("mark"))
    return {row["day"].isoformat(): row["mark"] for row in by_day.collect()}


def restated_days(before: Mapping[str, str], now: Mapping[str, str]) -> set[dt.date]:
    """Days whose files have come, gone or changed."""
    return {dt.date.fromisoformat(day) for day in before.keys() | now.keys() if before.get(day) != now.get(day)}
