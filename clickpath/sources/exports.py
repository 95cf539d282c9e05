"""Readers for the raw event log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.schema import COLLECTED_FLAT, RAW_EVENTS

# Fixed value: form of the raw event_date.
RAW_DATE = "%Y%m%d"


def raw_schema(collected: str = "nested") -> T.StructType:
    if collected == "nested":
        return RAW_EVENTS
    if collected == "flat":
        return T.StructType(
            [
                T.StructField(f.name, COLLECTED_FLAT) if f.name == "collected_traffic_source" else f
                for f in RAW_EVENTS.fields
            ]
        )
    raise ValueError(f"collected must be 'nested' or 'flat', not {collected!r}")


def _nest_collected() -> Column:
    old = F.col("collected_traffic_source")
    campaign = F.struct(
        old["manual_source"].alias("source"),
        old["manual_medium"].alias("medium"),
        old["manual_campaign_name"].alias("campaign_name"),
    )
    return F.when(old.isNotNull(), F.struct(campaign.alias("manual_campaign")))


def _conform(df: DataFrame, collected: str) -> DataFrame:
    if collected == "flat":
        df = df.withColumn("collected_traffic_source", _nest_collected())
    return df.select(*RAW_EVENTS.fieldNames())


def read_events(spark: SparkSession, path: str, collected: str = "nested") -> DataFrame:
    """Parquet folder partitioned by the raw ``event_date``; date filters prune folders."""
    return _conform(spark.read.schema(raw_schema(collected)).parquet(path), collected)


def read_shards(
    spark: SparkSession,
    root: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    prefix: str = "events_",
    collected: str = "nested",
) -> DataFrame:
    """One Parquet folder per day, ``<root>/events_YYYYMMDD``, read through a wildcard.

    Between ``first`` and ``last`` only those days are listed and opened; days without
    a folder are skipped. ``event_date`` is a column inside the files.
    """
    pattern = "*"
    if (first is None) != (last is None):
        raise ValueError("give both first and last, or neither")
    if first is not None and last is not None:
        days = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
        pattern = "{" + ",".join(day.strftime(RAW_DATE) for day in days) + "}"
    return _conform(spark.read.schema(raw_schema(collected)).parquet(f"{root}/{prefix}{pattern}"), collected)


def read_table(spark: SparkSession, name: str, collected: str = "nested") -> DataFrame:
    """A raw event log declared in the catalog."""
    return _conform(spark.table(name), collected)
