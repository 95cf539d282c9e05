"""What the plans must look like to hold at scale."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from __spark_entry__ import SMOKE_DIR, _raw, own_queries
from clickpath.operators.skew import lookup_join
from clickpath.storage import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan(df)))


@pytest.fixture(scope="module")
def raw(spark):
    return _raw(spark, SMOKE_DIR)


def test_events_need_no_shuffle_and_stay_in_generated_code(raw):
    # columns of one Project each, all marked with the codegen star
    text = formatted(cp.pre_events(raw))
    assert "Exchange" not in text
    assert all(line.strip().lstrip("+-: ").startswith("* ") for line in text.splitlines() if " Project (" in line)


def test_only_used_value_subfields_are_read(raw):
    schema = re.search(r"ReadSchema: (.*)", formatted(cp.pre_events(raw))).group(1)
    assert "event_params:array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>" in schema
    purchases = cp.products_session_scope(cp.pre_events(raw), cp.sessions(stored(cp.pre_sessions(cp.pre_events(raw)), "p")))
    assert "tax" not in formatted(purchases)


def test_windows_of_days_prune_partitions(raw):
    assert "PartitionFilters: [isnotnull(event_date" in plan(cp.pre_events_recent(raw, dt.date(2024, 1, 31)))
    assert "(event_date" in re.search(
        r"PartitionFilters: \[(.*?)\]", plan(cp.pre_events_day(raw, dt.date(2024, 1, 31)))
    ).group(1)


def test_purchase_filter_reaches_the_scan(raw):
    pre = stored(cp.pre_sessions(cp.pre_events(raw)), "pre")
    report = formatted(cp.products(cp.pre_events(raw), cp.last_non_direct_from_pre(pre)))
    assert "EqualTo(event_name,purchase)" in report
    assert "IsNotNull(ecommerce.transaction_id)" in report


def test_one_shuffle_for_sessions(raw):
    assert shuffles(cp.pre_sessions(cp.pre_events(raw))) == 1


def test_path_models_share_the_shuffle_of_the_session_table(raw):
    pre = stored(cp.pre_sessions(cp.pre_events(raw)), "pre")
    assert shuffles(cp.sessions(pre)) == 1
    assert shuffles(cp.first_click(cp.sessions(pre))) == 1
    assert shuffles(cp.last_non_direct(cp.sessions(pre))) == 1


@pytest.mark.parametrize("name", own_queries())
def test_no_python_rows_and_no_cross_join(spark, name):
    text = plan(own_queries()[name](spark, SMOKE_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_missing_keys_are_spread_and_a_large_key_is_split(spark):
    """A third of the rows have no key and a third share one; no task may get either third."""
    rows = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 1, "hot").when(F.col("id") % 3 == 2, F.col("id").cast("string")).alias("key"),
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    lookup = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") == 0, None).when(F.col("id") == 1, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.concat(F.lit("v"), F.col("id")).alias("value"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        for nulls_match in (False, True):
            tagged = lookup_join(rows, lookup, "key", ["id"], nulls_match).withColumn("task", F.spark_partition_id())
            joined = stored(tagged, "spread")
            sizes = joined.groupBy("task").count().agg(F.max("count"), F.sum("count"))
            largest, total = sizes.first()
            assert total == 300_000
            assert largest < 60_000
            found = joined.groupBy(F.col("key").isNull().alias("missing")).agg(F.count("value").alias("n"))
            counts = {r["missing"]: r["n"] for r in found.collect()}
            assert counts == {True: 100_000 if nulls_match else 0, False: 200_000}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
