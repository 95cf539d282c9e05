from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from __spark_entry__ import AS_OF, SMOKE_DIR, _before, _raw
from clickpath.schema import TABLES
from clickpath.storage import stored
from tests.rows import raw_log, same_rows, visit

DAY = 86_400


def test_session_across_the_window_is_rebuilt_whole(spark):
    raw = raw_log(
        spark,
        visit("u", 1, 2 * DAY, "old", "m"),
        visit("u", 1, 6 * DAY, "new", "m"),
        visit("v", 1, 1 * DAY, "still", "m"),
        visit(None, 7, 3 * DAY, "a", "m"),
        visit(None, 7, 8 * DAY, "b", "m"),
    )
    as_of = dt.date(2024, 1, 9)
    before = raw.where("event_date < '20240107'")
    existing = cp.pre_sessions(cp.pre_events(before))
    loaded = cp.pre_sessions_incremental(cp.pre_events(raw), existing, as_of)
    assert same_rows(loaded, cp.pre_sessions(cp.pre_events(raw)))
    assert loaded.where("user_pseudo_id = 'u'").first()["session_first_source"] == "old"


def test_only_needed_days_are_read(spark):
    events = stored(cp.pre_events(_raw(spark, SMOKE_DIR)), "events")
    existing = stored(cp.pre_sessions(events.where("event_date < '2024-01-30'")), "existing")
    rebuilt = cp.recent_sessions(events, existing, AS_OF)
    plan = rebuilt._jdf.queryExecution().optimizedPlan().toString()
    # 3-day sessions that straddle 2024-01-28 began on the 27th; one more day for the zone
    assert "2024-01-26" in plan


def test_untouched_sessions_are_not_rebuilt(spark):
    events = cp.pre_events(raw_log(spark, visit("u", 1, 0, "a"), visit("v", 2, 8 * DAY, "b")))
    rebuilt = cp.recent_sessions(events, cp.pre_sessions(events), dt.date(2024, 1, 9))
    assert [r["session_key"] for r in rebuilt.collect()] == ["v2"]


def test_reloaded_days_replace_stale_rows(spark):
    raw = _raw(spark, SMOKE_DIR)
    stale = cp.pre_events(_before(raw)).withColumn(
        "fixed_traffic_source",
        F.when(F.col("event_date") < "2024-01-28", F.col("fixed_traffic_source")).otherwise("stale"),
    )
    assert same_rows(cp.pre_events_incremental(raw, stale, AS_OF), cp.pre_events(raw))


def test_match_by_id_keeps_rows_the_log_has_lost(spark):
    raw = raw_log(spark, visit("u", 1, 8 * DAY, "new"))
    old = cp.pre_events(
        raw_log(spark, visit("u", 1, 8 * DAY, "old"), visit("u", 2, 8 * DAY + 1, "gone"), visit(None, 3, 8 * DAY, "x"))
    )
    as_of = dt.date(2024, 1, 10)

    def sources(match):
        loaded = cp.pre_events_incremental(raw, old, as_of, match=match)
        return sorted(r["fixed_traffic_source"] for r in loaded.collect())

    assert sources("date") == ["new"]
    assert sources("event_id") == ["gone", "new", "x"]
    with pytest.raises(ValueError):
        sources("key")


def all_tables(warehouse):
    return {name: warehouse.read(name) for name in TABLES}


def test_daily_load_equals_full_build(spark, tmp_path):
    raw = _raw(spark, SMOKE_DIR)
    full = cp.full_refresh(raw, cp.Warehouse(spark, str(tmp_path / "full")))
    daily = cp.Warehouse(spark, str(tmp_path / "daily"))
    # the first load finds no tables and builds all of them
    for until, as_of in [("20240126", dt.date(2024, 1, 26)), ("20240129", dt.date(2024, 1, 29)), ("20240201", AS_OF)]:
        cp.daily_refresh(raw.where(F.col("event_date") < until), daily, as_of)
    # a load may be run again
    cp.daily_refresh(raw, daily, AS_OF)
    for name, rows in all_tables(full).items():
        flat = lambda df: df.select(*[F.col(c).cast("string") for c in df.columns])
        assert same_rows(flat(daily.read(name)), flat(rows)), name


def test_event_grain_full_build(spark, tmp_path):
    warehouse = cp.full_refresh(_raw(spark, SMOKE_DIR), cp.Warehouse(spark, str(tmp_path)), grain="event")
    assert warehouse.read("pre_sessions").count() == 930
    assert warehouse.read("attribution_linear").count() == 930
    assert warehouse.read("attribution_last_non_direct").count() == 15


def test_catalog_entries(spark, tmp_path):
    warehouse = cp.Warehouse(spark, str(tmp_path), database="listed", register=True)
    cp.full_refresh(_raw(spark, SMOKE_DIR), warehouse)
    assert {t.name for t in spark.catalog.listTables("listed")} == set(TABLES)
    assert spark.table("listed.transactions").count() == 182
    assert spark.table("listed.pre_events").where("event_date = '2024-01-24'").count() > 0
    comment = spark.sql("describe extended listed.products").where("col_name = 'Comment'").first()["data_type"]
    assert comment == "One row per purchased item with attribution."
    for name, schema in TABLES.items():
        if name not in ("pre_events", "pre_sessions"):
            assert spark.table(f"listed.{name}").schema == schema


def test_only_partitioned_tables_take_partitions(spark, tmp_path):
    with pytest.raises(ValueError), cp.Warehouse(spark, str(tmp_path)).loading() as load:
        load.replace_days("unified_id", spark.range(1))
