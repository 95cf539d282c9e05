"""Days of the raw log that change outside the reload window."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from clickpath.__main__ import main
from clickpath.sources.changes import restated_days
from tests.rows import PURCHASE, item, order, raw_log, visit
from tests.test_daily import AS_OF, DAY, assert_same_tables


def write(spark, root, *events):
    raw_log(spark, *events).write.partitionBy("event_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(str(root))


def log_of(spark, root):
    return cp.source_log(cp.source_files(spark, str(root)))


def old_days():
    bought = dict(event_name=PURCHASE, ecommerce=order("T1"), items=[item("x")])
    return [
        visit("u", 1, 0, "a", "m", user_id="l"), visit("u", 1, DAY, "b", "m"), visit("u", 2, 2 * DAY, None, **bought),
        visit("v", 1, 2 * DAY, "c", "m"), visit("u", 3, 9 * DAY, "(direct)", "(none)"),
    ]


@pytest.mark.parametrize("scope", ["cookie", "session", "linear"])
def test_a_restated_day_is_found(spark, tmp_path, scope):
    """A day long before the window gets other events, loses some, goes or comes; the tables are those of a full load."""
    root, old = tmp_path / "raw", old_days()
    write(spark, root, *old)
    daily = cp.full_refresh(cp.read_events(spark, str(root)), cp.Warehouse(spark, str(tmp_path / "daily")), scope=scope, source=log_of(spark, root))
    write(spark, root, visit("u", 1, 5, "z", "m", user_id="other"), visit("w", 7, 5, "q"))
    write(spark, root, visit("v", 9, 3 * DAY, "new", "m"))
    for file in (root / "event_date=20240102").glob("*"):
        file.unlink()
    for file in (root / "event_date=20240102").glob(".*"):
        file.unlink()
    raw, source = cp.read_events(spark, str(root)), log_of(spark, root)
    assert restated_days(daily.state()["source"], source) == {dt.date(2024, 1, d) for d in (1, 2, 4)}
    cp.daily_refresh(raw, daily, AS_OF, scope=scope, source=source)
    full = cp.full_refresh(raw, cp.Warehouse(spark, str(tmp_path / "full")), scope=scope)
    assert_same_tables(daily, full)
    # and is not loaded twice
    before = daily.snapshot().places["pre_events"]["2024-01-01"]
    cp.daily_refresh(raw, daily, AS_OF, scope=scope, source=log_of(spark, root))
    assert daily.snapshot().places["pre_events"]["2024-01-01"] == before
    assert_same_tables(daily, full)


def test_without_a_list_only_the_window_is_read(spark, tmp_path):
    root = tmp_path / "raw"
    write(spark, root, *old_days())
    daily = cp.full_refresh(cp.read_events(spark, str(root)), cp.Warehouse(spark, str(tmp_path / "daily")))
    write(spark, root, visit("u", 1, 5, "z", "m"))
    cp.daily_refresh(cp.read_events(spark, str(root)), daily, AS_OF, source=log_of(spark, root))
    assert daily.read("pre_events").where("fixed_traffic_source = 'z'").isEmpty()
    # the first list there is counts as loaded
    assert daily.state()["source"] == log_of(spark, root)


def test_files_are_listed_by_day(spark, tmp_path):
    raw_log(spark, visit("u", 1, 0)).write.parquet(str(tmp_path / "raw/events_20240101"))
    raw_log(spark, visit("u", 1, DAY)).write.parquet(str(tmp_path / "raw/events_20240102"))
    raw_log(spark, visit("u", 1, DAY)).write.parquet(str(tmp_path / "raw/events_intraday"))
    files = cp.source_files(spark, str(tmp_path / "raw"), "shards")
    assert sorted(cp.source_log(files)) == ["2024-01-01", "2024-01-02"]
    assert files.where(F.col("day").isNull()).count() > 0
    with pytest.raises(ValueError):
        cp.source_files(spark, str(tmp_path), "table")


def test_job_finds_restated_shards(spark, tmp_path):
    places = ["--layout", "shards", "--raw", str(tmp_path / "raw"), "--root", str(tmp_path / "out"), "--find-restated"]
    for day in range(12):
        raw_log(spark, visit("u", day, day * DAY, f"day{day}")).write.parquet(str(tmp_path / f"raw/events_202401{day + 1:02d}"))
    main(["full", *places])
    raw_log(spark, visit("u", 1, DAY, "again")).write.mode("overwrite").parquet(str(tmp_path / "raw/events_20240102"))
    loaded = main(["daily", *places, "--as-of", "2024-01-12", "--lookback-days", "1"])
    assert {r[0] for r in loaded.read("pre_events").where("event_date = '2024-01-02'").select("fixed_traffic_source").collect()} == {"again"}
    with pytest.raises(SystemExit):
        main(["full", "--raw", "t", "--root", "r", "--layout", "table", "--find-restated"])
