from __future__ import annotations

import datetime as dt

import pytest

import clickpath as cp
from clickpath.schema import RAW_EVENTS
from clickpath.sources.exports import raw_schema
from clickpath.storage import stored, work_dir
from tests.rows import campaign, param, raw_event, raw_log


def shards(spark, root):
    for day in (1, 2, 4):
        log = raw_log(spark, raw_event(event_date=f"2024010{day}", event_params=[param("source", f"d{day}")]))
        log.write.parquet(f"{root}/events_2024010{day}")


def days(df):
    return sorted(r[0] for r in df.select("event_date").collect())


def test_day_shards(spark, tmp_path):
    shards(spark, tmp_path)
    assert days(cp.read_shards(spark, str(tmp_path))) == ["20240101", "20240102", "20240104"]
    some = cp.read_shards(spark, str(tmp_path), dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    assert days(some) == ["20240102", "20240104"]
    assert {name.split("/")[-2] for name in some.inputFiles()} == {"events_20240102", "events_20240104"}
    with pytest.raises(ValueError):
        cp.read_shards(spark, str(tmp_path), dt.date(2024, 1, 2))


def test_partition_date_stays_text(spark, tmp_path):
    raw_log(spark, raw_event()).write.partitionBy("event_date").parquet(str(tmp_path / "raw"))
    log = cp.read_events(spark, str(tmp_path / "raw"))
    assert log.schema == RAW_EVENTS
    assert days(log) == ["20240105"]


def test_catalog_table(spark, tmp_path):
    raw_log(spark, raw_event()).write.parquet(str(tmp_path / "raw"))
    spark.read.parquet(str(tmp_path / "raw")).createOrReplaceTempView("raw_log")
    assert cp.read_table(spark, "raw_log").columns == RAW_EVENTS.fieldNames()


def test_flat_collected_campaign(spark, tmp_path):
    flat = spark.createDataFrame(
        [
            raw_event(collected_traffic_source={"manual_source": "s", "manual_medium": "m", "manual_campaign_name": "c"}),
            raw_event(),
        ],
        raw_schema("flat"),
    )
    flat.write.partitionBy("event_date").parquet(str(tmp_path / "raw"))
    log = cp.read_events(spark, str(tmp_path / "raw"), collected="flat")
    assert log.schema.fieldNames() == RAW_EVENTS.fieldNames()
    got = [r["collected_traffic_source"] for r in log.collect()]
    nested = [g.asDict(True) for g in got if g is not None]
    assert nested == [campaign("s", "m", "c")]
    assert got.count(None) == 1
    with pytest.raises(ValueError):
        raw_schema("deep")


def test_stored_rows_stay_under_the_checkpoint_folder(spark):
    kept = stored(spark.range(5), "numbers")
    assert kept.count() == 5
    assert all(work_dir(spark).removeprefix("file:") in name for name in kept.inputFiles())
