from __future__ import annotations

import pytest

from clickpath.__main__ import main
from tests.rows import PURCHASE, order, raw_log, visit


def test_full_then_daily(spark, tmp_path):
    log = raw_log(spark, visit("u", 1, 0, "google", "cpc", event_name=PURCHASE, ecommerce=order("T1")))
    log.write.partitionBy("event_date").parquet(str(tmp_path / "raw"))
    places = ["--raw", str(tmp_path / "raw"), "--root", str(tmp_path / "out")]
    built = main(["full", *places])
    assert built.read("transactions").first()["attribution_source"] == "google"

    more = raw_log(spark, visit("u", 2, 86_400, "bing", "organic", event_name=PURCHASE, ecommerce=order("T2")))
    more.write.partitionBy("event_date").mode("append").parquet(str(tmp_path / "raw"))
    loaded = main(["daily", *places, "--as-of", "2024-01-03", "--lookback-days", "1"])
    got = {r["transaction_id"]: r["attribution_source"] for r in loaded.read("transactions").collect()}
    assert got == {"T1": None, "T2": "bing"}


def test_daily_load_opens_only_the_shards_of_its_window(spark, tmp_path):
    places = ["--layout", "shards", "--raw", str(tmp_path / "raw"), "--root", str(tmp_path / "out")]
    for day in range(3):
        log = raw_log(spark, visit("u", day, day * 86_400, f"day{day}", event_name=PURCHASE, ecommerce=order(f"T{day}")))
        log.write.parquet(str(tmp_path / f"raw/events_2024010{day + 1}"))
    # the first daily load finds no tables and reads every shard
    assert main(["daily", *places, "--as-of", "2024-01-03"]).read("transactions").count() == 3
    broken = tmp_path / "raw" / "events_20240101" / "broken.parquet"
    broken.write_text("not a Parquet file, and outside the window")
    loaded = main(["daily", *places, "--as-of", "2024-01-04", "--lookback-days", "1"])
    assert {r["transaction_id"] for r in loaded.read("transactions").collect()} == {"T0", "T1", "T2"}


def test_event_grain_has_no_daily_load(tmp_path, capsys):
    with pytest.raises(SystemExit):
        main(["daily", "--raw", "r", "--root", str(tmp_path), "--grain", "event"])
    assert "event grain" in capsys.readouterr().err
