from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from clickpath.functions import event_param
from tests.rows import campaign, param, raw_event, raw_log


def lookup(spark, params, **options):
    row = cp.event_params_lookup(raw_log(spark, raw_event(event_params=params)), **options).first()
    return row["ga_session_id"], row["page_location"], row["param_source"]


def resolved(spark, **given):
    row = cp.pre_events(raw_log(spark, raw_event(**given))).first()
    return row["fixed_traffic_source"], row["fixed_traffic_medium"], row["fixed_traffic_campaign"]


@pytest.mark.parametrize("params", [None, [], [None], [param("other", "x", 1)], [{"key": None, "value": None}]])
def test_missing_parameters_are_null(spark, params):
    assert lookup(spark, params) == (None, None, None)


def test_value_in_the_other_subfield_is_null(spark):
    assert lookup(spark, [param("ga_session_id", text="7"), param("source", number=3)]) == (None, None, None)


def test_key_without_a_value_record_is_null(spark):
    assert lookup(spark, [{"key": "source", "value": None}, param("ga_session_id", number=4)]) == (4, None, None)


def test_repeated_key_gives_the_first_value(spark):
    assert lookup(spark, [param("source", "a"), param("source", "b")])[2] == "a"
    assert lookup(spark, [param("source"), param("source", "b")])[2] is None


def test_repeated_key_raises_in_strict_mode(spark):
    with pytest.raises(Exception, match="source occurs more than once"):
        lookup(spark, [param("source", "a"), param("source", "b")], on_duplicate="error")
    assert lookup(spark, [param("source", "a"), None], on_duplicate="error")[2] == "a"
    assert lookup(spark, None, on_duplicate="error") == (None, None, None)
    with pytest.raises(ValueError):
        event_param("source", "string_value", on_duplicate="last")


def url(tail):
    return [param("page_location", "https://shop.example/p" + tail)]


@pytest.mark.parametrize(
    ("tail", "source"),
    [
        ("?utm_source=a", "a"),
        ("?x=1&utm_source=a&y=2", "a"),
        ("?utm_source=a#frag", "a#frag"),
        ("?utm_source=a%20b", "a%20b"),
        ("?UTM_SOURCE=a", None),
        ("?utm_source=", None),
        ("?utm_source=&utm_source=b", "b"),
        ("?utm_source=a&utm_source=b", "a"),
        ("?my_utm_source=a", None),
        ("#utm_source=a", None),
    ],
)
def test_url_tag(spark, tail, source):
    assert resolved(spark, event_params=url(tail))[0] == source


def test_cascade_takes_the_first_known(spark):
    collected, fallback = campaign("collected", "m2", "c2"), campaign("fallback", "m3", "c3")
    steps = {
        "event_params": url("?utm_source=tag") + [param("source", "param"), param("medium", "m1")],
        "collected_traffic_source": collected,
        "session_traffic_source_last_click": fallback,
    }
    assert resolved(spark, **steps) == ("tag", "m1", "c2")
    steps["event_params"] = [param("source", "param")]
    assert resolved(spark, **steps) == ("param", "m2", "c2")
    steps["event_params"] = None
    assert resolved(spark, **steps) == ("collected", "m2", "c2")
    steps["collected_traffic_source"] = campaign(None, "m2")
    assert resolved(spark, **steps) == ("fallback", "m2", "c3")
    steps["session_traffic_source_last_click"] = None
    assert resolved(spark, **steps) == (None, "m2", None)


def test_campaign_parameter(spark):
    assert resolved(spark, event_params=[param("campaign", "spring")]) == (None, None, "spring")


def test_empty_string_is_a_value(spark):
    assert resolved(spark, event_params=[param("source", "")], collected_traffic_source=campaign("late"))[0] == ""


def test_keys_are_null_when_a_part_is(spark):
    session = [param("ga_session_id", number=12)]
    row = cp.pre_events(raw_log(spark, raw_event(event_params=session))).first()
    assert row["event_id"] == "c11704412800000000view10"
    assert row["session_key"] == "c112"
    assert row["event_date"] == dt.date(2024, 1, 5)
    row = cp.pre_events(raw_log(spark, raw_event(event_params=session, user_pseudo_id=None))).first()
    assert (row["event_id"], row["session_key"], row["ga_session_id"]) == (None, None, 12)


def test_fingerprint_tells_parameter_arrays_apart(spark):
    arrays = [
        None,
        [],
        [param("a", "1")],
        [param("a", None, 1)],
        [param("a", "1"), param("b", "1")],
        [param("b", "1"), param("a", "1")],
        [param("a", "1", 1)],
    ]
    log = raw_log(spark, *[raw_event(event_params=a) for a in arrays * 2])
    ids = cp.pre_events(log, event_id="fingerprint").select("event_id")
    # a missing array has no text to hash; the six others differ
    assert ids.distinct().count() == 7
    assert all(r["event_id"] is None or r["event_id"].startswith("c11704412800000000view") for r in ids.collect())


def test_dates_strict_and_lenient(spark):
    log = raw_log(spark, raw_event(event_date="2024-1"))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        cp.pre_events(log).collect()
    assert cp.pre_events(log, dates="lenient").first()["event_date"] is None


def test_windows_of_days(spark):
    log = raw_log(spark, *[raw_event(event_date=f"202401{d:02}") for d in range(1, 12)])
    as_of = dt.date(2024, 1, 10)
    days = lambda df: sorted(r[0].day for r in df.select("event_date").collect())
    assert days(cp.pre_events_recent(log, as_of)) == [7, 8, 9, 10, 11]
    assert days(cp.pre_events_recent(log, as_of, lookback_days=0)) == [10, 11]
    assert days(cp.pre_events_day(log, as_of)) == [3]


def test_output_columns(spark):
    events = cp.pre_events(raw_log(spark, raw_event()))
    assert events.columns == [
        "event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id", "ga_session_id",
        "session_key", "fixed_traffic_source", "fixed_traffic_medium", "fixed_traffic_campaign", "ecommerce", "items",
    ]
    assert events.select(F.col("ecommerce.transaction_id")).count() == 1
