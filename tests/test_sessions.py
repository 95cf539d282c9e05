from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import clickpath as cp
from clickpath.operators.skew import carry_forward
from tests.rows import raw_log, same_rows, visit


def events(spark, *visits):
    return cp.pre_events(raw_log(spark, *visits))


def one(df, **where):
    for name, value in where.items():
        df = df.where(F.col(name).eqNullSafe(F.lit(value)))
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_first_and_last_known_source(spark):
    log = events(
        spark,
        visit("u", 1, 0),
        visit("u", 1, 10, "google", None),
        visit("u", 1, 20, None, "cpc"),
        visit("u", 1, 30, "bing", "organic"),
        visit("u", 1, 40),
    )
    row = one(cp.pre_sessions(log))
    assert row["session_key"] == "u1"
    assert row["session_start_timestamp"] == 1_704_067_200_000_000
    assert (row["session_first_source"], row["session_first_medium"]) == ("google", "cpc")
    assert (row["session_last_source"], row["session_last_medium"]) == ("bing", "organic")


def test_same_time_is_ordered_by_source_then_medium_with_nulls_last(spark):
    log = events(
        spark,
        visit("u", 1, 5, "b", "x"),
        visit("u", 1, 5, "a", "y"),
        visit("u", 1, 5, None, "a"),
        visit("u", 1, 5, "a", None),
    )
    for grain in ("session", "event"):
        rows = {tuple(r)[4:] for r in cp.pre_sessions(log, grain).collect()}
        assert rows == {("a", "y", "b", "a")}


def test_session_without_any_source(spark):
    log = events(spark, visit("u", 1, 0), visit("u", 2, 100, "mail", "email"), visit("u", 3, 200))
    pre = cp.pre_sessions(log)
    assert one(pre, ga_session_id=1)["session_first_source"] is None
    done = cp.sessions(pre)
    finals = {r["ga_session_id"]: (r["final_session_source"], r["final_session_medium"]) for r in done.collect()}
    assert finals == {1: ("(direct)", "(none)"), 2: ("mail", "email"), 3: ("mail", "email")}


def test_source_and_medium_are_carried_each_on_its_own(spark):
    log = events(spark, visit("u", 1, 0, "google", "cpc"), visit("u", 2, 100, "(direct)", "referral"))
    row = one(cp.sessions(cp.pre_sessions(log)), ga_session_id=2)
    assert (row["session_first_source"], row["final_session_source"]) == ("(direct)", "google")
    assert row["final_session_medium"] == "referral"


def test_same_key_text_of_two_cookies_stays_two_sessions(spark):
    log = events(spark, visit("1", 23, 0, "a"), visit("12", 3, 10, "b"))
    pre = cp.pre_sessions(log)
    assert [r["session_key"] for r in pre.collect()] == ["123", "123"]
    assert one(pre, user_pseudo_id="12")["session_first_source"] == "b"
    # at event grain the key alone decides, so both see the first of the two
    assert {r["session_first_source"] for r in cp.pre_sessions(log, "event").collect()} == {"a"}


def test_missing_cookies_and_session_ids(spark):
    log = events(spark, visit(None, 1, 0, "a"), visit(None, 2, 10, "b"), visit("u", None, 20, "c"))
    pre = cp.pre_sessions(log)
    assert pre.count() == 2
    assert {r["session_key"] for r in pre.collect()} == {None}
    by_event = cp.pre_sessions(log, "event")
    assert {(r["session_first_source"], r["session_last_source"]) for r in by_event.collect()} == {("a", "b")}


def test_event_grain_has_a_row_per_event_time(spark):
    log = events(spark, visit("u", 1, 0, "a"), visit("u", 1, 0, "a"), visit("u", 1, 0, "b"), visit("u", 1, 9, "a"))
    pre = cp.pre_sessions(log, "event")
    assert pre.count() == 3
    # rows that differ only in the event's own source become one
    assert cp.sessions(pre, "event").count() == 2


def test_unknown_grain(spark):
    log = events(spark, visit("u", 1, 0))
    with pytest.raises(ValueError):
        cp.pre_sessions(log, "day")
    with pytest.raises(ValueError):
        cp.sessions(cp.pre_sessions(log), "day")


@pytest.mark.parametrize("seed", range(3))
def test_long_paths_equal_the_plain_window(spark, seed):
    """Half of all rows belong to one path and a third to the missing key."""
    rng = random.Random(seed)
    rows = []
    for n in range(1500):
        owner = rng.choices(["hot", None, f"u{rng.randrange(40)}"], [3, 2, 1])[0]
        # long stretches without a value, so that blocks have to hand one on
        value = rng.choice("abcdef") if rng.random() < (0.001 if owner == "hot" else 0.05) else None
        rows.append((owner, rng.randrange(500), n, value))
    df = spark.createDataFrame(rows, "owner string, at long, id long, value string")
    path = Window.partitionBy("owner").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("carried", F.last("value", ignorenulls=True).over(path))
    got = carry_forward(df, "owner", ["at", "id"], {"carried": F.col("value")}, split_above=100, block_rows=80)
    assert same_rows(got, expected)


def test_nulls_in_the_order_come_last_on_long_paths(spark):
    df = spark.createDataFrame(
        [("u", n if n % 7 else None, n, f"v{n}" if n % 50 == 0 else None) for n in range(600)],
        "owner string, at long, id long, value string",
    )
    order = [F.col("at").asc_nulls_last(), F.col("id").asc_nulls_last()]
    path = Window.partitionBy("owner").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("carried", F.last("value", ignorenulls=True).over(path))
    got = carry_forward(df, "owner", ["at", "id"], {"carried": F.col("value")}, split_above=10, block_rows=50)
    assert same_rows(got, expected)
