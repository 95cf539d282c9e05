from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from __spark_entry__ import SMOKE_DIR, queries
from tests.rows import raw_log, same_rows, table, visit


def by_session(df):
    return {r["session_key"]: r["attribution_weight"] for r in df.collect()}


def four_sessions(spark):
    log = raw_log(
        spark,
        visit("u", 1, 0, "google", "cpc"),
        visit("u", 2, 100, "(direct)", "(none)"),
        visit("u", 3, 200, "bing", "organic"),
        visit("u", 4, 300, "(direct)", "(none)"),
        visit("v", 9, 50),
        visit(None, 1, 10, "x", "y"),
        visit(None, 2, 20),
    )
    return cp.pre_sessions(cp.pre_events(log))


def test_linear_shares(spark):
    weights = by_session(cp.linear(cp.sessions(four_sessions(spark))))
    assert weights == {"u1": 0.25, "u2": 0.25, "u3": 0.25, "u4": 0.25, "v9": 1.0, None: None}


def test_single_touch_models(spark):
    sessions = cp.sessions(four_sessions(spark))
    first = {r["user_pseudo_id"]: tuple(r)[1:] for r in cp.first_click(sessions).collect()}
    last = {r["user_pseudo_id"]: tuple(r)[1:] for r in cp.last_non_direct(sessions).collect()}
    assert first == {
        "u": ("u1", "google", "cpc", 1.0),
        "v": ("v9", "(direct)", "(none)", 1.0),
        None: (None, "x", "y", 1.0),
    }
    assert last == {
        "u": ("u4", "bing", "organic", 1.0),
        "v": ("v9", "(direct)", "(none)", 1.0),
        None: (None, "x", "y", 1.0),
    }


def test_models_without_a_session_table(spark):
    pre = four_sessions(spark)
    sessions = cp.sessions(pre)
    assert same_rows(cp.first_click_from_pre(pre), cp.first_click(sessions))
    assert same_rows(cp.last_non_direct_from_pre(pre), cp.last_non_direct(sessions))


def test_interleaved_sessions(spark):
    """B starts later, A ends later: the last session is B, the last event belongs to A."""
    log = cp.pre_events(
        raw_log(spark, visit("u", 1, 0, "a"), visit("u", 2, 50, "b"), visit("u", 1, 100, "a"))
    )
    whole = cp.last_non_direct(cp.sessions(cp.pre_sessions(log)))
    by_event = cp.last_non_direct(cp.sessions(cp.pre_sessions(log, "event"), "event"))
    assert whole.first()["session_key"] == "u2"
    assert by_event.first()["session_key"] == "u1"


def test_shares_by_source(spark):
    sessions = cp.sessions(four_sessions(spark))
    shares = {tuple(r)[:3]: r[3] for r in cp.linear_by_source(cp.linear(sessions)).collect()}
    assert shares == {
        ("u", "google", "cpc"): 0.5,
        ("u", "bing", "organic"): 0.5,
        ("v", "(direct)", "(none)"): 1.0,
    }


def test_weights_add_up_for_every_cookie(spark):
    for name in ("attribution_linear", "attribution_linear_event_grain", "attribution_linear_by_source"):
        named = queries()[name](spark, SMOKE_DIR).where("user_pseudo_id is not null")
        off = named.groupBy("user_pseudo_id").agg(F.sum("attribution_weight").alias("w")).where("abs(w - 1) > 1e-9")
        assert off.count() == 0


@pytest.mark.parametrize("name", ["attribution_first_click", "attribution_last_non_direct", "unified_id"])
def test_one_row_per_cookie(spark, name):
    result = queries()[name](spark, SMOKE_DIR)
    assert result.count() == result.select("user_pseudo_id").distinct().count()


def logins(spark, *rows):
    events = [
        (None, day, at, "view", user, login, None, None, None, None, None, None, None) for user, login, at, day in rows
    ]
    return table(spark, "pre_events", *events)


def test_earliest_login_wins(spark):
    day = dt.date(2024, 1, 1)
    log = logins(
        spark,
        ("u", "late", 20, day), ("u", "early", 10, day), ("u", "late", 15, day), ("v", None, 1, day),
        ("w", "b", 5, day), ("w", "a", 5, day), (None, "x", 7, day), (None, "y", 6, day),
    )
    assert {tuple(r) for r in cp.unified_id(log).collect()} == {("u", "early"), ("w", "a"), (None, "y")}


def test_login_lookback(spark):
    log = logins(spark, ("u", "old", 1, dt.date(2024, 1, 1)), ("u", "new", 2, dt.date(2024, 1, 20)))
    as_of = dt.date(2024, 2, 1)
    assert cp.unified_id(log, as_of).first()["resolved_user_id"] == "new"
    assert cp.unified_id(log, as_of, lookback_days=31).first()["resolved_user_id"] == "old"
