from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from __spark_entry__ import SMOKE_DIR, _events, queries
from tests.rows import PURCHASE, item, order, raw_log, visit


@pytest.fixture(scope="module")
def shop(spark):
    log = raw_log(
        spark,
        visit("u", 1, 0, "google", "cpc", user_id="crm"),
        visit("u", 1, 10, event_name=PURCHASE, ecommerce=order("T1"), items=[item("a"), item("b", revenue=0.0)]),
        visit("u", 2, 100, "bing", "organic"),
        visit("u", 2, 110, event_name=PURCHASE, ecommerce=order("T2", 50.0), items=[]),
        visit("u", 2, 120, event_name=PURCHASE, ecommerce=order("T2", 50.0), items=None),
        visit("u", 2, 130, event_name=PURCHASE, ecommerce=order(None), items=[item("x")]),
        visit("u", 2, 140, event_name="refund", ecommerce=order("T4"), items=[item("x")]),
        visit(None, 5, 150, "mail", "email", event_name=PURCHASE, ecommerce=order("T5"), items=[item("c", quantity=None)]),
        visit("u", None, 160, event_name=PURCHASE, ecommerce=order("T6", None), items=[item("d")]),
    )
    events = cp.pre_events(log)
    sessions = cp.sessions(cp.pre_sessions(events))
    return events, sessions, cp.unified_id(events)


def test_purchase_gets_the_source_of_the_last_session_only(shop):
    events, sessions, ids = shop
    rows = cp.transactions(events, cp.last_non_direct(sessions), ids).collect()
    got = sorted((r["transaction_id"], r["resolved_user_id"], r["attribution_source"], r["attributed_revenue"]) for r in rows if r["transaction_id"] == "T2")
    assert got == [("T2", "crm", "bing", 50.0)] * 2
    others = {r["transaction_id"]: (r["resolved_user_id"], r["attribution_source"], r["attributed_revenue"]) for r in rows}
    assert others["T1"] == ("crm", None, None)
    assert others["T5"] == (None, None, None)
    assert others["T6"] == ("crm", None, None)
    assert len(rows) == 5


def test_session_scope_gives_each_purchase_its_own(shop):
    events, sessions, ids = shop
    rows = cp.transactions_session_scope(events, sessions, ids).collect()
    got = {r["transaction_id"]: (r["attribution_source"], r["attribution_medium"], r["attribution_weight"]) for r in rows}
    assert got == {
        "T1": ("google", "cpc", 1.0),
        "T2": ("bing", "organic", 1.0),
        "T5": (None, None, None),
        "T6": (None, None, None),
    }
    assert len(rows) == 5


def test_split_over_sources(shop):
    events, sessions, ids = shop
    rows = cp.transactions_split(events, cp.linear(sessions), ids).collect()
    first = {r["attribution_source"]: r["attributed_revenue"] for r in rows if r["transaction_id"] == "T1"}
    assert first == {"google": 50.0, "bing": 50.0}
    assert sum(r["transaction_id"] == "T5" for r in rows) == 1


def test_items(shop):
    events, sessions, _ = shop
    rows = cp.products(events, cp.last_non_direct(sessions)).collect()
    assert {(r["transaction_id"], r["item_id"]): r["item_revenue"] for r in rows} == {
        ("T1", "a"): 10.0,
        ("T1", "b"): 0.0,
        ("T5", "c"): None,
        ("T6", "d"): 10.0,
    }
    scoped = cp.products_session_scope(events, sessions).collect()
    assert {r["item_id"]: r["attribution_source"] for r in scoped} == {"a": "google", "b": "google", "c": None, "d": None}


def test_shared_key_text_does_not_double_an_order(spark):
    events = cp.pre_events(
        raw_log(
            spark,
            visit("1", 23, 0, "a", event_name=PURCHASE, ecommerce=order("T1")),
            visit("12", 3, 10, "b", event_name=PURCHASE, ecommerce=order("T2")),
        )
    )
    sessions, ids = cp.sessions(cp.pre_sessions(events)), cp.unified_id(events)
    scoped = cp.transactions_session_scope(events, sessions, ids).collect()
    assert {(r["transaction_id"], r["attribution_source"]) for r in scoped} == {("T1", "a"), ("T2", "b")}
    assert len(scoped) == 2
    # the joined key alone meets the attribution rows of both cookies
    assert cp.transactions(events, cp.last_non_direct(sessions), ids).count() == 4


def test_split_keeps_the_revenue(spark):
    split = queries()["report_transactions_linear_split"](spark, SMOKE_DIR)
    whole = _events(spark, SMOKE_DIR).where(
        "event_name = 'purchase' and ecommerce.transaction_id is not null and user_pseudo_id is not null"
    )
    # purchases of a cookie that has no session at all have nothing to be spread over
    total = split.agg(F.sum("attributed_revenue")).first()[0]
    expected = whole.agg(F.sum("ecommerce.purchase_revenue")).first()[0]
    assert total == pytest.approx(expected, rel=1e-9)
