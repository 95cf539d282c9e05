"""Declared keys."""

from __future__ import annotations

import pytest

import clickpath as cp
from clickpath.sinks.audit import KEYS
from tests.rows import raw_log, visit
from tests.test_daily import AS_OF, DAY, rows_of


def found(warehouse) -> dict[str, tuple]:
    return {r["table_name"]: tuple(r)[1:] for r in cp.violations(warehouse.snapshot()).collect()}


def test_counts(spark, tmp_path):
    once = [visit("u", 1, 0, "a", user_id="l"), visit(None, 2, DAY, "b"), visit(None, 3, 2 * DAY, "b"), visit("v", 1, 3 * DAY)]
    assert found(cp.full_refresh(raw_log(spark, *once), cp.Warehouse(spark, str(tmp_path / "a")))) == {
        "pre_events": (4, 2, 0, 0), "pre_sessions": (4, 0, 0, 0), "sessions": (4, 0, 0, 0), "unified_id": (1, 0, 0, 0),
        "attribution_first_click": (3, 1, 0, 0), "attribution_last_non_direct": (3, 1, 0, 0),
    }
    twice = cp.full_refresh(raw_log(spark, *once, *once, once[0]), cp.Warehouse(spark, str(tmp_path / "b")))
    assert found(twice)["pre_events"] == (9, 4, 2, 3)
    assert all(found(twice)[name][2] == 0 for name in KEYS if name != "pre_events")
    empty = cp.full_refresh(raw_log(spark, once[0]).limit(0), cp.Warehouse(spark, str(tmp_path / "c")))
    assert set(found(empty).values()) == {(0, 0, 0, 0)}


def test_a_load_with_a_repeated_key_is_refused(spark, tmp_path):
    log = [visit("u", 1, 0, "a"), visit("u", 1, 8 * DAY, "b"), visit("v", 2, 9 * DAY, "c")]
    warehouse = cp.full_refresh(raw_log(spark, *log[:2]), cp.Warehouse(spark, str(tmp_path)), audit=True)
    before = rows_of(warehouse)
    for refresh in (cp.full_refresh, lambda raw, w, **o: cp.daily_refresh(raw, w, AS_OF, **o)):
        with pytest.raises(cp.KeyViolation, match="pre_events: 1 keys in 1 rows too many"):
            refresh(raw_log(spark, *log, log[2]), warehouse, audit=True)
        assert rows_of(warehouse) == before
    cp.daily_refresh(raw_log(spark, *log), warehouse, AS_OF, audit=True)
    # without the audit it is loaded as it comes
    cp.daily_refresh(raw_log(spark, *log, log[2]), warehouse, AS_OF)
    assert warehouse.read("pre_events").count() == 4
    # partitions that a load leaves alone are not judged again
    cp.full_refresh(raw_log(spark, log[0], *log), warehouse)
    cp.daily_refresh(raw_log(spark, *log), warehouse, AS_OF, audit=True)


def test_only_partitions_of_the_load_are_judged(spark, tmp_path):
    log = [visit("u", 1, 0, "a"), visit("u", 1, 8 * DAY, "b")]
    warehouse = cp.full_refresh(raw_log(spark, log[0], *log), cp.Warehouse(spark, str(tmp_path)))
    assert found(warehouse)["pre_events"][2] == 1
    cp.daily_refresh(raw_log(spark, *log, visit("v", 3, 9 * DAY, "c")), warehouse, AS_OF, audit=True)
    assert warehouse.read("sessions").count() == 2
