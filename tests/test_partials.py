"""Partial results per day, and what a daily load reads and writes."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import clickpath as cp
from clickpath.operators import partials
from clickpath.plans.full import start_day
from clickpath.storage import stored
from tests.rows import PURCHASE, item, order, raw_log, same_rows, visit
from tests.test_daily import AS_OF, DAY, assert_same_tables, changed, random_event, reread


def events_of(spark, seed: int):
    draw = random.Random(seed)
    return cp.pre_events(raw_log(spark, *[random_event(draw, 0, 10 * DAY, i) for i in range(120)]), dates="lenient")


@pytest.mark.parametrize("seed", range(3))
def test_merged_partials_equal_the_whole(spark, seed):
    events = stored(events_of(spark, seed), "events")
    assert same_rows(partials.merged_sessions(partials.session_days(events)), cp.pre_sessions(events))
    assert same_rows(partials.merged_identities(partials.identity_days(events)), cp.unified_id(events))
    days = partials.session_days(events)
    assert days.groupBy("user_pseudo_id", "ga_session_id", "event_date").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("carry", [{}, {"split_above": 2, "block_rows": 3}])
@pytest.mark.parametrize("seed", range(3))
def test_resumed_paths_equal_whole_ones(spark, seed, carry):
    """Whatever the day that a session lies under: it need not be that of its start."""
    draw = random.Random(seed)
    moved = F.date_add(start_day(), F.pmod(F.xxhash64("session_key"), F.lit(3)).cast("int"))
    old, new = (
        stored(cp.pre_sessions(events_of(spark, s)).withColumn("session_day", moved if draw.random() < 0.7 else start_day()), "pre")
        for s in (seed, seed if seed == 2 else seed + 10)
    )
    # all but the last days are the same
    cut = F.lit(1_704_067_200_000_000 + 6 * DAY * 1_000_000)
    early = old.where(F.col("session_start_timestamp") < cut)
    new = stored(early.unionByName(new.where(F.col("session_start_timestamp") >= cut)), "pre-new")
    differing = stored(partials.changed_rows(old, new), "differing")
    changes = stored(partials.changed_from(differing), "changes")
    rewritten = [r[0] for r in differing.select("session_day").distinct().collect()]
    days = partials.path_days(old)
    holding = days.where(~F.col("session_day").isin(rewritten)) if rewritten else days
    reaching = partials.with_change(holding, changes, ["session_day"]).where("last_place >= from_place")
    walked = rewritten + [r[0] for r in reaching.select("session_day").distinct().collect()]
    pre = new.where(F.col("session_day").isin(walked)) if walked else new.limit(0)
    resumed = partials.resumed_paths(pre, partials.path_openings(holding, changes), changes, **carry)
    whole = cp.sessions(new).join(new.select("session_key", "user_pseudo_id", "ga_session_id", "session_day"), ["session_key", "user_pseudo_id", "ga_session_id"])
    place = partials._place()
    expected = partials.with_change(cp.sessions(new), changes, ["ga_session_id"]).where(place >= F.col("from_place")).drop("from_place")
    assert whole.count() >= expected.count()
    assert same_rows(resumed.drop("session_day"), expected)


@pytest.mark.parametrize("options", [{"scope": "session"}, {"scope": "linear"}, {"model": "first_click"}, {"identity_as_of": dt.date(2024, 2, 5)}])
def test_daily_equals_full_with_every_report(spark, tmp_path, options):
    draw = random.Random(str(options))
    before = [random_event(draw, 0, 10 * DAY, i) for i in range(60)]
    after = changed(draw, before)
    daily = cp.full_refresh(raw_log(spark, *before), cp.Warehouse(spark, str(tmp_path / "daily")), dates="lenient", **options)
    cp.daily_refresh(raw_log(spark, *after), daily, AS_OF, dates="lenient", **options)
    full = cp.full_refresh(raw_log(spark, *after), cp.Warehouse(spark, str(tmp_path / "full")), dates="lenient", **options)
    assert_same_tables(daily, full)
    if options != {"scope": "session"}:
        return
    # a load with other reports builds these anew
    other = {"scope": "cookie", "model": "last_non_direct"}
    cp.daily_refresh(raw_log(spark, *after), daily, AS_OF, dates="lenient", **other)
    full = cp.full_refresh(raw_log(spark, *after), full, dates="lenient", **other)
    assert_same_tables(daily, full)


def test_many_loads_equal_a_full_one(spark, tmp_path):
    draw = random.Random(11)
    log = [e for e in (random_event(draw, 0, 10 * DAY, i) for i in range(80)) if not reread(e) or e["event_date"] and e["event_date"] >= "20240108"]
    log = [e for e in log if len(e["event_date"]) == 8 and e["event_date"] < "2025"]
    daily = cp.Warehouse(spark, str(tmp_path / "daily"))
    for day in (4, 6, 7, 10):
        cp.daily_refresh(raw_log(spark, *[e for e in log if e["event_date"] <= f"202401{day:02d}"]), daily, dt.date(2024, 1, day), lookback_days=2)
    assert_same_tables(daily, cp.full_refresh(raw_log(spark, *log), cp.Warehouse(spark, str(tmp_path / "full"))))


def places(warehouse, table):
    return dict(warehouse.snapshot().places[table])


def test_old_events_are_not_read(spark, tmp_path):
    """The files of older days can no longer be read: the load needs none of them but on report days that change."""
    old = [visit(u, 1, d * DAY, "a", user_id=f"l{u}") for u in "uvw" for d in range(3)] + [visit("u", 2, 6 * DAY, "b")]
    new = [visit("u", 1, 8 * DAY, "c"), visit("u", 2, 8 * DAY, "d"), visit("v", 3, 9 * DAY, "e", event_name=PURCHASE, ecommerce=order("T1"))]
    daily = cp.full_refresh(raw_log(spark, *old), cp.Warehouse(spark, str(tmp_path / "daily")))
    for file in Path(daily.path("pre_events")).rglob("*.parquet"):
        file.write_bytes(b"no Parquet file")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    before = {table: places(daily, table) for table in ("pre_events", "pre_sessions", "sessions")}
    # the newest day there is counts as incomplete and is read again
    cp.daily_refresh(raw_log(spark, old[-1], *new), daily, AS_OF, lookback_days=3)
    full = cp.full_refresh(raw_log(spark, *old, *new), cp.Warehouse(spark, str(tmp_path / "full")))
    for table in ("pre_sessions", "sessions", "unified_id", "attribution_linear", "attribution_last_non_direct", "transactions"):
        flat = lambda df: df.select(*[F.col(c).cast("string") for c in df.columns])
        assert same_rows(flat(daily.read(table)), flat(full.read(table))), table
    # days without a changed row keep their files
    assert all(places(daily, "pre_events")[day] == load for day, load in before["pre_events"].items() if day < "2024-01-07")
    assert places(daily, "sessions")["2024-01-07"] != before["sessions"]["2024-01-07"]


def test_a_load_without_changes_writes_no_path_and_no_report(spark, tmp_path):
    log = [visit("u", 1, 8 * DAY, "a", user_id="l", event_name=PURCHASE, ecommerce=order("T1"), items=[item("x")]), visit("v", 1, 2 * DAY, "b")]
    daily = cp.full_refresh(raw_log(spark, *log), cp.Warehouse(spark, str(tmp_path)))
    before = daily.snapshot().places
    cp.daily_refresh(raw_log(spark, *log), daily, AS_OF)
    after = daily.snapshot().places
    for table in ("pre_sessions", "sessions", "path_days", "unified_id", "attribution_first_click", "attribution_linear"):
        assert after[table] == before[table], table


def test_only_report_days_that_change_are_written(spark, tmp_path):
    """A later session takes the cookie's attribution away from an old purchase, and a late login renames another."""

    def buy(user, session, day, number, **more):
        return visit(user, session, day * DAY, "a", "m", event_name=PURCHASE, ecommerce=order(number), items=[item("x")], **more)

    old = [buy("u", 1, 0, "T1"), buy("v", 1, 1, "T2"), buy("w", 1, 2, "T3"), buy("x", 1, 3, "T4", user_id="l"), visit("z", 1, 7 * DAY, "q")]
    daily = cp.full_refresh(raw_log(spark, *old), cp.Warehouse(spark, str(tmp_path / "daily")))
    before = {table: places(daily, table) for table in ("transactions", "products")}
    new = [visit("v", 2, 8 * DAY, "b", "m"), visit("w", 3, 9 * DAY, None, user_id="late")]
    cp.daily_refresh(raw_log(spark, *old, *new), daily, AS_OF)
    for table in before:
        now = places(daily, table)
        assert {day for day in now if now[day] != before[table].get(day)} == {"2024-01-02", "2024-01-03"}
    assert_same_tables(daily, cp.full_refresh(raw_log(spark, *old, *new), cp.Warehouse(spark, str(tmp_path / "full"))))
    found = {r["transaction_id"]: (r["attribution_source"], r["resolved_user_id"]) for r in daily.read("transactions").collect()}
    assert found == {"T1": ("a", None), "T2": (None, None), "T3": (None, "late"), "T4": ("a", "l")}


def test_a_login_that_goes_gives_way_to_the_next(spark, tmp_path):
    old = [visit("u", 1, 9 * DAY, "a", user_id="second"), visit("u", 1, 8 * DAY, "a", user_id="first"), visit("v", 1, 0, user_id="kept")]
    daily = cp.full_refresh(raw_log(spark, *old), cp.Warehouse(spark, str(tmp_path)))
    logins = lambda: {r[0]: r[1] for r in daily.read("unified_id").collect()}
    assert logins() == {"u": "first", "v": "kept"}
    cp.daily_refresh(raw_log(spark, old[0], old[2]), daily, AS_OF)
    assert logins() == {"u": "second", "v": "kept"}
    cp.daily_refresh(raw_log(spark, old[2]), daily, AS_OF)
    assert logins() == {"v": "kept"}


def test_a_removal_deep_in_a_path(spark, tmp_path):
    """The session that gave the source goes; sessions after it fall back to the one before, in windows far apart."""
    log = [visit("u", 1, 0, "a", "m"), visit("u", 2, 8 * DAY, "b", "n")] + [visit("u", 3 + d, (8 + d) * DAY + 5, "(direct)", "(none)") for d in range(1, 8)]
    daily = cp.full_refresh(raw_log(spark, *log), cp.Warehouse(spark, str(tmp_path / "daily")))
    assert {r["final_session_source"] for r in daily.read("sessions").where("ga_session_id > 2").collect()} == {"b"}
    gone = raw_log(spark, log[0], *log[2:])
    cp.daily_refresh(gone, daily, dt.date(2024, 1, 12), lookback_days=4)
    assert {r["final_session_source"] for r in daily.read("sessions").collect()} == {"a"}
    assert_same_tables(daily, cp.full_refresh(gone, cp.Warehouse(spark, str(tmp_path / "full"))))


def test_reads_of_days_open_their_folders_only(spark, tmp_path):
    """Which write a day comes from and which days are asked for are both settled by folder names."""
    log = [visit("u", 1, d * DAY, "a") for d in range(10)]
    warehouse = cp.full_refresh(raw_log(spark, *log), cp.Warehouse(spark, str(tmp_path)))
    cp.daily_refresh(raw_log(spark, *log, visit("v", 2, 9 * DAY)), warehouse, AS_OF)
    some = warehouse.read("pre_events").where("event_date >= '2024-01-09'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:") :].split("]")[0]
    assert "event_date" in filters and "load" in filters
    assert len(some.inputFiles()) >= 2 and some.count() == 3
    assert some.select(F.input_file_name()).distinct().count() <= 3
