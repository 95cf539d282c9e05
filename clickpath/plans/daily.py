"""The daily load: events of the last days, and of every other table what they change.

Old events are not read again. Sessions, identities and paths are put together from partial results per
day (``operators.partials``); what differs from the tables of the load before decides which sessions, paths,
attributions and report days are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath import operators as ops
from clickpath.functions import nulls_last_key
from clickpath.operators import partials
from clickpath.operators.events import reloaded
from clickpath.operators.partials import changed_rows, with_change
from clickpath.operators.sessions import PATH_ORDER, SESSION_OWNER, join_sessions
from clickpath.operators.skew import lookup_join
from clickpath.plans.full import (
    TOUCH_TABLES, as_state, check_reports, full_refresh, identities, load_options, newest_day, report_options, reports, start_day,
    write_reports,
)
from clickpath.sinks import Load, Snapshot, Warehouse
from clickpath.sinks.audit import check_keys
from clickpath.sinks.warehouse import SESSION_DAY
from clickpath.sources.changes import restated_days
from clickpath.sources.exports import RAW_DATE
from clickpath.storage import at_the_same_time, stored, working_under

Days = set[dt.date | None]


class Window:
    """The days that a load reads again: those since a day, undated events, and single days before."""

    def __init__(self, since: dt.date, restated: Iterable[dt.date] = ()):
        self.since, self.restated = since, sorted(day for day in restated if day < since)

    def holds(self) -> Column:
        """Whether a flat event, or what is kept of its day, belongs to the window; never NULL."""
        recent = reloaded(self.since)
        return recent | F.col("event_date").isin(self.restated) if self.restated else recent

    def events(self, raw: DataFrame, **options: str) -> DataFrame:
        """The flat events of the window."""
        recent = ops.pre_events_since(raw, self.since, **options)
        if not self.restated:
            return recent
        days = raw.where(F.col("event_date").isin([day.strftime(RAW_DATE) for day in self.restated]))
        return recent.unionByName(ops.pre_events(days, **options))

    def days(self, snapshot: Snapshot, table: str) -> Days:
        """Partitions of a table that belong to the window."""
        return {day for day in snapshot.days(table) if day is None or day >= self.since or day in self.restated}

_COOKIE = "user_pseudo_id"
_SPREAD = ["ga_session_id", "session_start_timestamp"]


def today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def first_day(warehouse: Warehouse, as_of: dt.date, lookback_days: int) -> dt.date | None:
    """The day that a daily load reads from; None if it has to build everything.

    After a gap the window reaches back to the newest day there is, which may be incomplete.
    """
    state = warehouse.state()
    if state is None:
        return None
    window = as_of - dt.timedelta(lookback_days)
    return min(window, dt.date.fromisoformat(state["newest_day"])) if state["newest_day"] else dt.date.min


def daily_refresh(
    raw: DataFrame,
    warehouse: Warehouse,
    as_of: dt.date | None = None,
    lookback_days: int = 3,
    scope: str = "cookie",
    model: str = "last_non_direct",
    identity_as_of: dt.date | None = None,
    source: Mapping[str, str] | None = None,
    audit: bool = False,
    **event_options: str,
) -> Warehouse:
    """Load the reload window of ``as_of`` (today, UTC); without a finished load everything is built.

    With ``source``, a ``source_log`` of the raw log, older days whose files have changed since the last load that
    was given one are loaded as well. With ``audit`` a load that repeats a declared key in the partitions that it
    writes is refused, and the tables stay as they are (``sinks.audit``).

    The tables are then those of a full load of the same log. Only session grain can be
    loaded this way: at event grain a session has many rows and no key to replace them by.
    A table that was loaded with other options is refused.
    """
    check_reports(scope, model)
    as_of = as_of or today()
    since = first_day(warehouse, as_of, lookback_days)
    if since is None:
        return full_refresh(raw, warehouse, scope=scope, model=model, identity_as_of=identity_as_of, source=source, audit=audit, **event_options)
    old = warehouse.snapshot()
    options = load_options("session", event_options)
    other = {name: old.state[name] for name in options if old.state[name] != options[name]}
    if other:
        raise ValueError(f"the tables were loaded with {other}; a daily load must use the same or follow a full one")
    wanted = report_options(scope, model, identity_as_of)
    seen = old.state.get("source")
    window = Window(since, restated_days(seen, source) if seen is not None and source is not None else ())
    with working_under(warehouse.spark, warehouse.work_dir), warehouse.loading() as load:
        recent = _load_events(raw, load, old, window, event_options)
        (session_changes, touched), new_logins = at_the_same_time(
            lambda: _load_paths_and_attribution(load, old, window), lambda: _load_identities(load, old, window, identity_as_of)
        )
        if old.state["reports"] == wanted and new_logins is not None:
            _load_reports(load, old, window, scope, model, session_changes, touched, new_logins)
        else:
            write_reports(load, reports(load, scope, model))
        if audit:
            check_keys(load, old)
        before = old.state["newest_day"]
        known = [day for day in (newest_day(recent), before and dt.date.fromisoformat(before)) if day]
        load.state = as_state(options | {"reports": wanted, "source": source and dict(source)}, max(known, default=None))
    return warehouse


def _days(rows: DataFrame, column: str) -> Days:
    """One entry per calendar day."""
    return {row[0] for row in rows.select(column).distinct().collect()}


def _on(column: str, days: Iterable[dt.date | None]) -> Column:
    """Whether a day is one of ``days``; never NULL."""
    days = set(days)
    listed = F.coalesce(F.col(column).isin([day for day in days if day]), F.lit(False)) if days - {None} else F.lit(False)
    return listed | F.col(column).isNull() if None in days else listed


def _load_events(raw: DataFrame, load: Load, old: Snapshot, window: Window, event_options: dict[str, str]) -> DataFrame:
    """Replace the days of the window in the events and in what is kept of each day."""
    load.replace_days("pre_events", window.events(raw, **event_options), window.days(old, "pre_events"))
    recent = load.read("pre_events").where(window.holds())

    def keep(table: str) -> DataFrame:
        return load.replace_days(table, getattr(partials, table)(recent), window.days(old, table))

    at_the_same_time(*[lambda table=table: keep(table) for table in ("session_days", "identity_days", "purchase_days")])
    return recent


def _load_paths_and_attribution(load: Load, old: Snapshot, window: Window) -> tuple[DataFrame, dict[str, DataFrame]]:
    session_changes = _load_paths(load, old, _load_sessions(load, old, window))
    return session_changes, _load_attribution(load, old, session_changes)


def _changed_in_window(table: str, load: Load, old: Snapshot, window: Window) -> DataFrame:
    return changed_rows(old.read(table).where(window.holds()), load.read(table).where(window.holds()))


def _load_sessions(load: Load, old: Snapshot, window: Window) -> DataFrame:
    """Rebuild the sessions whose events of the window have changed; returns the sessions that differ, before and after."""
    changed = _changed_in_window("session_days", load, old, window)
    owners = stored(changed.select(*SESSION_OWNER).distinct(), "session-owners")
    sessions = old.read_stored("pre_sessions")
    known = stored(join_sessions(sessions, owners, "left_semi"), "sessions-known")
    days = load.read("session_days")
    recent, older = days.where(window.holds()), days.where(~window.holds() & _since_start(known))
    rebuilt = partials.merged_sessions(join_sessions(recent.unionByName(older), owners, "left_semi"))
    found = join_sessions(rebuilt, known, "left", SESSION_DAY)
    placed = stored(found.withColumn(SESSION_DAY, F.coalesce(F.col(SESSION_DAY), start_day())), "sessions-placed")
    differing = stored(changed_rows(known, placed), "sessions-differing")
    concerned = _days(differing, SESSION_DAY)
    if concerned:
        kept = join_sessions(sessions.where(_on(SESSION_DAY, concerned)), owners, "left_anti")
        load.replace_days("pre_sessions", kept.unionByName(placed.where(_on(SESSION_DAY, concerned))), concerned)
    return differing


def _since_start(known: DataFrame) -> Column:
    """The days from which the known sessions can have events."""
    start, undated, count = known.agg(
        F.min("session_start_timestamp"), F.count_if(F.col("session_start_timestamp").isNull()), F.count("*")
    ).first()
    if not count:
        return F.lit(False)
    first = dt.date.min
    if not undated:
        # days are cut in the reporting time zone, at most a day off from UTC
        first = dt.datetime.fromtimestamp(start // 1_000_000, dt.timezone.utc).date() - dt.timedelta(1)
    return F.col("event_date") >= F.lit(first)


def _load_paths(load: Load, old: Snapshot, differing: DataFrame) -> DataFrame:
    """Walk the changed paths on from their first change; returns the rows of ``sessions`` that differ, before and after."""
    none = load.warehouse.spark.createDataFrame([], old.read_stored("sessions").schema)
    rewritten = _days(differing, SESSION_DAY)
    if not rewritten:
        return none
    changes = stored(partials.changed_from(differing), "paths-changed")
    pre = load.read_stored("pre_sessions")
    load.replace_days("path_days", partials.path_days(pre.where(_on(SESSION_DAY, rewritten))), rewritten)
    holding = old.read("path_days").where(~_on(SESSION_DAY, rewritten))
    reaching = with_change(holding, changes, [SESSION_DAY]).where(F.col("last_place") >= F.col("from_place"))
    walked = rewritten | _days(reaching, SESSION_DAY)
    openings = partials.path_openings(holding, changes)
    resumed = stored(partials.resumed_paths(pre.where(_on(SESSION_DAY, walked)), openings, changes), "sessions-resumed")

    place = nulls_last_key(*PATH_ORDER)

    def marked(days: Days) -> DataFrame:
        return with_change(old.read_stored("sessions").where(_on(SESSION_DAY, days)), changes, _SPREAD)

    before = marked(walked).where(place >= F.col("from_place")).drop("from_place")
    session_changes = stored(changed_rows(before, resumed), "sessions-changed")
    days = _days(session_changes, SESSION_DAY)
    if days:
        kept = marked(days).where(F.col("from_place").isNull() | (place < F.col("from_place"))).drop("from_place")
        load.replace_days("sessions", kept.unionByName(resumed.where(_on(SESSION_DAY, days))), days)
    return session_changes


def _marked(rows: DataFrame, keys: DataFrame, spread_by: list[str], key: str = _COOKIE) -> DataFrame:
    """``rows`` with ``_hit`` where ``keys`` has their key."""
    return lookup_join(rows, keys.withColumn("_hit", F.lit(True)), key, spread_by, nulls_match=True)


def _among(rows: DataFrame, keys: DataFrame, spread_by: list[str], key: str = _COOKIE) -> DataFrame:
    return _marked(rows, keys, spread_by, key).where(F.col("_hit").isNotNull()).drop("_hit")


def _without(rows: DataFrame, keys: DataFrame, spread_by: list[str], key: str = _COOKIE) -> DataFrame:
    return _marked(rows, keys, spread_by, key).where(F.col("_hit").isNull()).drop("_hit")


def _load_attribution(load: Load, old: Snapshot, session_changes: DataFrame) -> dict[str, DataFrame]:
    """Choose anew for cookies with changed sessions; returns the rows of each single-touch table that differ."""
    touched = stored(session_changes.select(_COOKIE).distinct(), "cookies-touched")
    if touched.isEmpty():
        return {}
    own = stored(_among(load.read("sessions"), touched, _SPREAD), "sessions-touched")

    def choose(model: str, table: str) -> DataFrame:
        new = stored(getattr(ops, model)(own), "touches-new")
        rows = old.read(table)
        load.replace(table, _without(rows, touched, ["session_key"]).unionByName(new))
        return stored(changed_rows(_among(rows, touched, ["session_key"]), new), "touches-differing")

    *differing, _ = at_the_same_time(
        *[lambda model=model, table=table: choose(model, table) for model, table in TOUCH_TABLES.items()],
        lambda: load.replace("attribution_linear", ops.linear(load.read("sessions"))),
    )
    return dict(zip(TOUCH_TABLES, differing))


def _load_identities(load: Load, old: Snapshot, window: Window, as_of: dt.date | None) -> DataFrame | None:
    """The first login of cookies whose logins have changed; returns the rows that differ, or None if all were built anew."""
    days = load.read("identity_days")
    if as_of is not None or old.state["reports"]["identity_as_of"] is not None:
        load.replace("unified_id", identities(days, as_of))
        return None
    cookies = stored(_changed_in_window("identity_days", load, old, window).select(_COOKIE).distinct(), "cookies-identified")
    new = stored(partials.merged_identities(_among(days, cookies, ["event_date"])), "identities-new")
    rows = old.read("unified_id")
    differing = stored(changed_rows(_among(rows, cookies, ["resolved_user_id"]), new), "identities-differing")
    if not differing.isEmpty():
        load.replace("unified_id", _without(rows, cookies, ["resolved_user_id"]).unionByName(new))
    return differing


def _load_reports(
    load: Load, old: Snapshot, window: Window, scope: str, model: str,
    session_changes: DataFrame, touched: dict[str, DataFrame], new_logins: DataFrame,
) -> None:
    """Write the report days on which a purchase, its attribution or its login has changed."""
    purchases = load.read("purchase_days").where(~window.holds())
    spread = ["ga_session_id", "event_date"]
    found = [_among(purchases, new_logins.select(_COOKIE).distinct(), spread)]
    if scope == "cookie" and touched:
        keys = touched[model].where(F.col("session_key").isNotNull()).select("session_key").distinct()
        found.append(_among(purchases, keys, spread, "session_key"))
    elif scope == "session":
        found.append(join_sessions(purchases, session_changes.select(*SESSION_OWNER).distinct(), "left_semi"))
    elif scope == "linear":
        found.append(_among(purchases, session_changes.select(_COOKIE).distinct(), spread))
    days = window.days(old, "purchase_days") | window.days(load, "purchase_days")
    for rows in found:
        days |= _days(rows, "event_date")
    if days:
        write_reports(load, reports(load, scope, model, _on("event_date", days)), days)
