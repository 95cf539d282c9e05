"""Events to sessions, and the last non-direct source along each cookie's path."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.functions import nulls_last_key, session_key
from clickpath.operators.events import reloaded
from clickpath.operators.skew import SPLIT_ABOVE, carry_forward, lookup_join
from clickpath.schema import columns
from clickpath.storage import stored

# What counts as direct, and what a path without any source gets.
DIRECT_SOURCE = "(direct)"
DIRECT_MEDIUM = "(none)"

# What tells one session from another.
SESSION_OWNER = ("user_pseudo_id", "ga_session_id")

# Total order of the sessions of one cookie.
PATH_ORDER = ("session_start_timestamp", "session_key", "ga_session_id")

_SOURCE, _MEDIUM, _TIME = "fixed_traffic_source", "fixed_traffic_medium", "event_timestamp"


def _in_session(events: DataFrame) -> DataFrame:
    return events.where(F.col("ga_session_id").isNotNull())


def _edge(pick: Callable[..., Column], name: str, *order: str) -> Column:
    return pick(F.col(name), F.when(F.col(name).isNotNull(), nulls_last_key(*order)))


def _first_and_last() -> list[Column]:
    """First and last known source and medium, in order of time, source, medium, nulls last.

    Aggregates, not windows: a session of any length leaves each task as one row.
    """
    return [
        _edge(F.min_by, _SOURCE, _TIME, _SOURCE).alias("session_first_source"),
        _edge(F.min_by, _MEDIUM, _TIME, _SOURCE, _MEDIUM).alias("session_first_medium"),
        _edge(F.max_by, _SOURCE, _TIME, _SOURCE).alias("session_last_source"),
        _edge(F.max_by, _MEDIUM, _TIME, _SOURCE, _MEDIUM).alias("session_last_medium"),
    ]


def pre_sessions(events: DataFrame, grain: str = "session") -> DataFrame:
    """Start, first and last traffic source of every session.

    ``grain="session"`` gives one row per session. ``grain="event"`` gives one row per
    session, source, medium and event time, each with its own time as the start and with
    the first and last source over all rows that share the session key.
    """
    if grain == "session":
        return _per_session(events)
    if grain == "event":
        return _per_event_time(events)
    raise ValueError(f"grain must be 'session' or 'event', not {grain!r}")


def _per_session(events: DataFrame) -> DataFrame:
    # Grouped by the two parts of the key: the joined text can be the same for two cookies.
    rolled = (
        _in_session(events)
        .groupBy(*SESSION_OWNER)
        .agg(F.min(_TIME).alias("session_start_timestamp"), *_first_and_last())
    )
    return rolled.withColumn("session_key", session_key(F.col("ga_session_id"))).select(*columns("pre_sessions"))


def owners_since(events: DataFrame, first_day: dt.date) -> DataFrame:
    """Owners of the sessions with an event of ``first_day`` or later, or without a date."""
    return _in_session(events).where(reloaded(first_day)).select(*SESSION_OWNER).distinct()


def rebuilt_sessions(events: DataFrame, existing: DataFrame, owners: DataFrame, first_day: dt.date) -> DataFrame:
    """The sessions of ``owners``, each from all of its events.

    ``owners`` are those of all events since ``first_day``, and may be more. ``existing``
    tells which of them began before that day, and when: of the older days only the
    events of these sessions are grouped, and no day before the earliest start is read.
    It must be complete up to ``first_day``.
    """
    known = join_sessions(existing, owners, "left_semi")
    # Days are cut in the reporting time zone, at most a day off from UTC.
    midnight = dt.datetime.combine(first_day + dt.timedelta(1), dt.time(), dt.timezone.utc)
    before = F.coalesce(F.col("session_start_timestamp") < F.lit(int(midnight.timestamp()) * 1_000_000), F.lit(True))
    early = known.where(before)
    earliest_start, any_early, undated = early.agg(
        F.min("session_start_timestamp"), F.count("*"), F.count_if(F.col("session_start_timestamp").isNull())
    ).first()
    recent = events.where(reloaded(first_day))
    if not any_early:
        return _per_session(recent)
    start = dt.date.min
    if not undated:
        start = dt.datetime.fromtimestamp(earliest_start // 1_000_000, dt.timezone.utc).date() - dt.timedelta(1)
    older = events.where((F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(first_day)))
    return _per_session(recent.unionByName(join_sessions(_in_session(older), early, "left_semi")))


def recent_sessions(events: DataFrame, existing: DataFrame, as_of: dt.date, lookback_days: int = 3) -> DataFrame:
    """Sessions with an event in the reload window, each rebuilt from all of its events.

    ``existing`` must be complete up to the window.
    """
    first_day = as_of - dt.timedelta(lookback_days)
    return rebuilt_sessions(events, existing, stored(owners_since(events, first_day), "session-owners"), first_day)


def join_sessions(left: DataFrame, right: DataFrame, how: str, *values: str) -> DataFrame:
    """Joins on the session owner, where two missing cookies are the same; keeps ``values`` of ``right``."""
    right = right.select(*[F.col(name).alias(f"_{name}") for name in SESSION_OWNER], *values)
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in SESSION_OWNER])
    return left.join(right, same, how).drop(*[f"_{name}" for name in SESSION_OWNER])


def _per_event_time(events: DataFrame) -> DataFrame:
    events = _in_session(events)
    moments = events.select(
        "session_key", "user_pseudo_id", "ga_session_id", F.col(_TIME).alias("session_start_timestamp"), _SOURCE, _MEDIUM
    ).distinct()
    edges = events.groupBy("session_key").agg(*_first_and_last())
    spread_by = ["ga_session_id", "session_start_timestamp"]
    return lookup_join(moments, edges, "session_key", spread_by, nulls_match=True).select(*columns("pre_sessions"))


def sessions(
    pre: DataFrame, grain: str = "session", split_above: int = SPLIT_ABOVE, block_rows: int = SPLIT_ABOVE
) -> DataFrame:
    """Sessions with the last non-direct source and medium so far, each carried on its own.

    ``pre`` is read twice and should be a stored table. The path of a cookie with more
    than ``split_above`` rows is walked in blocks of about ``block_rows``. At event grain,
    rows that differ in the last medium alone are one row here: the output has no such column,
    and in tables of ``pre_sessions`` it depends on the session key.
    """
    rows = pre.drop("session_last_medium")
    if grain == "event":
        rows = stored(rows.distinct(), "sessions-distinct")
    elif grain != "session":
        raise ValueError(f"grain must be 'session' or 'event', not {grain!r}")
    carried = carry_forward(rows, "user_pseudo_id", PATH_ORDER, non_direct(), split_above, block_rows)
    return carried.withColumns(or_direct()).select(*columns("sessions"))


def non_direct() -> dict[str, Column]:
    """Source and medium of a session where they are known and not direct, else NULL."""
    source, medium = F.col("session_first_source"), F.col("session_first_medium")
    return {
        "final_session_source": F.when(source != DIRECT_SOURCE, source),
        "final_session_medium": F.when(medium != DIRECT_MEDIUM, medium),
    }


def or_direct() -> dict[str, Column]:
    """Final source and medium, direct where nothing was carried."""
    return {
        "final_session_source": F.coalesce("final_session_source", F.lit(DIRECT_SOURCE)),
        "final_session_medium": F.coalesce("final_session_medium", F.lit(DIRECT_MEDIUM)),
    }
