"""Upserts of the two incremental tables, as whole tables.

The daily job writes the same result by replacing only the partitions concerned; see
``clickpath.plans``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.operators.events import pre_events_since, reloaded
from clickpath.operators.sessions import join_sessions, owners_since, rebuilt_sessions
from clickpath.operators.skew import without
from clickpath.storage import stored


def pre_events_incremental(
    raw: DataFrame,
    existing: DataFrame,
    as_of: dt.date,
    lookback_days: int = 3,
    match: str = "date",
    **options: str,
) -> DataFrame:
    """``existing`` with the events of the reload window loaded again.

    ``match="date"`` replaces the days of the window. ``match="event_id"`` replaces events
    by id and keeps the other rows of these days; an event without an id matches nothing
    and is added once more on every load. An id contains the event time, so older days
    cannot hold a match and pass through untouched. Undated events are all read again and
    replaced in the same way.
    """
    first_day = as_of - dt.timedelta(lookback_days)
    recent = pre_events_since(raw, first_day, **options)
    window = reloaded(first_day)
    older = existing.where(~window)
    if match == "date":
        return older.unionByName(recent)
    if match == "event_id":
        kept = without(existing.where(window), recent, "event_id", ["event_timestamp", "event_name"])
        return older.unionByName(kept).unionByName(recent)
    raise ValueError(f"match must be 'date' or 'event_id', not {match!r}")


def upsert_sessions(existing: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``existing`` with every session in ``rebuilt`` replaced or added, null-safe on its owner."""
    return join_sessions(existing, rebuilt, "left_anti").unionByName(rebuilt)


def pre_sessions_incremental(
    events: DataFrame, existing: DataFrame, as_of: dt.date, lookback_days: int = 3, before: DataFrame | None = None
) -> DataFrame:
    """``existing`` with the sessions of the reload window rebuilt from all their events.

    ``before`` is the event table that ``existing`` was built from. It tells which sessions
    have lost events since, so that they are rebuilt too, or go with their last event.
    Without it no event of the window may have been removed.
    """
    first_day = as_of - dt.timedelta(lookback_days)
    owners = owners_since(events, first_day)
    if before is not None:
        owners = owners.union(owners_since(before, first_day)).distinct()
    owners = stored(owners, "session-owners")
    rebuilt = stored(rebuilt_sessions(events, existing, owners, first_day), "sessions-rebuilt")
    return join_sessions(existing, owners, "left_anti").unionByName(rebuilt)
