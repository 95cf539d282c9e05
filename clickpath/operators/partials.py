"""Partial results per day, from which sessions, identities and paths are put together without old events.

A partial is an aggregate that combines with others of its key by the same aggregate. Replacing a day
replaces its partials; what a removed event had given goes with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.functions import nulls_last_key, session_key
from clickpath.operators.reports import _purchases
from clickpath.operators.sessions import PATH_ORDER, SESSION_OWNER, _in_session, non_direct, or_direct
from clickpath.operators.skew import carry_forward, lookup_join
from clickpath.schema import STATE_TABLES, columns
from clickpath.storage import stored

_SOURCE, _MEDIUM, _TIME = "fixed_traffic_source", "fixed_traffic_medium", "event_timestamp"

# For each column of a partial: the aggregate it combines by and the columns that order the events.
_EDGES: dict[str, tuple[Callable[[Column], Column], tuple[str, ...]]] = {
    "first_source": (F.min, (_TIME, _SOURCE)),
    "first_medium": (F.min, (_TIME, _SOURCE, _MEDIUM)),
    "last_source": (F.max, (_TIME, _SOURCE)),
    "last_medium": (F.max, (_TIME, _SOURCE, _MEDIUM)),
}


def _state_columns(table: str) -> list[str]:
    return STATE_TABLES[table].fieldNames()


def session_days(events: DataFrame) -> DataFrame:
    """Start, and the first and last event with a source and with a medium, of every session on every day.

    The order keys end in the value itself, so they are all that is kept.
    """
    edges = [
        pick(F.when(F.col(order[-1]).isNotNull(), nulls_last_key(*order))).alias(name) for name, (pick, order) in _EDGES.items()
    ]
    by_day = _in_session(events).groupBy(*SESSION_OWNER, "event_date")
    return by_day.agg(F.min(_TIME).alias("session_start_timestamp"), *edges).select(*_state_columns("session_days"))


def merged_sessions(days: DataFrame) -> DataFrame:
    """The sessions that partials make up; equal to ``pre_sessions`` of their events."""
    merged = days.groupBy(*SESSION_OWNER).agg(
        F.min("session_start_timestamp").alias("session_start_timestamp"),
        *[pick(name)[order[-1]].alias(f"session_{name}") for name, (pick, order) in _EDGES.items()],
    )
    return merged.withColumn("session_key", session_key(F.col("ga_session_id"))).select(*columns("pre_sessions"))


def identity_days(events: DataFrame) -> DataFrame:
    """The first login of every cookie on every day."""
    first = F.min(nulls_last_key("event_timestamp", "user_id")).alias("first_login")
    logged_in = events.where(F.col("user_id").isNotNull())
    return logged_in.groupBy("user_pseudo_id", "event_date").agg(first).select(*_state_columns("identity_days"))


def merged_identities(days: DataFrame) -> DataFrame:
    """The login seen first for each cookie; equal to ``unified_id`` of the events."""
    first = F.min("first_login")["user_id"].alias("resolved_user_id")
    return days.groupBy("user_pseudo_id").agg(first).select(*columns("unified_id"))


def purchase_days(events: DataFrame) -> DataFrame:
    """Who bought on which day, in which session."""
    return _purchases(events).select(*_state_columns("purchase_days")).distinct()


def _place() -> Column:
    return nulls_last_key(*PATH_ORDER)


def path_days(pre: DataFrame) -> DataFrame:
    """Of every cookie and day of ``pre`` (with ``session_day``): its last session, and the last source and medium that are not direct."""
    own = dict(zip(("last_source", "last_medium"), zip(("session_first_source", "session_first_medium"), non_direct().values())))
    carried = [
        F.max(F.when(value.isNotNull(), F.struct(_place().alias("place"), value.alias(name)))).alias(column)
        for column, (name, value) in own.items()
    ]
    by_day = pre.groupBy("user_pseudo_id", "session_day")
    return by_day.agg(F.max(_place()).alias("last_place"), *carried).select(*_state_columns("path_days"))


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, as often as it has them more."""
    return old.exceptAll(new).unionByName(new.exceptAll(old))


def changed_from(changed_sessions: DataFrame) -> DataFrame:
    """(user_pseudo_id, from_place): where each cookie's path changes first."""
    return changed_sessions.groupBy("user_pseudo_id").agg(F.min(_place()).alias("from_place"))


def with_change(rows: DataFrame, changes: DataFrame, spread_by: list[str]) -> DataFrame:
    """``rows`` with ``from_place`` of their cookie, NULL where its path has not changed."""
    return lookup_join(rows, changes, "user_pseudo_id", spread_by, nulls_match=True)


def path_openings(days: DataFrame, changes: DataFrame) -> DataFrame:
    """What the days before a change leave to each changed path, as rows of ``pre_sessions`` at the place they come from.

    ``days`` are those partials of ``path_days`` that still hold; days that reach past the change give none.
    """
    before = with_change(days, changes, ["session_day"]).where(F.col("last_place") < F.col("from_place"))
    best = before.groupBy("user_pseudo_id").agg(F.max("last_source").alias("s"), F.max("last_medium").alias("m"))
    text = F.lit(None).cast("string")
    parts = [
        best.where(F.col(column).isNotNull()).select(
            "user_pseudo_id",
            *[F.col(f"{column}.place.{name}").alias(name) for name in PATH_ORDER],
            *[(F.col(f"{column}.{name}") if name == own else text).alias(name) for name in ("session_first_source", "session_first_medium")],
        )
        for column, own in (("s", "session_first_source"), ("m", "session_first_medium"))
    ]
    return parts[0].unionByName(parts[1])


def resumed_paths(pre: DataFrame, openings: DataFrame, changes: DataFrame, **carry: int) -> DataFrame:
    """``sessions`` from the first change of each changed path on, with ``session_day``.

    ``pre`` has all sessions of these paths on the days that reach past their change, and is a stored table.
    """
    concerned = with_change(pre, changes, ["ga_session_id", "session_start_timestamp"]).where(F.col("from_place").isNotNull())
    opened = openings.withColumn("from_place", F.lit(None).cast(concerned.schema["from_place"].dataType))
    rows = concerned.drop("session_last_medium").unionByName(opened, allowMissingColumns=True)
    walked = carry_forward(stored(rows, "paths-resumed"), "user_pseudo_id", PATH_ORDER, non_direct(), **carry).withColumns(or_direct())
    return walked.where(_place() >= F.col("from_place")).select(*columns("sessions"), "session_day")

