"""All nine tables from a whole raw log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath import operators as ops
from clickpath.operators import partials
from clickpath.sinks import Load, Warehouse
from clickpath.sinks.audit import check_keys
from clickpath.sinks.warehouse import SESSION_DAY
from clickpath.storage import at_the_same_time, working_under

# What the reports attribute by: the session that the attribution table keeps of a cookie, the session
# that a purchase was made in, or all sources of the cookie by linear weight.
SCOPES = ("cookie", "session", "linear")
# Which session of a cookie the reports of cookie scope look up.
MODELS = ("last_non_direct", "first_click")

EVENT_OPTIONS = {"event_id": "bundle", "on_duplicate": "first", "dates": "strict"}

# The table that each model's report looks up.
TOUCH_TABLES = {"first_click": "attribution_first_click", "last_non_direct": "attribution_last_non_direct"}
_TOUCHES = {"attribution_first_click": ops.first_click, "attribution_last_non_direct": ops.last_non_direct}


def load_options(grain: str, event_options: dict[str, str]) -> dict[str, str]:
    """What the incremental tables depend on, defaults filled in."""
    return {"grain": grain, **EVENT_OPTIONS, **event_options}


def report_options(scope: str, model: str, identity_as_of: dt.date | None) -> dict[str, str | None]:
    """What the reports depend on besides."""
    return {"scope": scope, "model": model, "identity_as_of": identity_as_of and identity_as_of.isoformat()}


def newest_day(events: DataFrame) -> dt.date | None:
    return events.agg(F.max("event_date")).first()[0]


def as_state(options: dict, newest: dt.date | None) -> dict:
    return {**options, "newest_day": newest and newest.isoformat()}


def full_refresh(
    raw: DataFrame,
    warehouse: Warehouse,
    grain: str = "session",
    scope: str = "cookie",
    model: str = "last_non_direct",
    identity_as_of: dt.date | None = None,
    source: Mapping[str, str] | None = None,
    audit: bool = False,
    **event_options: str,
) -> Warehouse:
    """Build every table anew. Each one is written and read back, so none is computed twice.

    Readers keep the tables of the load before until all of them are written. ``source`` is a ``source_log`` of the
    raw log, listed before it is read, by which a daily load finds older days that have changed. With ``audit`` a
    load that repeats a declared key is refused (``sinks.audit``).
    """
    check_reports(scope, model)
    with working_under(warehouse.spark, warehouse.work_dir), warehouse.loading() as load:
        events = load.replace("pre_events", ops.pre_events(raw, **event_options))
        at_the_same_time(
            lambda: _build_paths(load, events, grain),
            lambda: _build_identities(load, events, identity_as_of),
            lambda: load.replace("purchase_days", partials.purchase_days(events)),
        )
        write_reports(load, reports(load, scope, model))
        options = load_options(grain, event_options) | {
            "reports": report_options(scope, model, identity_as_of), "source": source and dict(source)
        }
        if audit and grain == "session":
            check_keys(load, None)
        load.state = as_state(options, newest_day(events))
    return warehouse


def _build_paths(load: Load, events: DataFrame, grain: str) -> None:
    """Sessions, their paths and what is chosen from these."""
    if grain == "session":
        pre = partials.merged_sessions(load.replace("session_days", partials.session_days(events)))
    else:
        pre = ops.pre_sessions(events, grain)
    load.replace("pre_sessions", pre.withColumn(SESSION_DAY, start_day()))
    pre = load.read_stored("pre_sessions")
    sessions = load.replace("sessions", ops.sessions(pre, grain).withColumn(SESSION_DAY, start_day()))
    at_the_same_time(
        *[lambda name=name, touch=touch: load.replace(name, touch(sessions)) for name, touch in _TOUCHES.items()],
        lambda: load.replace("attribution_linear", ops.linear(sessions)),
        # for daily loads
        lambda: load.replace("path_days", partials.path_days(pre)),
    )


def _build_identities(load: Load, events: DataFrame, as_of: dt.date | None) -> None:
    load.replace("unified_id", identities(load.replace("identity_days", partials.identity_days(events)), as_of))


def write_reports(load: Load, found: dict[str, DataFrame], days: set[dt.date | None] | None = None) -> None:
    """Write the reports whole, or in place of the days that they are of."""

    def write(name: str, rows: DataFrame) -> None:
        load.replace(name, rows) if days is None else load.replace_days(name, rows, days)

    at_the_same_time(*[lambda name=name, rows=rows: write(name, rows) for name, rows in found.items()])


def check_reports(scope: str, model: str) -> None:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}, not {model!r}")


def identities(days: DataFrame, as_of: dt.date | None = None, lookback_days: int = 30) -> DataFrame:
    """``unified_id`` from its partials, of all days or those since ``lookback_days`` before ``as_of``."""
    if as_of is not None:
        days = days.where(F.col("event_date") >= F.lit(as_of - dt.timedelta(lookback_days)))
    return partials.merged_identities(days)


def reports(load: Load, scope: str, model: str, days: Column | None = None) -> dict[str, DataFrame]:
    """The two reports, of all purchases or of the days that ``days`` holds for."""
    events, ids = load.read("pre_events"), load.read("unified_id")
    if days is not None:
        events = events.where(days)
    if scope == "session":
        sessions = load.read("sessions")
        return {
            "transactions": ops.transactions_session_scope(events, sessions, ids),
            "products": ops.products_session_scope(events, sessions),
        }
    if scope == "linear":
        linear = load.read("attribution_linear")
        return {"transactions": ops.transactions_split(events, linear, ids), "products": ops.products_split(events, linear)}
    touched = load.read(TOUCH_TABLES[model])
    return {"transactions": ops.transactions(events, touched, ids), "products": ops.products(events, touched)}


def start_day() -> Column:
    """UTC day of the session start."""
    return F.date_from_unix_date(F.expr("session_start_timestamp div 86400000000").cast("int"))
