"""Raw log to flat events. One projection over one scan, no shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.functions import event_id, event_param, farm_event_id, fingerprint_event_id, session_key, traffic
from clickpath.schema import columns
from clickpath.sources.exports import RAW_DATE

# Parameter keys read, with the value subfield that holds each.
SESSION_PARAM = ("ga_session_id", "int_value")
URL_PARAM = ("page_location", "string_value")
TRAFFIC_PARAMS = {
    "campaign": ("campaign", "string_value"),
    "source": ("source", "string_value"),
    "medium": ("medium", "string_value"),
}

_EVENT_IDS = {"bundle": event_id, "fingerprint": fingerprint_event_id, "farm": farm_event_id}
_DATES = {"strict": F.to_date, "lenient": F.try_to_date}


def event_params_lookup(raw: DataFrame, on_duplicate: str = "first") -> DataFrame:
    """The raw log with the five parameters the models use as columns of their own."""

    def param(key: str, field: str) -> Column:
        return event_param(key, field, on_duplicate=on_duplicate)

    return raw.withColumns(
        {
            "ga_session_id": param(*SESSION_PARAM),
            "page_location": param(*URL_PARAM),
            **{f"param_{name}": param(*source) for name, source in TRAFFIC_PARAMS.items()},
        }
    )


def traffic_cascade(looked_up: DataFrame) -> DataFrame:
    """Adds the resolved source, medium and campaign to looked-up events."""
    return looked_up.withColumns(
        {
            f"fixed_traffic_{name}": traffic(name, F.col("page_location"), F.col(f"param_{name}"))
            for name in TRAFFIC_PARAMS
        }
    )


def pre_events(
    raw: DataFrame,
    event_id: str = "bundle",
    on_duplicate: str = "first",
    dates: str = "strict",
) -> DataFrame:
    """Flat events of a whole raw log.

    ``event_id``: ``"bundle"`` ends in bundle sequence and server offset,
    ``"fingerprint"`` in a hash of the parameters, ``"farm"`` in the public FarmHash
    fingerprint of their JSON text. ``dates="lenient"`` turns an
    unreadable date into NULL instead of failing.
    """
    resolved = traffic_cascade(event_params_lookup(raw, on_duplicate))
    return resolved.withColumns(
        {
            "event_id": _EVENT_IDS[event_id](),
            "event_date": _DATES[dates]("event_date", "yyyyMMdd"),
            "session_key": session_key(F.col("ga_session_id")),
        }
    ).select(*columns("pre_events"))


def since(raw: DataFrame, first_day: dt.date, dates: str = "strict") -> DataFrame:
    """Raw events of ``first_day`` and later, and with lenient dates all events without a readable one.

    Strict dates are compared as text, the form the raw partitions carry, so whole days are
    skipped. Undated events belong to no day, so every load reads them again.
    """
    if dates == "lenient":
        day = F.try_to_date("event_date", "yyyyMMdd")
        return raw.where(F.coalesce(day >= F.lit(first_day), F.lit(True)))
    return raw.where(F.col("event_date") >= first_day.strftime(RAW_DATE))


def pre_events_since(raw: DataFrame, first_day: dt.date, **options: str) -> DataFrame:
    """Flat events of ``first_day`` and later, and the undated ones."""
    return pre_events(since(raw, first_day, options.get("dates", "strict")), **options)


def pre_events_recent(raw: DataFrame, as_of: dt.date, lookback_days: int = 3, **options: str) -> DataFrame:
    """Flat events of the reload window, and the undated ones."""
    return pre_events_since(raw, as_of - dt.timedelta(lookback_days), **options)


def reloaded(first_day: dt.date) -> Column:
    """Whether a load from ``first_day`` on reads a flat event again; never NULL."""
    return F.coalesce(F.col("event_date") >= F.lit(first_day), F.lit(True))


def pre_events_day(raw: DataFrame, as_of: dt.date, days_back: int = 7, **options: str) -> DataFrame:
    """Flat events of the single day ``days_back`` days before ``as_of``."""
    day = (as_of - dt.timedelta(days_back)).strftime(RAW_DATE)
    return pre_events(raw.where(F.col("event_date") == day), **options)
