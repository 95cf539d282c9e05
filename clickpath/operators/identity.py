"""Cookie to login id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions import earliest
from clickpath.schema import columns


def unified_id(events: DataFrame, as_of: dt.date | None = None, lookback_days: int = 30) -> DataFrame:
    """The login id seen first for each cookie, over all events or the days before ``as_of``.

    Cookies of one login are not merged; events without a cookie share one row.
    """
    if as_of is not None:
        events = events.where(F.col("event_date") >= F.lit(as_of - dt.timedelta(lookback_days)))
    first_login = earliest(F.col("user_id"), "event_timestamp", "user_id").alias("resolved_user_id")
    logged_in = events.where(F.col("user_id").isNotNull())
    return logged_in.groupBy("user_pseudo_id").agg(first_login).select(*columns("unified_id"))
