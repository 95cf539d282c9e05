"""Weights for the sessions on each cookie's path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions import earliest, latest, nulls_last_key
from clickpath.operators.sessions import PATH_ORDER, non_direct, or_direct
from clickpath.operators.skew import lookup_join
from clickpath.schema import columns

_SESSION = ("session_key", "final_session_source", "final_session_medium")


def _single_touch(sessions: DataFrame, chosen: Column) -> DataFrame:
    return (
        sessions.groupBy("user_pseudo_id")
        .agg(chosen.alias("_session"))
        .select("user_pseudo_id", "_session.*", F.lit(1.0).alias("attribution_weight"))
    )


def first_click(sessions: DataFrame) -> DataFrame:
    """Weight 1 to the earliest session of each cookie."""
    return _single_touch(sessions, earliest(F.struct(*_SESSION), *PATH_ORDER))


def last_non_direct(sessions: DataFrame) -> DataFrame:
    """Weight 1 to the latest session of each cookie, whose source is already the carried one."""
    return _single_touch(sessions, latest(F.struct(*_SESSION), *PATH_ORDER))


def first_click_from_pre(pre: DataFrame) -> DataFrame:
    """``first_click`` without a session table: nothing is carried into the first session."""
    own = [value.alias(name) for name, value in non_direct().items()]
    return _single_touch(pre, earliest(F.struct("session_key", *own), *PATH_ORDER)).withColumns(or_direct())


def last_non_direct_from_pre(pre: DataFrame) -> DataFrame:
    """``last_non_direct`` without a session table, as one grouping with no window.

    What reaches the last session of a path is the last non-direct value anywhere on it.
    """
    on_path = nulls_last_key(*PATH_ORDER)
    return (
        pre.groupBy("user_pseudo_id")
        .agg(
            latest(F.col("session_key"), *PATH_ORDER).alias("session_key"),
            *[F.max_by(value, F.when(value.isNotNull(), on_path)).alias(name) for name, value in non_direct().items()],
        )
        .withColumns({**or_direct(), "attribution_weight": F.lit(1.0)})
        .select(*columns("attribution_last_non_direct"))
    )


def linear(sessions: DataFrame) -> DataFrame:
    """Weight 1/n to each of the n sessions of a cookie; NULL where no session has a key.

    The count is grouped, then looked up: a counting window would hold a whole path in
    one task.
    """
    counts = sessions.groupBy("user_pseudo_id").agg(F.count("session_key").alias("_sessions"))
    paths = sessions.select("user_pseudo_id", *_SESSION, "session_start_timestamp", "ga_session_id")
    spread_by = ["session_start_timestamp", "ga_session_id"]
    counted = lookup_join(paths, counts, "user_pseudo_id", spread_by, nulls_match=True)
    weight = F.try_divide(F.lit(1.0), F.col("_sessions"))
    return counted.withColumn("attribution_weight", weight).select(*columns("attribution_linear"))


def linear_by_source(linear: DataFrame) -> DataFrame:
    """Share of each source and medium in the sessions of a cookie.

    Counts divided once, so a share does not depend on the order weights are added in.
    """
    by_source = (
        linear.where(F.col("user_pseudo_id").isNotNull())
        .groupBy("user_pseudo_id", "final_session_source", "final_session_medium")
        .agg(F.count("session_key").alias("_of_source"))
    )
    # at most one row per source of a cookie
    total = F.sum("_of_source").over(Window.partitionBy("user_pseudo_id"))
    share = F.try_divide(F.col("_of_source").cast("double"), total)
    return by_source.select(
        "user_pseudo_id", "final_session_source", "final_session_medium", share.alias("attribution_weight")
    )
