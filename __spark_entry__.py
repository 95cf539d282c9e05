"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import clickpath as cp  # noqa: E402
from checks.oracle import ORACLE  # noqa: E402
from clickpath.functions import params_json  # noqa: E402
from clickpath.operators import partials  # noqa: E402
from clickpath.sources import sample_events  # noqa: E402
from clickpath.storage import copy_folder, stored, work_dir  # noqa: E402

# The training-data package and its pipeline can be left out of an installation.
try:
    import corpus_pipeline
    from clickpath.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "clickpath.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The given events end on 2024-01-30. From this day the reload window starts inside a
# session, and from the second one the 30-day identity window inside the data.
AS_OF = dt.date(2024, 1, 31)
IDENTITY_AS_OF = dt.date(2024, 2, 15)

# State of the tables before the incremental load: all days before this one.
LOADED_UNTIL = dt.date(2024, 1, 30)


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/clickpath/{label}-{uuid.uuid4().hex}"


_raw_logs: dict[tuple[str, str], str] = {}


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log of a folder, derived once from its events table and kept as an export is: by day."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    place = (work_dir(spark), sf_dir)
    if place in _raw_logs:
        try:
            return cp.read_events(spark, _raw_logs[place])
        except AnalysisException:
            # the scratch folder was emptied in between
            del _raw_logs[place]
    path = _scratch(spark, "raw")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # the table is one small file; spread it before the nested records are built
    sample_events(events.repartition(F.to_date("ts"))).write.partitionBy("event_date").parquet(path)
    _raw_logs[place] = path
    return cp.read_events(spark, path)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.pre_events(_raw(spark, sf_dir))


def _before(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("event_date") < LOADED_UNTIL.strftime("%Y%m%d"))


def _unnested(events: DataFrame) -> DataFrame:
    """Nested columns as scalars, in a form that compares across engines."""
    return events.select(
        *[name for name in events.columns if name not in ("ecommerce", "items")],
        "ecommerce.*",
        F.size("items").cast("bigint").alias("items"),
    )


def _sessions(events: DataFrame, grain: str = "session", **options: int) -> DataFrame:
    pre = stored(cp.pre_sessions(events, grain), "pre-sessions")
    return cp.sessions(pre, grain, **options)


def event_params_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.event_params_lookup(_raw(spark, sf_dir)).select(
        "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id", "page_location",
        "param_campaign", "param_source", "param_medium",
    )


def traffic_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.traffic_cascade(cp.event_params_lookup(_raw(spark, sf_dir))).select(
        "event_timestamp", "user_pseudo_id", "fixed_traffic_source", "fixed_traffic_medium", "fixed_traffic_campaign"
    )


def pre_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unnested(_events(spark, sf_dir))


def pre_events_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return _unnested(cp.pre_events_incremental(raw, cp.pre_events(_before(raw)), AS_OF))


def pre_events_incremental_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return _unnested(cp.pre_events_incremental(raw, cp.pre_events(_before(raw)), AS_OF, match="event_id"))


def pre_events_single_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unnested(cp.pre_events_day(_raw(spark, sf_dir), AS_OF))


def pre_events_fingerprint_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash differs between engines, so ids are compared by how many there are."""
    events = cp.pre_events(_raw(spark, sf_dir), event_id="fingerprint")
    return events.groupBy("event_date", "event_name").agg(
        F.count("*").alias("events"),
        F.count_distinct("event_id").alias("event_ids"),
        F.count_if(F.col("event_id").isNull()).alias("without_id"),
    )


def event_params_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that the fingerprint is taken of."""
    raw = _raw(spark, sf_dir)
    return raw.select("event_timestamp", "event_name", "user_pseudo_id", params_json().alias("params_json"))


def pre_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.pre_sessions(_events(spark, sf_dir))


def pre_sessions_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions put together from their partial results of each day."""
    return partials.merged_sessions(stored(partials.session_days(_events(spark, sf_dir)), "session-days"))


def unified_id_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.merged_identities(stored(partials.identity_days(_events(spark, sf_dir)), "identity-days"))


def pre_sessions_event_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.pre_sessions(_events(spark, sf_dir), "event")


def pre_sessions_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    existing = stored(cp.pre_sessions(cp.pre_events(_before(raw))), "sessions-before")
    return cp.pre_sessions_incremental(cp.pre_events(raw), existing, AS_OF)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(_events(spark, sf_dir))


def sessions_event_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(_events(spark, sf_dir), "event")


def sessions_long_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path with more than five sessions takes the way of the very long ones."""
    return _sessions(_events(spark, sf_dir), split_above=5, block_rows=1000)


def unified_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.unified_id(_events(spark, sf_dir))


def unified_id_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.unified_id(_events(spark, sf_dir), as_of=IDENTITY_AS_OF)


def attribution_first_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.first_click(sessions(spark, sf_dir))


def attribution_last_non_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.last_non_direct(sessions(spark, sf_dir))


def attribution_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.linear(stored(sessions(spark, sf_dir), "sessions"))


def attribution_linear_event_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.linear(stored(sessions_event_grain(spark, sf_dir), "sessions"))


def attribution_linear_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.linear_by_source(attribution_linear(spark, sf_dir))


def attribution_first_click_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.first_click_from_pre(pre_sessions(spark, sf_dir))


def attribution_last_non_direct_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.last_non_direct_from_pre(pre_sessions(spark, sf_dir))


def report_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    attribution = cp.last_non_direct_from_pre(cp.pre_sessions(events))
    return cp.transactions(events, attribution, cp.unified_id(events))


def report_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cp.products(events, cp.last_non_direct_from_pre(cp.pre_sessions(events)))


def report_transactions_session_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cp.transactions_session_scope(events, _sessions(events), cp.unified_id(events))


def report_products_session_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cp.products_session_scope(events, _sessions(events))


def report_transactions_linear_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cp.transactions_split(events, cp.linear(_sessions(events)), cp.unified_id(events))


def raw_day_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as one folder per day, read back through the wildcard."""
    root = _scratch(spark, "shards")
    raw = _raw(spark, sf_dir)
    raw.withColumn("day", F.col("event_date")).write.partitionBy("day").parquet(root)
    shards = cp.read_shards(spark, root, prefix="day=")
    return shards.groupBy("event_date", "event_name").agg(
        F.count("*").alias("events"),
        F.count("user_pseudo_id").alias("with_cookie"),
        F.min("event_timestamp").alias("first_timestamp"),
        F.max("event_timestamp").alias("last_timestamp"),
    )


def raw_flat_collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the collected campaign not nested, read into the nested form."""
    root = _scratch(spark, "flat-collected")
    campaign = F.col("collected_traffic_source.manual_campaign")
    flat = F.struct(
        campaign["source"].alias("manual_source"),
        campaign["medium"].alias("manual_medium"),
        campaign["campaign_name"].alias("manual_campaign_name"),
    )
    raw = _raw(spark, sf_dir)
    raw.withColumn(
        "collected_traffic_source", F.when(F.col("collected_traffic_source").isNotNull(), flat)
    ).write.partitionBy("event_date").parquet(root)
    return cp.read_events(spark, root, collected="flat").select(
        "event_timestamp",
        "collected_traffic_source.manual_campaign.*",
        F.col("collected_traffic_source").isNull().alias("no_record"),
    )


def raw_day_shards_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log row by row."""
    root = _scratch(spark, "shards")
    _raw(spark, sf_dir).withColumn("day", F.col("event_date")).write.partitionBy("day").parquet(root)
    return cp.read_shards(spark, root, prefix="day=").select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id",
        "event_bundle_sequence_id", "event_server_timestamp_offset",
        F.size("event_params").cast("bigint").alias("params"), F.size("items").cast("bigint").alias("items"),
        "ecommerce.transaction_id",
    )


def pre_events_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested items, one row each."""
    return _events(spark, sf_dir).select(
        "event_timestamp", "event_name", "user_pseudo_id", F.posexplode("items").alias("pos", "item")
    ).select("event_timestamp", "event_name", "user_pseudo_id", F.col("pos").cast("bigint").alias("pos"), "item.*")


def pre_events_fingerprint_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns; of the id what comes before the hash, which differs between engines."""
    events = _unnested(cp.pre_events(_raw(spark, sf_dir), event_id="fingerprint"))
    start = F.concat("user_pseudo_id", F.col("event_timestamp").cast("string"), "event_name")
    hashed = F.when(F.col("event_id").startswith(start), F.substring(F.col("event_id"), F.lit(1), F.length(start)))
    return events.withColumn("id_start", hashed).drop("event_id")


def pre_events_incremental_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh event has no readable date."""
    bad = F.when(F.col("event_bundle_sequence_id") % 11 == 0, F.concat(F.lit("d"), "event_date"))
    raw = _raw(spark, sf_dir)
    undated = raw.withColumn("event_date", F.coalesce(bad, F.col("event_date")))
    before = _before(raw).withColumn("event_date", F.coalesce(bad, F.col("event_date")))
    existing = stored(cp.pre_events(before, dates="lenient"), "events-before")
    return _unnested(cp.pre_events_incremental(undated, existing, AS_OF, dates="lenient"))


def _removed(raw: DataFrame) -> DataFrame:
    """The log after every fifth event of the reload window has gone."""
    return raw.where((F.col("event_bundle_sequence_id") % 5 != 0) | (F.col("event_date") < "20240128"))


def pre_sessions_incremental_after_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    before = cp.pre_events(_before(raw))
    existing = stored(cp.pre_sessions(before), "sessions-before")
    return cp.pre_sessions_incremental(cp.pre_events(_removed(raw)), existing, AS_OF, before=before)


def report_products_linear_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cp.products_split(events, cp.linear(_sessions(events)))


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables written, each from the stored ones before it."""
    warehouse = cp.Warehouse(spark, _scratch(spark, "full"))
    return cp.full_refresh(_raw(spark, sf_dir), warehouse).read("transactions")


def full_refresh_session_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = cp.Warehouse(spark, _scratch(spark, "full"))
    return cp.full_refresh(_raw(spark, sf_dir), warehouse, scope="session").read("transactions")


_loaded: dict[tuple[str, str], str] = {}


def prepared_tables(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the tables of the days before the last ones, built once; nothing is loaded into it."""
    place = (work_dir(spark), sf_dir)
    if place not in _loaded or cp.Warehouse(spark, _loaded[place]).state() is None:
        root = _scratch(spark, "prepared")
        cp.full_refresh(_before(_raw(spark, sf_dir)), cp.Warehouse(spark, root))
        _loaded[place] = root
    return _loaded[place]


def _loaded_before(spark: SparkSession, sf_dir: str) -> cp.Warehouse:
    """A copy of the prepared tables, so that every query has the new days to load."""
    root = _scratch(spark, "daily")
    copy_folder(spark, prepared_tables(spark, sf_dir), root)
    return cp.Warehouse(spark, root)


def _loaded_daily(spark: SparkSession, sf_dir: str) -> cp.Warehouse:
    return cp.daily_refresh(_raw(spark, sf_dir), _loaded_before(spark, sf_dir), AS_OF)


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_daily(spark, sf_dir).read("transactions")


def daily_refresh_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_daily(spark, sf_dir).read("sessions")


def _after_daily(name: str, table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A table as the daily load leaves it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _loaded_daily(spark, sf_dir).read(table)
        return _unnested(rows) if table == "pre_events" else rows

    query.__name__ = name
    return query


def _changed_daily(spark: SparkSession, sf_dir: str, until: str, raw: DataFrame) -> DataFrame:
    warehouse = cp.Warehouse(spark, _scratch(spark, "daily"))
    cp.full_refresh(_raw(spark, sf_dir).where(F.col("event_date") < until), warehouse)
    return cp.daily_refresh(raw, warehouse, AS_OF).read("sessions")


def daily_refresh_after_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the window are gone since the last load, some sessions with them."""
    return _changed_daily(spark, sf_dir, "20240201", _removed(_raw(spark, sf_dir)))


def daily_refresh_transactions_after_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of the days that the removal changes, beside those that stay as they were."""
    warehouse = cp.Warehouse(spark, _scratch(spark, "daily"))
    cp.full_refresh(_raw(spark, sf_dir).where(F.col("event_date") < "20240201"), warehouse)
    return cp.daily_refresh(_removed(_raw(spark, sf_dir)), warehouse, AS_OF).read("transactions")


def daily_refresh_session_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = cp.Warehouse(spark, _scratch(spark, "daily"))
    cp.full_refresh(_before(_raw(spark, sf_dir)), warehouse, scope="session")
    return cp.daily_refresh(_raw(spark, sf_dir), warehouse, AS_OF, scope="session").read("transactions")


def daily_refresh_restated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day 20 days before the load was first delivered without every fifth event; only its files tell."""
    root, raw = _scratch(spark, "restated"), _raw(spark, sf_dir)
    restated = (AS_OF - dt.timedelta(20)).strftime("%Y%m%d")
    partial = raw.where((F.col("event_date") != restated) | (F.col("event_bundle_sequence_id") % 5 != 0))
    partial.write.partitionBy("event_date").parquet(root)

    def files() -> dict[str, str]:
        return cp.source_log(cp.source_files(spark, root))

    warehouse = cp.full_refresh(cp.read_events(spark, root), cp.Warehouse(spark, _scratch(spark, "daily")), source=files())
    raw.where(F.col("event_date") == restated).drop("event_date").write.mode("overwrite").parquet(f"{root}/event_date={restated}")
    return cp.daily_refresh(cp.read_events(spark, root), warehouse, AS_OF, source=files()).read("sessions")


def audit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table with a declared key, and how often keys are missing or repeated; every fifth event is there twice."""
    raw = _raw(spark, sf_dir)
    twice = raw.unionByName(raw.where(F.col("event_bundle_sequence_id") % 5 == 0))
    warehouse = cp.full_refresh(twice, cp.Warehouse(spark, _scratch(spark, "audit")))
    return cp.violations(warehouse.snapshot())


def daily_refresh_after_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last load is older than the window."""
    return _changed_daily(spark, sf_dir, "20240120", _raw(spark, sf_dir))


_QUERIES = [
    event_params_lookup,
    traffic_cascade,
    pre_events,
    pre_events_incremental,
    pre_events_incremental_by_id,
    pre_events_single_day,
    pre_events_fingerprint_id,
    event_params_json,
    pre_sessions_event_grain,
    pre_sessions,
    pre_sessions_incremental,
    sessions_event_grain,
    sessions,
    sessions_long_paths,
    unified_id,
    unified_id_lookback,
    attribution_first_click,
    attribution_last_non_direct,
    attribution_first_click_direct,
    attribution_last_non_direct_direct,
    attribution_linear,
    attribution_linear_event_grain,
    attribution_linear_by_source,
    report_transactions,
    report_products,
    report_transactions_session_scope,
    report_products_session_scope,
    report_transactions_linear_split,
    raw_day_shards,
    raw_flat_collected,
    full_refresh,
    daily_refresh,
    daily_refresh_sessions,
    _after_daily("daily_refresh_pre_events", "pre_events"),
    _after_daily("daily_refresh_pre_sessions", "pre_sessions"),
    _after_daily("daily_refresh_unified_id", "unified_id"),
    _after_daily("daily_refresh_first_click", "attribution_first_click"),
    _after_daily("daily_refresh_last_non_direct", "attribution_last_non_direct"),
    _after_daily("daily_refresh_linear", "attribution_linear"),
    _after_daily("daily_refresh_products", "products"),
    daily_refresh_after_removal,
    daily_refresh_after_gap,
    daily_refresh_transactions_after_removal,
    daily_refresh_session_scope,
    daily_refresh_restated_day,
    audit_violations,
    pre_sessions_from_days,
    unified_id_from_days,
    pre_sessions_incremental_after_removal,
    pre_events_incremental_lenient,
    pre_events_items,
    pre_events_fingerprint_rows,
    raw_day_shards_rows,
    full_refresh_session_scope,
    report_products_linear_split,
]


def entry(spark: SparkSession) -> DataFrame:
    """Raw events to attributed transactions."""
    return report_transactions(spark, SMOKE_DIR)


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries over the events, without those of the training-data package."""
    return {query.__name__: query for query in _QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = own_queries()
    if llm_queries:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE)
    if llm_queries:
        found |= llm_queries.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return found
