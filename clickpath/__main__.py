"""Job that builds or refreshes the tables.

    spark-submit job.py full  --raw /exports/events --root /warehouse
    spark-submit job.py daily --raw /exports/events --root /warehouse --as-of 2024-01-31

``python -m clickpath`` takes the same arguments. Cluster and memory settings come from
spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from clickpath.plans import daily_refresh, full_refresh
from clickpath.plans.daily import first_day, today
from clickpath.plans.full import MODELS, SCOPES
from clickpath.session import build_session
from clickpath.sinks import Warehouse
from clickpath.sources import read_events, read_shards, read_table, source_files, source_log


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickpath", description="Build the event, session and report tables.")
    parser.add_argument("load", choices=["full", "daily"])
    parser.add_argument("--raw", required=True, help="raw event log: a folder or, with --layout table, a table name")
    parser.add_argument("--layout", choices=["partitions", "shards", "table"], default="partitions")
    parser.add_argument("--collected", choices=["nested", "flat"], default="nested")
    parser.add_argument("--root", required=True, help="folder the tables are kept under")
    parser.add_argument("--database", default="clickpath")
    parser.add_argument("--register", action="store_true", help="list the tables in the catalog")
    parser.add_argument("--event-id", choices=["bundle", "fingerprint", "farm"], default="bundle")
    parser.add_argument("--on-duplicate", choices=["first", "error"], default="first")
    parser.add_argument("--dates", choices=["strict", "lenient"], default="strict")
    parser.add_argument("--grain", choices=["session", "event"], default="session", help="full load only")
    parser.add_argument("--scope", choices=SCOPES, default="cookie", help="what the reports attribute by")
    parser.add_argument("--model", choices=MODELS, default="last_non_direct", help="attribution looked up at cookie scope")
    parser.add_argument("--identity-as-of", type=dt.date.fromisoformat, help="only logins of the 30 days before")
    parser.add_argument("--work-dir", help="shared folder for intermediate tables; below the tables by default")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="daily load only; today, UTC, by default")
    parser.add_argument("--lookback-days", type=int, default=3, help="daily load only")
    parser.add_argument("--find-restated", action="store_true", help="list the raw files, and load older days that have changed as well")
    parser.add_argument("--audit", action="store_true", help="refuse a load that repeats a declared key")
    arguments = parser.parse_args(given)
    if arguments.find_restated and arguments.layout == "table":
        parser.error("files are listed in folders only")
    if arguments.load == "daily" and arguments.grain == "event":
        parser.error("event grain can only be loaded in full")
    return arguments


def _raw(spark: SparkSession, arguments: argparse.Namespace, warehouse: Warehouse) -> DataFrame:
    readers = {"partitions": read_events, "shards": read_shards, "table": read_table}
    days = {}
    if arguments.layout == "shards" and arguments.load == "daily" and arguments.dates == "strict" and not arguments.find_restated:
        # the date is inside the files, so the days to open are chosen by folder; events without
        # a readable date can be in any
        as_of = arguments.as_of or today()
        since = first_day(warehouse, as_of, arguments.lookback_days)
        if since and since != dt.date.min:
            days["first"] = since
            days["last"] = max(as_of, today()) + dt.timedelta(1)
    return readers[arguments.layout](spark, arguments.raw, collected=arguments.collected, **days)


def main(given: list[str] | None = None) -> Warehouse:
    arguments = _arguments(given)
    spark = build_session()
    warehouse = Warehouse(spark, arguments.root, arguments.database, arguments.register, arguments.work_dir)
    # listed before the log is read, so that a file that comes in between is found the next time
    source = source_log(source_files(spark, arguments.raw, arguments.layout)) if arguments.find_restated else None
    raw = _raw(spark, arguments, warehouse)
    options = {"event_id": arguments.event_id, "on_duplicate": arguments.on_duplicate, "dates": arguments.dates}
    options |= {"scope": arguments.scope, "model": arguments.model, "identity_as_of": arguments.identity_as_of, "source": source, "audit": arguments.audit}
    if arguments.load == "full":
        return full_refresh(raw, warehouse, arguments.grain, **options)
    return daily_refresh(raw, warehouse, arguments.as_of, arguments.lookback_days, **options)


if __name__ == "__main__":
    main()
