"""Declared keys of the tables, checked on what a load has written before it is published."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.sinks.warehouse import PARTITIONED_BY, Load, Snapshot

# The columns that tell the rows of a table apart at session grain. A session is told apart by its
# two parts, as the joined key can be the same for two cookies.
KEYS: dict[str, tuple[str, ...]] = {
    "pre_events": ("event_id",),
    "pre_sessions": ("user_pseudo_id", "ga_session_id"),
    "sessions": ("user_pseudo_id", "ga_session_id"),
    "unified_id": ("user_pseudo_id",),
    "attribution_first_click": ("user_pseudo_id",),
    "attribution_last_non_direct": ("user_pseudo_id",),
}


class KeyViolation(ValueError):
    """Rows that a load would publish repeat a declared key."""


def key_counts(rows: DataFrame, table: str) -> DataFrame:
    """One row: the table's name, its rows, those without a key, the keys that occur again, and the rows too many.

    A key is missing where all of its columns are; such rows do not count as repeated, but where a table has one row
    for all events without a cookie.
    """
    key = KEYS[table]
    missing = reduce(and_, [F.col(name).isNull() for name in key])
    again = (F.col("n") > 1) & (~F.col("missing") if table == "pre_events" else F.lit(True))
    counted = rows.groupBy(*key).agg(F.count("*").alias("n")).withColumn("missing", missing)
    return counted.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("missing"), F.col("n"))), F.lit(0)).alias("without_key"),
        F.count_if(again).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(again, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def violations(snapshot: Snapshot) -> DataFrame:
    """``key_counts`` of every table with a declared key; one row per table."""
    return reduce(DataFrame.unionByName, [key_counts(snapshot.read(table), table) for table in KEYS if snapshot.exists(table)])


def check_keys(load: Load, base: Snapshot | None) -> None:
    """Raise where a partition that the load has written repeats a key."""
    found = []
    for table in KEYS:
        if not load.exists(table):
            continue
        before = base.places.get(table, {}) if base else {}
        new = {day: folder for day, folder in load.places[table].items() if before.get(day) != folder}
        if table in PARTITIONED_BY and len(new) < len(load.places[table]):
            rows = Snapshot(load.warehouse, {table: new}, None).read(table)
        else:
            rows = load.read(table)
        if new:
            found.append(key_counts(rows, table))
    # one row per table
    bad = reduce(DataFrame.unionByName, found).where("repeated_keys > 0").collect() if found else []
    if bad:
        raise KeyViolation("; ".join(f"{r['table_name']}: {r['repeated_keys']} keys in {r['surplus_rows']} rows too many" for r in bad))
