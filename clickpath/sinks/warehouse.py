"""Where the tables are kept, and how a load makes them visible.

Every write goes to a folder of its own below its table. A version, one small file written at the end of a
load, names the folders that make up each table. Until then readers see the tables of the load before,
and a load that breaks off leaves nothing but folders that the next one removes.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickpath.schema import DESCRIPTIONS, STATE_TABLES, TABLES, columns
from clickpath.storage import folder_names, read_text, remove_folder, write_text_at_once

# Day a session was first stored under. It never changes afterwards, so a session that is
# rebuilt goes back into the partition it came from.
SESSION_DAY = "session_day"

# Partition column of the tables that a daily load changes by day. The others have one row per cookie, or
# one weight per session that changes with every new session of its cookie, and are replaced whole.
PARTITIONED_BY = {
    "pre_events": "event_date",
    "pre_sessions": SESSION_DAY,
    "sessions": SESSION_DAY,
    "transactions": "event_date",
    "products": "event_date",
    "session_days": "event_date",
    "identity_days": "event_date",
    "path_days": SESSION_DAY,
    "purchase_days": "event_date",
}

# Tables whose rows come to the write in pieces too small for files of their own: those
# of every day from every task. Adaptive execution joins them to even sizes, by the
# given column, and splits what is too large.
REBALANCED_BY: dict[str, list[str]] = {name: [day] for name, day in PARTITIONED_BY.items() if name != "pre_events"}

# Column to order rows by inside the files of a partition. The write sorts by partition
# column anyway; one more column costs little and lets a filter on it skip row groups.
CLUSTERED_BY = {"pre_events": "event_name"}

# Versions that stay readable after a load, the new one included.
KEPT_VERSIONS = 2

# Partition column of the folder that one write has made.
_LOAD = "load"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# For each table the folder of each of its partitions; of an unpartitioned one that of "".
Places = dict[str, dict[str, str]]


def stored_schema(table: str) -> T.StructType:
    schema = TABLES.get(table) or STATE_TABLES[table]
    if PARTITIONED_BY.get(table) == SESSION_DAY and SESSION_DAY not in schema.fieldNames():
        return T.StructType([*schema.fields, T.StructField(SESSION_DAY, T.DateType())])
    return schema


def table_columns(table: str) -> list[str]:
    return columns(table) if table in TABLES else STATE_TABLES[table].fieldNames()


def _day_name(day: dt.date | None) -> str:
    return _NO_DAY if day is None else day.isoformat()


def _live(table: str, places: dict[str, str]) -> str:
    """Which partitions belong to a version: a condition on partition columns alone, in SQL as there can be thousands of days."""
    by_load: dict[str, list[str]] = {}
    for day, folder in places.items():
        by_load.setdefault(folder, []).append(day)
    column, tests = f"CAST(`{PARTITIONED_BY[table]}` AS DATE)", []
    for folder, days in by_load.items():
        dates = ", ".join(f"DATE'{day}'" for day in days if day != _NO_DAY)
        own = [f"{column} IN ({dates})"] * bool(dates) + [f"{column} IS NULL"] * (_NO_DAY in days)
        tests.append(f"(`{_LOAD}` = '{folder}' AND ({' OR '.join(own)}))")
    return " OR ".join(tests)


class Snapshot:
    """The tables of one version; its data frames stay the same whatever is loaded later."""

    def __init__(self, warehouse: Warehouse, places: Places, state: dict | None, version: int = 0):
        self.warehouse, self.places, self.state, self.version = warehouse, places, state, version

    def exists(self, table: str) -> bool:
        return table in self.places

    def days(self, table: str) -> set[dt.date | None]:
        return {None if day == _NO_DAY else dt.date.fromisoformat(day) for day in self.places[table]}

    def read_stored(self, table: str) -> DataFrame:
        """The table with its storage columns."""
        spark, path, schema = self.warehouse.spark, self.warehouse.path(table), stored_schema(table)
        if table not in self.places:
            raise LookupError(f"no finished load has written {table}")
        places = self.places[table]
        if not places:
            return spark.createDataFrame([], schema)
        loads = sorted(set(places.values()))
        folders = [f"{path}/{_LOAD}={load}" for load in loads]
        if table not in PARTITIONED_BY:
            return spark.read.schema(schema).parquet(*folders)
        whole = T.StructType([*schema.fields, T.StructField(_LOAD, T.StringType())])
        rows = spark.read.schema(whole).option("basePath", path).parquet(*folders)
        return rows.where(_live(table, places)).select(*schema.fieldNames())

    def read(self, table: str) -> DataFrame:
        return self.read_stored(table).select(*table_columns(table))


class Load(Snapshot):
    """Tables that are being written; what has not been written yet is read from the version before."""

    def __init__(self, warehouse: Warehouse, base: Snapshot | None):
        places = {name: dict(days) for name, days in base.places.items()} if base else {}
        super().__init__(warehouse, places, None, base.version + 1 if base else 1)

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        """Write ``rows`` as the whole table and return it as read back."""
        self.places[table] = self._write(table, rows)
        return self.read(table)

    def replace_days(self, table: str, rows: DataFrame, emptied: Iterable[dt.date | None] = ()) -> DataFrame:
        """Write ``rows`` in place of the partitions that they have rows for, and drop those of ``emptied``; the others stay."""
        if table not in PARTITIONED_BY:
            raise ValueError(f"{table} is not partitioned")
        gone = {_day_name(day) for day in emptied}
        kept = {day: load for day, load in self.places.get(table, {}).items() if day not in gone}
        self.places[table] = kept | self._write(table, rows)
        return self.read(table)

    def _write(self, table: str, rows: DataFrame) -> dict[str, str]:
        spark, partition, load = self.warehouse.spark, PARTITIONED_BY.get(table), f"v{uuid.uuid4().hex}"
        rows = rows.select(*stored_schema(table).fieldNames())
        if table in REBALANCED_BY:
            rows = rows.hint("rebalance", *REBALANCED_BY[table])
        if table in CLUSTERED_BY:
            rows = rows.sortWithinPartitions(partition, CLUSTERED_BY[table])
        folder = f"{self.warehouse.path(table)}/{_LOAD}={load}"
        writer = rows.write.partitionBy(partition) if partition else rows.write
        writer.parquet(folder)
        if not partition:
            return {"": load}
        head = f"{partition}="
        return {name.removeprefix(head): load for name in folder_names(spark, folder) if name.startswith(head)}


class Warehouse:
    """Parquet tables under ``<root>/<database>``, on request also listed in the catalog."""

    def __init__(
        self, spark: SparkSession, root: str, database: str = "clickpath", register: bool = False, work: str | None = None
    ):
        self.spark = spark
        self.work = work
        self.database = database
        self.root = f"{root.rstrip('/')}/{database}"
        self.register = register

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def work_dir(self) -> str:
        """Where a load keeps its intermediate tables if the session names no place."""
        return self.work or f"{self.root}/_work"

    def _version_path(self, version: int) -> str:
        return f"{self.root}/published/{version:09d}"

    def versions(self) -> list[int]:
        """Versions that can be read, the newest last."""
        return [int(name) for name in folder_names(self.spark, f"{self.root}/published") if name.isdigit()]

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The tables of a version, the newest by default; None before the first load has ended."""
        if version is None:
            found = self.versions()
            if not found:
                return None
            version = found[-1]
        written = json.loads(read_text(self.spark, self._version_path(version)))
        return Snapshot(self, written["tables"], written["state"], version)

    def _newest(self) -> Snapshot:
        return self.snapshot() or Snapshot(self, {}, None)

    def exists(self, table: str) -> bool:
        return self._newest().exists(table)

    def read_stored(self, table: str) -> DataFrame:
        """The newest version of the table, with its storage columns."""
        return self._newest().read_stored(table)

    def read(self, table: str) -> DataFrame:
        return self._newest().read(table)

    def state(self) -> dict | None:
        """What the last load that ran to its end has recorded; None if there is no such load."""
        return self._newest().state

    @contextmanager
    def loading(self) -> Iterator[Load]:
        """Tables to write; they become the newest version at the end, if ``load.state`` was set."""
        load = Load(self, self.snapshot())
        yield load
        if load.state is None:
            raise RuntimeError("a load ends by setting its state")
        write_text_at_once(
            self.spark, self._version_path(load.version), json.dumps({"state": load.state, "tables": load.places}, sort_keys=True)
        )
        if self.register:
            self._list_in_catalog(load)
        self._remove_unused()

    def _remove_unused(self) -> None:
        """Old versions, and the folders that no version left needs."""
        versions = self.versions()
        for version in versions[:-KEPT_VERSIONS]:
            remove_folder(self.spark, self._version_path(version))
        kept = [self.snapshot(version).places for version in versions[-KEPT_VERSIONS:]]
        for table in [*TABLES, *STATE_TABLES]:
            used = {(load, day) for places in kept for day, load in places.get(table, {}).items()}
            for name in folder_names(self.spark, self.path(table)):
                load = name.removeprefix(f"{_LOAD}=")
                if load not in {x for x, _ in used}:
                    remove_folder(self.spark, f"{self.path(table)}/{name}")
                    continue
                for part in folder_names(self.spark, f"{self.path(table)}/{name}") if table in PARTITIONED_BY else ():
                    column, is_day, day = part.partition("=")
                    if is_day and column == PARTITIONED_BY[table] and (load, day) not in used:
                        remove_folder(self.spark, f"{self.path(table)}/{name}/{part}")

    def _list_in_catalog(self, load: Load) -> None:
        """One view per table, on the folders of this version."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, schema in TABLES.items():
            name = f"`{self.database}`.`{table}`"
            fields = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
            if load.places[table]:
                source = f"parquet.`{self.path(table)}`" if table in PARTITIONED_BY else f"parquet.`{self.path(table)}/{_LOAD}={load.places[table]['']}`"
                query = f"SELECT {fields} FROM {source}" + (f" WHERE {_live(table, load.places[table])}" if table in PARTITIONED_BY else "")
            else:
                empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
                query = f"SELECT {empty} WHERE false"
            if self.spark.catalog.tableExists(f"{self.database}.{table}") and self.spark.catalog.getTable(f"{self.database}.{table}").tableType != "VIEW":
                self.spark.sql(f"DROP TABLE {name}")
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{DESCRIPTIONS[table]}' AS {query}")
