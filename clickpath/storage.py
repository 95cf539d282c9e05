"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Session setting that names the folder of the load that is going on.
_RUN = "clickpath.run.dir"
# Spark's setting by which a query's shuffle files go at its end.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dir: str | None = None


def work_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder in local mode, where there is one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="clickpath-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, which every scheme that Spark reads has, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    if not fs.mkdirs(at):
        raise RuntimeError(f"cannot make the folder {path}")


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def copy_folder(spark: SparkSession, path: str, to: str) -> None:
    """A folder with all that lies in it, file by file; for small ones."""
    (fs, at), (to_fs, to_at) = _file_system(spark, path), _file_system(spark, to)
    to_fs.mkdirs(to_at.getParent())
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, to_fs, to_at, False, spark._jsc.hadoopConfiguration()):
        raise RuntimeError(f"cannot copy {path}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    fs, at = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_at_once(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is either there with all of its text or not at all."""
    fs, at = _file_system(spark, path)
    if fs.exists(at):
        raise RuntimeError(f"{path} has been written meanwhile")
    staged = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(staged, at):
        raise RuntimeError(f"cannot write {path}")


def at_the_same_time(*jobs: Callable[[], T]) -> list[T]:
    """Results of jobs that do not depend on each other, which Spark may run side by side."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [found.result() for found in [pool.submit(job) for job in jobs]]


@contextmanager
def working_under(spark: SparkSession, default: str) -> Iterator[str]:
    """One folder for all intermediate tables of a load: made before anything else, removed at the end.

    It lies in ``spark.checkpoint.dir`` where that is set and under ``default`` otherwise.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or default).rstrip("/")
    run = f"{base}/clickpath/run-{uuid.uuid4().hex}"
    make_folder(spark, run)
    outer = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, run)
    try:
        yield run
    finally:
        spark.conf.set(_RUN, outer) if outer else spark.conf.unset(_RUN)
        remove_folder(spark, run)


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that end meanwhile go at once, not when the driver next collects its garbage."""
    outer = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, outer) if outer else spark.conf.unset(_RELEASE)


def stored(df: DataFrame, label: str, release: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder and return the written table.

    Every later use reads the same rows, whatever executors are lost in between. With ``release`` the shuffles
    behind them are removed as soon as the rows are written; ``df`` must not rest on a cached table then. ``options``
    are those of the Parquet writer.
    """
    spark = df.sparkSession
    folder = spark.conf.get(_RUN, None) or f"{work_dir(spark)}/clickpath"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    with _shuffles_released(spark) if release else nullcontext():
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
