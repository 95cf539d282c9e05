"""Documents dealt into chunks that ask questions about their hashes and get answers back.

A chunk is a set of documents that one task reads. It sends each distinct hash once, packed by bucket
(a range of hash values), so a word or passage that fills the corpus counts once per chunk. A bucket
gathers what the chunks sent, and its answers meet the documents again in a join on the chunk. Both uses
of the documents read the same exchange. Sizes of chunks and buckets follow the number of scan tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

# The chunk of a document in the exchanged table.
CHUNK = "chunk"
SENT = "chunk int, bucket int, payload binary"


def chunk_count(docs: DataFrame) -> int:
    """As many chunks as tasks read or shuffle the table, whichever is more."""
    return max(docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(docs: DataFrame, chunks: int) -> DataFrame:
    return docs.repartition(chunks, CHUNK)


def bucket_edges(buckets: int) -> np.ndarray:
    """First hash of each bucket but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)


def bucket_slices(ordered: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Where each bucket with values lies in an ordered array of hashes."""
    cuts = np.concatenate([[0], np.searchsorted(ordered, bucket_edges(buckets)), [len(ordered)]])
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(int(cuts[b]), int(cuts[b + 1]))


def sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, bucket, payload = zip(*rows)
    return pa.record_batch([pa.array(chunk, pa.int32()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
                           names=["chunk", "bucket", "payload"])


def hash_chunks(docs: DataFrame, chunks: int) -> DataFrame:
    """Documents dealt evenly, also where many have no id or the same one."""
    return docs.withColumn(CHUNK, F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))


def range_chunks(docs: DataFrame, chunks: int) -> DataFrame:
    """Documents dealt by ranges of doc_id: a smaller id never lies in a later chunk. Null comes first.

    The edges (one id per chunk) come from a range exchange of the ids alone.
    """
    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    heads = (
        ids.repartitionByRange(chunks, "doc_id")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("doc_id").alias("head"))
        .collect()
    )
    edges = np.array(sorted(row["head"] for row in heads)[1:], dtype=np.int64)

    @F.pandas_udf("int")
    def chunk_of(ids):
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right"))

    lowest = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    return docs.withColumn(CHUNK, chunk_of(lowest))


def texts_of(table: pa.Table) -> pa.Array:
    return W.as_binary(table.column("text"))
