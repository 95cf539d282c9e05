"""Joins and running values that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions import nulls_last_key
from clickpath.storage import stored

# Ways a NULL key is spread over tasks when it has a partner row.
NULL_SPREAD = 64

# Rows of one cookie up to which its path is walked by a single task, and rows of a block
# that a longer path is cut into.
SPLIT_ABOVE = 1_000_000

# Short rows up to which a side whose row count is known is sent to every executor.
BROADCAST_ROWS = 100_000


def _scattered(key: Column, share: Column) -> Column:
    """``key`` as join text, with a share of the NULL rows under each value of ``share``."""
    return F.coalesce(F.concat(F.lit("="), key), F.concat(F.lit("!"), share.cast("string")))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    nulls_match: bool = False,
) -> DataFrame:
    """``rows`` left join ``lookup`` on the text column ``key``; ``lookup`` gives its other columns.

    Rows with a NULL key would all hash to one task. They get a key of their own, drawn
    from ``spread_by``, that no lookup row carries. With ``nulls_match`` the lookup row
    with the NULL key is repeated ``NULL_SPREAD`` times and meets each share of them.

    The derived key also puts an exchange right under each side of the join. That is the
    shape in which adaptive execution splits a partition that one large key fills; a
    lookup joined on the column it was grouped by would come without one.
    """
    values = [name for name in lookup.columns if name != key]
    share = F.xxhash64(*spread_by)
    if nulls_match:
        share = F.pmod(share, F.lit(NULL_SPREAD))
        shares = F.when(F.col(key).isNull(), F.sequence(F.lit(0), F.lit(NULL_SPREAD - 1)))
        lookup = lookup.withColumn("_share", F.explode(F.coalesce(shares, F.array(F.lit(0)))))
        partner = _scattered(F.col(key), F.col("_share"))
    else:
        lookup = lookup.where(F.col(key).isNotNull())
        partner = F.concat(F.lit("="), F.col(key))
    left = rows.withColumn("_key", _scattered(F.col(key), share))
    right = lookup.select(partner.alias("_key"), *values)
    return left.join(right, "_key", "left").drop("_key")


def without(rows: DataFrame, updates: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``rows`` whose ``key`` does not occur in ``updates``. A NULL key occurs nowhere."""
    left = rows.withColumn("_key", _scattered(F.col(key), F.xxhash64(*spread_by)))
    right = updates.where(F.col(key).isNotNull()).select(F.concat(F.lit("="), F.col(key)).alias("_key"))
    return left.join(right, "_key", "left_anti").drop("_key")


def carry_forward(
    rows: DataFrame,
    partition: str,
    order: Sequence[str],
    values: Mapping[str, Column],
    split_above: int = SPLIT_ABOVE,
    block_rows: int = SPLIT_ABOVE,
) -> DataFrame:
    """Adds, per output name, the last non-null of its expression so far on the ordered path.

    Paths of up to ``split_above`` rows go through one window. Longer ones are cut into
    ordered blocks, walked block by block, and each block is opened with the value its
    predecessors left behind. ``order`` must tell the rows of one path apart.

    Finding the long paths reads ``rows`` once more, one column of it; pass a stored table.
    """
    rows = rows.withColumns({f"_own_{name}": value for name, value in values.items()})
    sizes = rows.groupBy(partition).count().where(F.col("count") > split_above)
    paths, total = sizes.agg(F.count("*"), F.sum("count")).first()
    if not paths:
        return _finish(_walk(rows, [partition], order, values), values)

    long_paths = _sized(sizes.select(partition, F.lit(True).alias("_long")), paths)
    marked = lookup_join(rows, long_paths, partition, order, nulls_match=True)
    short = _walk(marked.where(F.col("_long").isNull()), [partition], order, values)
    blocks = math.ceil(total / block_rows) + 1
    split = _walk_blocks(marked.where(F.col("_long")), partition, order, values, blocks)
    return _finish(short.unionByName(split), values)


def _sized(small: DataFrame, rows: int) -> DataFrame:
    """Marks ``small`` for broadcast when its counted rows allow it; else the planner decides."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def _ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def _walk(rows: DataFrame, partition: Sequence[str], order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    path = (
        Window.partitionBy(*partition)
        .orderBy(*_ascending(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumns({name: F.last(f"_own_{name}", ignorenulls=True).over(path) for name in values})


def _walk_blocks(
    rows: DataFrame, partition: str, order: Sequence[str], values: Mapping[str, Column], blocks: int
) -> DataFrame:
    # Range partitions follow the path order. Their numbers become data here, in a
    # stored table: bounds are drawn from a sample and must not be drawn twice.
    ranged = rows.repartitionByRange(blocks, *_ascending([partition, *order]))
    cut = stored(ranged.withColumn("_block", F.spark_partition_id()), "path-blocks")

    block_ends = cut.groupBy(partition, "_block").agg(
        *[
            F.max_by(f"_own_{name}", F.when(F.col(f"_own_{name}").isNotNull(), nulls_last_key(*order))).alias(name)
            for name in values
        ]
    )
    # one row per path and block it touches
    before = (
        Window.partitionBy(partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = block_ends.select(
        F.col(partition).alias("_path"),
        F.col("_block").alias("_at"),
        *[F.last(name, ignorenulls=True).over(before).alias(f"_carried_{name}") for name in values],
    ).where(" OR ".join(f"_carried_{name} IS NOT NULL" for name in values))
    # A block can continue only one path from the block before it, so there is at most
    # one carried row per block.
    inside = _walk(cut, ["_block", partition], order, values)
    opened = inside.join(
        _sized(carried, blocks),
        (F.col("_block") == F.col("_at")) & F.col(partition).eqNullSafe(F.col("_path")),
        "left",
    )
    return opened.withColumns(
        {name: F.coalesce(F.col(name), F.col(f"_carried_{name}")) for name in values}
    ).drop("_block", "_at", "_path", *[f"_carried_{name}" for name in values])


def _finish(rows: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    return rows.drop("_long", *[f"_own_{name}" for name in values])
