"""Total orders as values, so that "first row" and "last row" become plain aggregates.

``min_by`` and ``max_by`` combine on the map side, which a ranking window does not. A
group of any size then reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nulls_last_key(*names: str) -> Column:
    """Comparable key for ``ORDER BY names ASC NULLS LAST``."""
    parts: list[Column] = []
    for name in names:
        parts += [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]
    return F.struct(*parts)


def earliest(value: Column, *names: str) -> Column:
    """``value`` on the first row by ``names`` ascending, nulls last."""
    return F.min_by(value, nulls_last_key(*names))


def latest(value: Column, *names: str) -> Column:
    """``value`` on the first row by ``names`` descending, nulls last.

    Structs compare field by field with NULL lowest, which is that order read backwards.
    """
    return F.max_by(value, F.struct(*[F.col(name) for name in names]))
