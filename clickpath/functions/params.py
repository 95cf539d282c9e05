"""Lookup of one key in a repeated key/value record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_param(key: str, field: str, params: str = "event_params", on_duplicate: str = "first") -> Column:
    """Value of ``field`` under ``key``; NULL when the key, the field or the whole array is missing.

    Written over the key and value columns of the array, not with a lambda: a lambda
    ends code generation and makes the scan read every value subfield, while this form
    lets the Parquet reader fetch only the subfields asked for.

    A repeated key gives its first value, or raises with ``on_duplicate="error"``.
    """
    keys = F.col(f"{params}.key")
    value = F.get(F.col(f"{params}.value.{field}"), F.array_position(keys, key) - 1)
    if on_duplicate == "first":
        return value
    if on_duplicate == "error":
        hits = F.size(keys) - F.size(F.array_remove(keys, key))
        return F.when(hits > 1, F.raise_error(F.lit(f"event parameter {key} occurs more than once"))).otherwise(value)
    raise ValueError(f"on_duplicate must be 'first' or 'error', not {on_duplicate!r}")
