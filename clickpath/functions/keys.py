"""Row identifiers. Parts are joined without a separator, and one NULL part makes the whole NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpath.functions.farm import farm_fingerprint, json_text
from clickpath.schema import RAW_EVENTS


def event_id() -> Column:
    return F.concat(
        F.col("user_pseudo_id"),
        F.col("event_timestamp").cast("string"),
        F.col("event_name"),
        F.col("event_bundle_sequence_id").cast("string"),
        F.col("event_server_timestamp_offset").cast("string"),
    )


def fingerprint_event_id(params: str = "event_params") -> Column:
    """Identifier ending in a 64-bit hash of the whole parameter array.

    Null fields stay in the hashed text, so arrays that differ only in which value
    subfield is set do not meet.
    """
    text = F.to_json(F.col(params), {"ignoreNullFields": "false"})
    return F.concat(
        F.col("user_pseudo_id"),
        F.col("event_timestamp").cast("string"),
        F.col("event_name"),
        F.xxhash64(text).cast("string"),
    )


def params_json(params: str = "event_params") -> Column:
    """JSON text of the parameter array. A repeated column is never null, so a missing array is an empty one."""
    return json_text(F.coalesce(F.col(params), F.array().cast(RAW_EVENTS[params].dataType)), RAW_EVENTS[params].dataType)


def farm_event_id(params: str = "event_params") -> Column:
    """Identifier ending in the public 64-bit FarmHash fingerprint of the parameters' JSON text."""
    return F.concat(
        F.col("user_pseudo_id"),
        F.col("event_timestamp").cast("string"),
        F.col("event_name"),
        farm_fingerprint(params_json(params)).cast("string"),
    )


def session_key(session_id: Column) -> Column:
    return F.concat(F.col("user_pseudo_id"), session_id.cast("string"))
