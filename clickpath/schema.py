"""Column contracts: the raw event log and the nine tables built from it."""

from __future__ import annotations

from pyspark.sql import types as T

_PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)

_CAMPAIGN = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("campaign_name", T.StringType()),
    ]
)

_TRAFFIC = T.StructType([T.StructField("manual_campaign", _CAMPAIGN)])

ECOMMERCE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("purchase_revenue", T.DoubleType()),
        T.StructField("tax", T.DoubleType()),
        T.StructField("shipping", T.DoubleType()),
    ]
)

ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("item_name", T.StringType()),
            T.StructField("item_category", T.StringType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("quantity", T.LongType()),
            T.StructField("item_revenue", T.DoubleType()),
        ]
    )
)

# Always read with this schema: left to inference, a partition column named
# event_date with values such as 20240131 becomes an integer.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_bundle_sequence_id", T.LongType()),
        T.StructField("event_server_timestamp_offset", T.LongType()),
        T.StructField(
            "event_params",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType()),
                        T.StructField("value", _PARAM_VALUE),
                    ]
                )
            ),
        ),
        T.StructField("collected_traffic_source", _TRAFFIC),
        T.StructField("session_traffic_source_last_click", _TRAFFIC),
        T.StructField("ecommerce", ECOMMERCE),
        T.StructField("items", ITEMS),
    ]
)

# The same log in the layout where the collected campaign is not nested.
COLLECTED_FLAT = T.StructType(
    [
        T.StructField("manual_source", T.StringType()),
        T.StructField("manual_medium", T.StringType()),
        T.StructField("manual_campaign_name", T.StringType()),
    ]
)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_ATTRIBUTION = _table(
    ("user_pseudo_id", T.StringType()),
    ("session_key", T.StringType()),
    ("final_session_source", T.StringType()),
    ("final_session_medium", T.StringType()),
    ("attribution_weight", T.DoubleType()),
)

# Column order is part of each contract.
TABLES: dict[str, T.StructType] = {
    "pre_events": _table(
        ("event_id", T.StringType()),
        ("event_date", T.DateType()),
        ("event_timestamp", T.LongType()),
        ("event_name", T.StringType()),
        ("user_pseudo_id", T.StringType()),
        ("user_id", T.StringType()),
        ("ga_session_id", T.LongType()),
        ("session_key", T.StringType()),
        ("fixed_traffic_source", T.StringType()),
        ("fixed_traffic_medium", T.StringType()),
        ("fixed_traffic_campaign", T.StringType()),
        ("ecommerce", ECOMMERCE),
        ("items", ITEMS),
    ),
    "pre_sessions": _table(
        ("session_key", T.StringType()),
        ("user_pseudo_id", T.StringType()),
        ("ga_session_id", T.LongType()),
        ("session_start_timestamp", T.LongType()),
        ("session_first_source", T.StringType()),
        ("session_first_medium", T.StringType()),
        ("session_last_source", T.StringType()),
        ("session_last_medium", T.StringType()),
    ),
    "sessions": _table(
        ("session_key", T.StringType()),
        ("user_pseudo_id", T.StringType()),
        ("ga_session_id", T.LongType()),
        ("session_start_timestamp", T.LongType()),
        ("session_first_source", T.StringType()),
        ("session_last_source", T.StringType()),
        ("final_session_source", T.StringType()),
        ("final_session_medium", T.StringType()),
    ),
    "unified_id": _table(
        ("user_pseudo_id", T.StringType()),
        ("resolved_user_id", T.StringType()),
    ),
    "attribution_first_click": _ATTRIBUTION,
    "attribution_last_non_direct": _ATTRIBUTION,
    "attribution_linear": _ATTRIBUTION,
    "transactions": _table(
        ("event_date", T.DateType()),
        ("transaction_id", T.StringType()),
        ("resolved_user_id", T.StringType()),
        ("purchase_revenue", T.DoubleType()),
        ("tax", T.DoubleType()),
        ("shipping", T.DoubleType()),
        ("attribution_source", T.StringType()),
        ("attribution_medium", T.StringType()),
        ("attribution_weight", T.DoubleType()),
        ("attributed_revenue", T.DoubleType()),
    ),
    "products": _table(
        ("event_date", T.DateType()),
        ("transaction_id", T.StringType()),
        ("item_id", T.StringType()),
        ("item_name", T.StringType()),
        ("item_category", T.StringType()),
        ("price", T.DoubleType()),
        ("quantity", T.LongType()),
        ("item_revenue", T.DoubleType()),
        ("attribution_source", T.StringType()),
        ("attribution_medium", T.StringType()),
        ("attribution_weight", T.DoubleType()),
    ),
}

def _key(*names: tuple[str, T.DataType]) -> T.StructType:
    """A key of ``functions.ordering.nulls_last_key``."""
    return T.StructType(
        [f for name, kind in names for f in (T.StructField(f"{name}_missing", T.BooleanType()), T.StructField(name, kind))]
    )


_TIME = ("event_timestamp", T.LongType())
_SOURCE = ("fixed_traffic_source", T.StringType())
_MEDIUM = ("fixed_traffic_medium", T.StringType())
_PLACE = _key(("session_start_timestamp", T.LongType()), ("session_key", T.StringType()), ("ga_session_id", T.LongType()))


def _carried(name: str) -> T.StructType:
    return T.StructType([T.StructField("place", _PLACE), T.StructField(name, T.StringType())])


# What a daily load keeps of each day beside the tables, so that old events are not read again.
STATE_TABLES: dict[str, T.StructType] = {
    "session_days": _table(
        ("user_pseudo_id", T.StringType()),
        ("ga_session_id", T.LongType()),
        ("session_start_timestamp", T.LongType()),
        ("first_source", _key(_TIME, _SOURCE)),
        ("first_medium", _key(_TIME, _SOURCE, _MEDIUM)),
        ("last_source", _key(_TIME, _SOURCE)),
        ("last_medium", _key(_TIME, _SOURCE, _MEDIUM)),
        ("event_date", T.DateType()),
    ),
    "identity_days": _table(
        ("user_pseudo_id", T.StringType()),
        ("first_login", _key(_TIME, ("user_id", T.StringType()))),
        ("event_date", T.DateType()),
    ),
    "path_days": _table(
        ("user_pseudo_id", T.StringType()),
        ("last_place", _PLACE),
        ("last_source", _carried("session_first_source")),
        ("last_medium", _carried("session_first_medium")),
        ("session_day", T.DateType()),
    ),
    "purchase_days": _table(
        ("user_pseudo_id", T.StringType()),
        ("ga_session_id", T.LongType()),
        ("session_key", T.StringType()),
        ("event_date", T.DateType()),
    ),
}

DESCRIPTIONS: dict[str, str] = {
    "pre_events": "One row per event: parameters pulled out, traffic source resolved, event and session keys.",
    "pre_sessions": "Events rolled up to sessions, with the first and last traffic source of each.",
    "sessions": "Sessions with the last non-direct source of the cookie carried forward.",
    "unified_id": "Login id first seen for each cookie.",
    "attribution_first_click": "Full weight to the first session of each cookie.",
    "attribution_last_non_direct": "Full weight to the last session of each cookie, with its carried source.",
    "attribution_linear": "Equal weight to every session of a cookie.",
    "transactions": "One row per purchase with resolved identity and attributed revenue.",
    "products": "One row per purchased item with attribution.",
}


def columns(table: str) -> list[str]:
    return TABLES[table].fieldNames()
