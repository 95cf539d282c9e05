"""Small raw logs and flat events written by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickpath.schema import RAW_EVENTS, TABLES

PURCHASE = "purchase"


def param(key: str, text: str | None = None, number: int | None = None) -> dict:
    return {
        "key": key,
        "value": {"string_value": text, "int_value": number, "float_value": None, "double_value": None},
    }


def raw_event(**given) -> dict:
    row = {
        "event_date": "20240105",
        "event_timestamp": 1_704_412_800_000_000,
        "event_name": "view",
        "user_pseudo_id": "c1",
        "user_id": None,
        "event_bundle_sequence_id": 1,
        "event_server_timestamp_offset": 0,
        "event_params": [],
        "collected_traffic_source": None,
        "session_traffic_source_last_click": None,
        "ecommerce": None,
        "items": None,
    }
    assert not given.keys() - row.keys()
    return row | given


def raw_log(spark: SparkSession, *events: dict) -> DataFrame:
    return spark.createDataFrame(list(events), RAW_EVENTS)


def campaign(source: str | None, medium: str | None = None, name: str | None = None) -> dict:
    return {"manual_campaign": {"source": source, "medium": medium, "campaign_name": name}}


def visit(user: str | None, session: int, time: int, source: str | None = None, medium: str | None = None, **more) -> dict:
    """A raw event whose traffic source is given as parameters; time in seconds after 2024-01-01."""
    at = 1_704_067_200_000_000 + time * 1_000_000
    params = [param("ga_session_id", number=session)]
    params += [param("source", source)] if source is not None else []
    params += [param("medium", medium)] if medium is not None else []
    day = 20240101 + time // 86_400
    return raw_event(
        event_date=str(day), event_timestamp=at, user_pseudo_id=user, event_params=params,
        event_bundle_sequence_id=time, **more,
    )


def order(transaction: str | None, revenue: float = 100.0) -> dict:
    return {"transaction_id": transaction, "purchase_revenue": revenue, "tax": 1.0, "shipping": 2.0}


def item(name: str, price: float | None = 5.0, quantity: int | None = 2, revenue: float | None = None) -> dict:
    return {
        "item_id": name, "item_name": name, "item_category": "c", "price": price,
        "quantity": quantity, "item_revenue": revenue,
    }


def table(spark: SparkSession, name: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), T.StructType(TABLES[name].fields))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    assert left.columns == right.columns
    key = repr
    return sorted(map(tuple, left.collect()), key=key) == sorted(map(tuple, right.collect()), key=key)
