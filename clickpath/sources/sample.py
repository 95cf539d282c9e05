"""Raw event log derived from a plain ``events`` table (event_id, ts, user_id, event_type, value, props).

The small integer in ``props`` decides which parameters, traffic records and basket an
event gets, so the result covers every branch of the models: missing cookies, missing
session ids, several logins per cookie, each step of the traffic cascade, orders without
an id, empty baskets. Every event of the table is used. Session time zone: UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.schema import ECOMMERCE, ITEMS, RAW_EVENTS

# Fixed values of the sample.
SESSION_LENGTH_US = 259_200_000_000
PAGE = "https://shop.example/p/"
FULL_TAGS = "?utm_source=google&utm_medium=cpc&utm_campaign=c"
SOURCE_TAG = "?ref=x&utm_source=news"

_VALUE = "struct<string_value:string,int_value:bigint,float_value:double,double_value:double>"
_PARAM = f"struct<key:string,value:{_VALUE}>"
_TRAFFIC = "struct<manual_campaign:struct<source:string,medium:string,campaign_name:string>>"


def _param(key: str, text: Column | None = None, number: Column | None = None) -> Column:
    nothing = F.lit(None)
    value = F.struct(
        text if text is not None else nothing,
        number if number is not None else nothing,
        nothing,
        nothing,
    )
    return F.struct(F.lit(key), value).cast(_PARAM)


def _campaign(source: str, medium: str, name: str | None) -> Column:
    return F.struct(F.struct(F.lit(source), F.lit(medium), F.lit(name))).cast(_TRAFFIC)


def sample_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        "event_id", "user_id", "event_type", "value", "ts", k.alias("k"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    k, uid, value = F.col("k"), F.col("user_id"), F.col("value")
    kind = k % 6
    purchase = F.col("event_type") == "purchase"
    url = F.concat(
        F.lit(PAGE),
        k.cast("string"),
        F.when(kind == 0, F.concat(F.lit(FULL_TAGS), (k % 3).cast("string")))
        .when(kind == 1, F.lit(SOURCE_TAG))
        .otherwise(F.lit("")),
    )
    params = F.array_compact(
        F.array(
            F.when(k % 17 != 0, _param("ga_session_id", number=F.expr(f"us div {SESSION_LENGTH_US}"))),
            _param("page_location", text=url),
            F.when(kind == 1, _param("source", text=F.lit("ignored"))),
            F.when(kind == 1, _param("medium", text=F.lit("email"))),
            F.when(kind == 2, _param("source", text=F.lit("(direct)"))),
            F.when(kind == 2, _param("medium", text=F.lit("(none)"))),
        )
    )
    order = F.struct(
        F.when(k % 13 != 0, F.concat(F.lit("T"), F.col("event_id").cast("string"))),
        value,
        value * 0.25,
        value * 0.125,
    ).cast(ECOMMERCE)

    def item(i: Column) -> Column:
        sku = ((k + i) % 20).cast("string")
        return F.struct(
            F.concat(F.lit("sku"), sku).alias("item_id"),
            F.concat(F.lit("Item "), sku).alias("item_name"),
            F.concat(F.lit("cat"), (i % 3).cast("string")).alias("item_category"),
            (value * 0.5).alias("price"),
            i.cast("bigint").alias("quantity"),
            F.when(i % 2 == 0, value * 0.75).alias("item_revenue"),
        )

    # sequence(1, 0) counts down, so the empty basket needs its own branch
    basket = F.when(k % 4 == 0, F.array().cast(ITEMS)).otherwise(
        F.transform(F.sequence(F.lit(1), k % 4), item).cast(ITEMS)
    )
    raw = base.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.col("us").alias("event_timestamp"),
        F.col("event_type").alias("event_name"),
        F.when(uid % 50 != 49, F.concat(F.lit("c"), uid.cast("string"))).alias("user_pseudo_id"),
        F.when(k % 4 == 0, F.concat(F.lit("crm"), uid.cast("string")))
        .when((k % 4 == 1) & (uid % 5 == 0), F.concat(F.lit("crm_alt"), uid.cast("string")))
        .alias("user_id"),
        F.col("event_id").alias("event_bundle_sequence_id"),
        (k * 1000).cast("bigint").alias("event_server_timestamp_offset"),
        params.alias("event_params"),
        F.when(kind == 3, _campaign("bing", "organic", None)).alias("collected_traffic_source"),
        F.when(kind == 4, _campaign("partner", "referral", "spring")).alias("session_traffic_source_last_click"),
        F.when(purchase, order).alias("ecommerce"),
        F.when(purchase, basket).alias("items"),
    )
    return raw.select(*RAW_EVENTS.fieldNames())
