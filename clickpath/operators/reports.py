"""Purchases and purchased items with attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.operators.attribution import linear_by_source
from clickpath.operators.skew import lookup_join
from clickpath.schema import columns

# Fixed value: the event that carries an order.
PURCHASE = "purchase"

_ATTRIBUTION = {
    "final_session_source": "attribution_source",
    "final_session_medium": "attribution_medium",
}
_SPREAD = ["event_timestamp", "transaction_id"]


def _purchases(events: DataFrame) -> DataFrame:
    """Purchase events that have a transaction id; both conditions reach the scan."""
    return events.where((F.col("event_name") == PURCHASE) & F.col("ecommerce.transaction_id").isNotNull())


def _orders(events: DataFrame) -> DataFrame:
    return _purchases(events).select(
        "event_date", "event_timestamp", "user_pseudo_id", "ga_session_id", "session_key", "ecommerce.*"
    )


def _items(events: DataFrame) -> DataFrame:
    """One row per item; a purchase without items has none."""
    items = _purchases(events).select(
        "event_date",
        "event_timestamp",
        "user_pseudo_id",
        "ga_session_id",
        "session_key",
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.explode("items").alias("item"),
    )
    listed = [name for name in columns("products") if name.startswith("item_") or name in ("price", "quantity")]
    flat = items.select("*", *[F.col(f"item.{name}").alias(name) for name in listed]).drop("item")
    return flat.withColumn("item_revenue", F.coalesce("item_revenue", F.col("price") * F.col("quantity")))


def _by_session_key(attribution: DataFrame) -> DataFrame:
    return attribution.select("session_key", *_ATTRIBUTION, "attribution_weight").withColumnsRenamed(_ATTRIBUTION)


def _own_session(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Attaches the source of the session a row happened in, with weight 1.

    Cookie and session id together name the session: the joined key alone can belong to
    two cookies and would count an order twice.
    """
    # digits end at the slash, so two pairs never read the same
    pair = F.concat(F.col("ga_session_id").cast("string"), F.lit("/"), F.col("user_pseudo_id"))
    found = sessions.select(pair.alias("_owner"), *_ATTRIBUTION, F.lit(1.0).alias("attribution_weight"))
    keyed = rows.withColumn("_owner", pair)
    return lookup_join(keyed, found.withColumnsRenamed(_ATTRIBUTION), "_owner", _SPREAD).drop("_owner")


def _with_identity(orders: DataFrame, ids: DataFrame) -> DataFrame:
    return lookup_join(orders, ids, "user_pseudo_id", _SPREAD)


def _revenue(orders: DataFrame) -> DataFrame:
    attributed = F.col("purchase_revenue") * F.col("attribution_weight")
    return orders.withColumn("attributed_revenue", attributed).select(*columns("transactions"))


def transactions(events: DataFrame, attribution: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per purchase, with the attribution row of its session and the login of its cookie.

    The attribution table keeps one session per cookie, so only purchases made in that
    very session get a source; see ``transactions_session_scope`` for all of them.
    """
    attributed = lookup_join(_orders(events), _by_session_key(attribution), "session_key", _SPREAD)
    return _revenue(_with_identity(attributed, ids))


def transactions_session_scope(events: DataFrame, sessions: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per purchase, with the last non-direct source as of its own session."""
    return _revenue(_with_identity(_own_session(_orders(events), sessions), ids))


def transactions_split(events: DataFrame, linear: DataFrame, ids: DataFrame) -> DataFrame:
    """Revenue of each purchase spread over the sources of its cookie by linear weight.

    Sessions are grouped by source before the join: one row per purchase and source, not
    per purchase and session.
    """
    shares = linear_by_source(linear).withColumnsRenamed(_ATTRIBUTION)
    return _revenue(lookup_join(_with_identity(_orders(events), ids), shares, "user_pseudo_id", _SPREAD))


def products(events: DataFrame, attribution: DataFrame) -> DataFrame:
    """One row per purchased item, with the attribution row of its session."""
    attributed = lookup_join(_items(events), _by_session_key(attribution), "session_key", _SPREAD)
    return attributed.select(*columns("products"))


def products_session_scope(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per purchased item, with the last non-direct source as of its own session."""
    return _own_session(_items(events), sessions).select(*columns("products"))


def products_split(events: DataFrame, linear: DataFrame) -> DataFrame:
    """Purchased items with the sources of their cookie and the linear weight of each: one row per item and source."""
    shares = linear_by_source(linear).withColumnsRenamed(_ATTRIBUTION)
    return lookup_join(_items(events), shares, "user_pseudo_id", _SPREAD).select(*columns("products"))
