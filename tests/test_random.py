"""Random logs full of ties, gaps and colliding keys, against the SQL of the checks."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import clickpath as cp
from checks import oracle as sql
from checks.compare import difference
from clickpath.storage import stored
from tests.rows import PURCHASE, item, order, raw_log, visit


def random_log(spark, seed):
    rng = random.Random(seed)

    def maybe(value, chance=0.5):
        return value if rng.random() < chance else None

    events = []
    for n in range(500):
        bought = rng.random() < 0.2
        events.append(
            visit(
                rng.choice(["1", "12", "123", "7", None]),
                maybe(rng.choice([1, 2, 3, 23, 123]), 0.9),
                rng.randrange(0, 200_000, 2000),
                maybe(rng.choice(["(direct)", "google", "bing", ""])),
                maybe(rng.choice(["(none)", "cpc", "organic"])),
                user_id=maybe(rng.choice(["a", "b", "c"]), 0.3),
                event_name=PURCHASE if bought else "view",
                ecommerce=order(maybe(f"T{n}", 0.9), rng.choice([10.0, 0.1, None])) if bought else None,
                items=maybe(
                    [
                        item(f"i{i}", maybe(2.5, 0.9), maybe(3, 0.9), maybe(rng.choice([0.0, 7.5])))
                        for i in range(rng.randrange(4))
                    ],
                    0.8,
                )
                if bought
                else None,
            )
        )
    return raw_log(spark, *events)


@pytest.fixture(scope="module", params=[11, 12])
def case(request, spark):
    events = stored(cp.pre_events(random_log(spark, request.param)), "random-events")
    flat = events.select(*[c for c in events.columns if c not in ("ecommerce", "items")], "ecommerce.*", "items")
    connection = duckdb.connect()
    connection.register("flat", flat.toArrow())
    return events, connection


def expected(connection, select, *steps):
    return connection.sql("with" + ",".join(steps) + "\n" + select).to_arrow_table()


GRAINS = {"session": sql.ROLLED, "event": sql.ROLLED_BY_EVENT}


@pytest.mark.parametrize("grain", GRAINS)
def test_sessions_and_attribution(case, grain):
    events, connection = case
    rolled = GRAINS[grain]
    pre = stored(cp.pre_sessions(events, grain), "random-pre")
    assert difference(pre, expected(connection, "select * from rolled", rolled)) is None
    carried = expected(connection, "select * from carried", rolled, sql.CARRIED)
    assert carried.num_rows > 20
    sessions = stored(cp.sessions(pre, grain), "random-sessions")
    assert difference(sessions, carried) is None
    assert difference(cp.sessions(pre, grain, split_above=4, block_rows=12), carried) is None
    models = {cp.first_click: sql.FIRST, cp.last_non_direct: sql.LAST, cp.linear: sql.LINEAR}
    for model, step in models.items():
        assert difference(model(sessions), expected(connection, "select * from touched", rolled, sql.CARRIED, step)) is None
    shares = expected(connection, "select * from shares", rolled, sql.CARRIED, sql.SHARES)
    assert difference(cp.linear_by_source(cp.linear(sessions)), shares) is None


def test_models_without_a_session_table(case):
    events, connection = case
    pre = cp.pre_sessions(events)
    for model, step in {cp.first_click_from_pre: sql.FIRST, cp.last_non_direct_from_pre: sql.LAST}.items():
        rows = expected(connection, "select * from touched", sql.ROLLED, sql.CARRIED, step)
        assert difference(model(pre), rows) is None


def test_reports(case):
    events, connection = case
    attribution = stored(cp.last_non_direct_from_pre(cp.pre_sessions(events)), "random-attribution")
    ids = cp.unified_id(events)
    assert difference(ids, expected(connection, "select * from identity", sql.identity())) is None
    steps = [sql.ROLLED, sql.CARRIED, sql.LAST, sql.identity(), sql.ORDERS, sql.ITEMS]
    weight = {"attribution": "touched", "weight": "a.attribution_weight"}
    orders = expected(connection, sql._TRANSACTION.format(on="a.session_key = p.session_key", **weight), *steps)
    assert difference(cp.transactions(events, attribution, ids), orders) is None
    items = expected(connection, sql._PRODUCT.format(on="a.session_key = s.session_key", **weight), *steps)
    assert items.num_rows > 20
    assert difference(cp.products(events, attribution), items) is None


def test_own_session_is_found_by_cookie_and_id(case):
    """Session scope joins on both parts of the key, so it holds where the joined text collides."""
    events, connection = case
    sessions = stored(cp.sessions(stored(cp.pre_sessions(events), "random-pre")), "random-sessions")
    ids = cp.unified_id(events)
    on = "a.user_pseudo_id = {t}.user_pseudo_id and a.ga_session_id = {t}.ga_session_id"
    found = {"attribution": "carried", "weight": sql._FOUND}
    steps = [sql.ROLLED, sql.CARRIED, sql.identity(), sql.ORDERS, sql.ITEMS]
    orders = expected(connection, sql._TRANSACTION.format(on=on.format(t="p"), **found), *steps)
    assert difference(cp.transactions_session_scope(events, sessions, ids), orders) is None
    items = expected(connection, sql._PRODUCT.format(on=on.format(t="s"), **found), *steps)
    assert difference(cp.products_session_scope(events, sessions), items) is None
    assert events.where(F.col("event_name") == PURCHASE).count() > 50
