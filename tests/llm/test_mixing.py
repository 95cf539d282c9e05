from __future__ import annotations

import collections

import pytest

from checks.compare import difference, duck, expected_of
from clickpath.llm import mixing
from . import brute
from .conftest import SMOKE, pairs


def water_filling(sizes: dict, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> dict:
    """Rounds of clamping and sharing anew, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free = {}, set(names)
    rest = share * sum(sizes.values())
    while free:
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] >= most * sizes[s]}
        if not over:
            return target | part
        target |= {s: most * sizes[s] for s in over}
        rest -= sum(most * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke"])
def test_targets_are_those_of_the_rounds(request, table):
    df = request.getfixturevalue(table)
    rows = mixing.mix(df).collect()
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == collections.Counter((d, len(brute.words(t))) for d, t in pairs(df))
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    expected = water_filling(dict(sizes))
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]], rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, words in taken.items():
        assert abs(words - expected[source]) <= largest[source]


def test_reruns_agree(smoke):
    assert sorted(mixing.mix(smoke).collect()) == sorted(mixing.mix(smoke.repartition(5)).collect())


def test_buckets_bound_the_error(smoke):
    rows = mixing.mix(smoke, bucket_rows=3).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.25)


def test_other_weights(awkward):
    rows = mixing.mix(awkward, weights=(1,), share=2.0).collect()
    assert all(r["taken"] == 2 * r["size"] for r in rows)


def test_nothing(nothing):
    assert mixing.mix(nothing).collect() == []


def test_equals_the_sql(spark):
    assert difference(mixing.op6_mixing(spark, SMOKE), expected_of(duck(SMOKE), mixing.OP6_SQL)) is None
