from __future__ import annotations

import collections

import numpy as np
import pytest

from clickpath.llm import jaccard_join as J
from . import brute
from .conftest import edited, pairs, prose


def found(df, **options) -> collections.Counter:
    rows = J.jaccard_join(df, **options).collect()
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in rows)


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_equals_brute_force(request, table):
    df = request.getfixturevalue(table)
    assert found(df) == brute.jaccard_links(pairs(df))


@pytest.mark.parametrize("num", [60, 80, 100])
def test_links_of_all_strengths(spark, monkeypatch, num):
    """No cluster is small, and clusters take many tiles and bands."""
    monkeypatch.setattr(J, "SMALL_CLUSTER", 1)
    monkeypatch.setattr(J, "TILE_CLASSES", 4)
    base = prose(50, 300)
    rows = [(i, edited(base, 20 + 3 * i)) for i in range(30)]
    rows += [(100 + i, edited(prose(51, 200 + 4 * i), 60 + i)) for i in range(15)] + [(200, base), (201, base), (202, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, num=num) == brute.jaccard_links(rows, num)


def test_one_tile_for_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE_SHINGLES", 100)
    rows = [(i, edited(prose(53, 150), 100 + i)) for i in range(6)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.jaccard_links(rows)


def test_repeated_ids_with_other_texts(spark):
    rows = [(1, prose(60, 80)), (1, prose(61, 80)), (2, prose(61, 80)), (3, edited(prose(60, 80), 70)), (3, prose(62, 9)), (3, prose(62, 9))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.jaccard_links(rows)


@pytest.mark.parametrize("num", [50, 75, 80, 99, 100])
def test_linked_sizes_lie_in_neighbouring_bands(num):
    n = np.arange(1, 3000)
    band = J.size_band(n, num, 100)
    for x in n:
        far = min(x * 100 // num, 2999)
        assert 0 <= band[far - 1] - band[x - 1] <= 1


def test_bounds_are_no_less_than_the_overlap():
    draw = np.random.default_rng(4)

    def tile(sizes):
        sets = [np.unique(draw.integers(0, 400, n)).astype("<u8") * np.uint64(0x9E3779B97F4A7C15) for n in sizes]
        t = J._Tile.__new__(J._Tile)
        t.sizes = np.array([len(s) for s in sets])
        t.flat, t.row = np.concatenate(sets), np.repeat(np.arange(len(sets)), t.sizes)
        return t, sets

    for scale in (1, 10):
        (a, of_a), (b, of_b) = tile([3 * scale, 20 * scale, 30]), tile([5, 18 * scale, 40 * scale])
        bound = J.overlap_bounds(a, b)
        exact = np.array([[len(np.intersect1d(x, y)) for y in of_b] for x in of_a])
        assert (bound >= exact).all()
        assert (bound < np.minimum(a.sizes[:, None], b.sizes[None, :])).any()


def test_only_thresholds_that_mean_something(spark, nothing):
    with pytest.raises(ValueError):
        J.jaccard_join(nothing, num=0)
