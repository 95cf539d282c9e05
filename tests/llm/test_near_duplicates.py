from __future__ import annotations

import collections

import pytest

from clickpath.llm import near_duplicates
from clickpath.llm.components import components
from . import brute
from .conftest import edited, pairs, prose


def found(df) -> collections.Counter:
    rows = near_duplicates.near_duplicates(df).collect()
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_equals_brute_force(request, table):
    df = request.getfixturevalue(table)
    assert found(df) == brute.near_groups(pairs(df))


def test_groups_with_links_of_all_strengths(spark, monkeypatch):
    """All lists count as long, and clusters take many blocks."""
    monkeypatch.setattr(near_duplicates, "SHORT_LIST", 1)
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    base = prose(50, 300)
    rows = [(i, edited(base, 20 + 3 * i)) for i in range(30)]
    rows += [(100 + i, edited(prose(51, 200), 60 + i)) for i in range(15)] + [(200, base), (201, base), (202, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute.near_groups(rows)


def test_repeated_ids_with_other_texts(spark):
    rows = [(1, prose(60, 80)), (1, prose(61, 80)), (2, prose(61, 80)), (3, edited(prose(60, 80), 70)), (3, prose(62, 9))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.near_groups(rows)


def test_a_chain_is_one_component(spark):
    rows = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (102, 101)]
    labels = {r["node"]: r["label"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_common_shingles_of_blocks():
    import numpy as np

    draw = np.random.default_rng(1)
    a, b = ([np.unique(draw.integers(0, 60, n)).astype(np.uint64) for n in sizes] for sizes in ((5, 40, 90), (1, 30, 70, 80)))
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert near_duplicates._common(a, b, columns=7).tolist() == want
