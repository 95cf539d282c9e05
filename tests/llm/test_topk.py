from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duck, expected_of
from clickpath.llm import topk
from .conftest import SMOKE

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, block int, score long"


def best(rows: list[tuple], every: int, k: int) -> set:
    import numpy as np

    vectors = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(vec_id, []).append([math.floor(256 * float(np.float32(x))) for x in v])
    out = set()
    for q in (i for i in vectors if i % every == 0):
        scores = {
            i: max(sum(a * b for a, b in zip(x, y)) for x in vectors[q] for y in ys) for i, ys in vectors.items() if i != q
        }
        ranked = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
        out |= {(q, r + 1, i, s) for r, (i, s) in enumerate(ranked)}
    return out


def rows_of(n: int, seed: int = 1) -> list[tuple]:
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 0.3) for _ in range(8)], i % 3, "x", 1, 2) for i in range(n)]


AWKWARD = [
    (None, [1.0] * 8, 0, "x", 1, 2),
    (1000, None, 0, "x", 1, 2),
    (1001, [None] + [1.0] * 7, 0, None, 1, 2),
    (1002, [float("nan")] * 8, 0, "x", 1, 2),
    (1003, [float("inf")] * 8, 0, "x", 1, 2),
    (1005, [0.5] * 8, 0, "x", 1, 2),
    (1006, [0.5] * 8, 0, "x", 1, 2),
    (1007, [0.5] * 8, 0, "x", 1, 2),
    (1007, [0.5] * 8, 0, "x", 1, 2),
    (1010, [0.1] * 3, 0, "x", 1, 2),
    (1010, [0.9] * 8, 0, "x", 1, 2),
    (1020, [], 0, "x", 1, 2),
    (-10, [-0.5] * 8, 0, "x", 1, 2),
]


@pytest.mark.parametrize(("block", "queries"), [(4096, 512), (16, 4)])
def test_equals_brute_force(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries)
    rows = rows_of(150) + AWKWARD
    vectors = topk.scaled_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.top_k(vectors, F.col("vec_id") % 10 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == best(rows, 10, 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = rows_of(n)
    vectors = topk.scaled_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.top_k(vectors, F.col("vec_id") % 1 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == best(rows, 1, 5)


def test_bounds_leave_candidates_out():
    import numpy as np

    draw = np.random.default_rng(1)
    centers = draw.normal(0, 200, (40, 16))
    x = (centers[np.arange(2000) % 40] + draw.normal(0, 2, (2000, 16))).astype(np.int64)
    far = topk._distances(x, x[:32])
    ids = np.arange(2000)
    q, found, scores, evaluated = topk._search((ids[:20], x[:20], far[:, :20]), (ids, x, far), 5)
    assert evaluated < 0.7 * 20 * 2000
    exact = x[:20] @ x.T
    exact[np.arange(20), np.arange(20)] = np.iinfo(np.int64).min
    assert sorted(scores) == sorted(np.sort(exact, axis=1)[:, -5:].ravel().tolist())


def test_equals_the_sql(spark):
    assert difference(topk.op3_topk(spark, SMOKE), expected_of(duck(SMOKE), topk.OP3_SQL)) is None


def test_pairs_of_blocks_are_not_shuffled(spark):
    vectors = topk.scaled_vectors(spark.createDataFrame(rows_of(50), SCHEMA))
    plan = topk.top_k(vectors, F.col("vec_id") % 10 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert "SortMergeJoin" not in plan and "Broadcast" not in plan
    # vectors are in the files only; what is sent are ids and scores
    assert not [line for line in plan.split("\n") if "Exchange" in line and "vectors" in line]


def test_memory_of_a_search_does_not_follow_its_pairs():
    import tracemalloc

    import numpy as np

    draw = np.random.default_rng(1)
    x = draw.integers(-100, 100, (8192, 8))
    far, ids = topk._distances(x, x[:8]), np.arange(8192)
    tracemalloc.start()
    topk._search((ids[:4096], x[:4096], far[:, :4096]), (ids, x, far), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a byte for each of the 32 million pairs would be more
    assert peak < 4096 * 8192


@pytest.mark.parametrize("scale", [1, 100, 1 << 14, 1 << 24])
@pytest.mark.parametrize("spread", [2, 40])
@pytest.mark.parametrize("k", [1, 5])
def test_blocks_in_any_order(monkeypatch, scale, spread, k):
    """Ties, ids with several vectors, and scores beyond what floats hold."""
    import numpy as np

    monkeypatch.setattr(topk, "TILE_ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 7)
    draw = np.random.default_rng(spread)
    x = draw.integers(-spread, spread + 1, (600, 6)) * scale + draw.integers(0, 2, (600, 6))
    ids = draw.permutation(np.append(np.arange(500), np.arange(100)))
    pivots = x[:8]
    is_query = ids % 20 == 0
    q_ids, q = ids[is_query], x[is_query]
    best = topk._Best(q_ids, q, topk._distances(q, pivots), k)
    for at in (slice(400, 600), slice(0, 3), slice(3, 400)):
        best.meet(topk._Candidates.of(ids[at], x[at], topk._distances(x[at], pivots)))
    row = np.repeat(np.arange(len(q_ids)), best.count)
    got = list(zip(row.tolist(), *(c.tolist() for c in best.rows()[1:3])))
    expected = []
    for i, v in enumerate(q.tolist()):
        scores: dict[int, int] = {}
        for x_id, y in zip(ids.tolist(), x.tolist()):
            if x_id != q_ids[i]:
                scores[x_id] = max(scores.get(x_id, -(1 << 62)), sum(a * b for a, b in zip(v, y)))
        expected += [(i, *found) for found in sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]]
    assert got == expected


def test_without_pivots(spark):
    rows = rows_of(30)
    got = topk.top_k(topk.scaled_vectors(spark.createDataFrame(rows, SCHEMA)), F.col("vec_id") % 10 == 0, pivots=0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == best(rows, 10, 5)


def test_row_groups_of_blocks_are_bounded(spark, monkeypatch):
    import numpy as np
    import pyarrow.parquet as pq

    monkeypatch.setitem(topk.ROW_GROUPS, "parquet.block.size", "4096")
    vectors = topk.scaled_vectors(spark.createDataFrame(rows_of(300), SCHEMA)).coalesce(1)
    blocks = topk._blocks(vectors, np.eye(8, dtype=np.int64), 1, topk._candidate_block, topk.BLOCK, "topk-blocks")
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in blocks.inputFiles()]
    # without the settings a group has at least 100 rows, however large these are
    assert sum(f.num_rows for f in files) == 300
    assert max(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) < 100
