from __future__ import annotations

import collections
import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import vector_codes as V
from .conftest import SMOKE

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(vector) -> bool:
    return bool(vector) and all(x is not None and math.isfinite(x) and abs(x) < 1e25 for x in vector)


def expected(rows: list[tuple], entries: int = 16, rounds: int = 6, parts: int = 8) -> collections.Counter:
    """(vec_id, code, error, label_error, digest) with Python's own numbers, one distance after the other."""
    kept = sorted((r for r in rows if usable(r[1])), key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    if not kept:
        return collections.Counter()
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    size = -(-len(kept[0][1]) // parts)
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    whole = [w + [0] * (size * parts - len(w)) for w in whole]
    piece = [[w[p * size : (p + 1) * size] for p in range(parts)] for w in whole]
    books = [[piece[i][p] for i in range(min(entries, len(kept)))] for p in range(parts)]

    def assigned() -> list[list[tuple[int, int]]]:
        return [
            [min((sum((x - y) ** 2 for x, y in zip(w[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)] for w in piece
        ]

    for _ in range(rounds):
        chosen = assigned()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [w[p] for w, c in zip(piece, chosen) if c[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [("".join(f"{j:02x}" for _, j in c), sum(d for d, _ in c)) for c in assigned()]
    by_label = collections.Counter()
    for r, (_, error) in zip(kept, coded):
        by_label[r[2]] += error
    cap = 2**63 - 1
    return collections.Counter(
        (r[0], code, min(error, cap), min(by_label[r[2]], cap), digest) for r, (code, error) in zip(kept, coded)
    )


def found(spark, df, **options) -> collections.Counter:
    made = V.VectorCodes(V.whole_vectors(df), **options)
    rows = V.with_label_errors(made.encode(spark)).collect()
    return collections.Counter((r["vec_id"], r["code"], r["error"], r["label_error"], made.digest()) for r in rows)


def drawn(n: int, width: int, seed: int = 1, spread: float = 0.2) -> list[tuple]:
    draw = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in draw.normal(0, spread, width)], int(i) % 3 or None) for i in draw.permutation(n)]


def awkward() -> list[tuple]:
    rows = drawn(60, 16)
    rows += [rows[3], rows[3], (5, None, 1), (6, [], 1), (7, [float("nan")] * 16, 1), (8, [None] + [0.0] * 15, 1)]
    rows += [(9, [float("inf")] + [0.0] * 15, 1), (None, [0.25] * 16, None), (10, [1.0] * 8, 1), (11, [-0.0] * 16, 2), (12, [1e30] * 16, 2)]
    return rows


def test_equals_brute_force(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(spark, df) == expected(rows)
    clashing = df.withColumns({c: F.lit(-1) for c in ("v", "code", "error", "part", "entry", "total", "values", "_key")})
    assert found(spark, clashing) == expected(rows)


@pytest.mark.parametrize("rows", [drawn(7, 16), drawn(40, 13), drawn(30, 3), [(1, [0.5] * 8, 1)], [(1, None, 1)], []])
def test_few_vectors_and_odd_lengths(spark, rows):
    assert found(spark, spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_numbers_beyond_64_bits(spark):
    rows = drawn(40, 16, spread=1e6) + [(i, [float(np.float32(x * 10.0**(i - 39))) for x in range(-8, 8)], 7) for i in range(40, 64)]
    rows = [(i, [x for x in v], label) for i, v, label in rows]
    assert found(spark, spark.createDataFrame(rows, SCHEMA), rounds=2) == expected(rows, rounds=2)
    rows = drawn(30, 16, spread=1e13) + drawn(30, 16, seed=2, spread=1e18)
    assert found(spark, spark.createDataFrame(rows, SCHEMA), rounds=2) == expected(rows, rounds=2)


def test_query(spark):
    got = collections.Counter(tuple(r) for r in V.op13_vector_codes(spark, SMOKE).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got == expected(rows)
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from read_parquet('{SMOKE}/embeddings.parquet')")
    assert got == collections.Counter(connection.execute(V.OP13_SQL).fetchall())
