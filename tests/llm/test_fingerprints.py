from __future__ import annotations

import pytest
import xxhash
from pyspark.sql import functions as F

from clickpath.llm import fingerprints
from . import brute
from .conftest import SMOKE, edited, pairs, prose


def likeness_of(spark, rows: list[tuple]) -> list[float]:
    df = spark.createDataFrame(rows, "a string, b string")
    both = df.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"))
    return [r[0] for r in both.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()]


def test_query_on_all_documents(spark, smoke):
    rows = {r["doc_id"]: r for r in fingerprints.op5_fingerprints(spark, SMOKE).collect()}
    docs = sorted(pairs(smoke))
    off = []
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = rows.pop(doc_id)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == brute.sha(changed)
        for near, other in ((r["near_edited"], changed), (r["near_next"], following)):
            a, b = brute.shingles(text, lower=False), brute.shingles(other, lower=False)
            off.append(near - len(a & b) / max(1, len(a | b)))
    assert not rows
    assert max(map(abs, off)) < 0.2 and abs(sum(off) / len(off)) < 0.02


@pytest.mark.parametrize("table", ["awkward", "clashing"])
def test_awkward_rows(request, table):
    df = request.getfixturevalue(table)
    rows = fingerprints.edited_halves(df).collect()
    assert len(rows) == df.count()
    distinct = sorted({(d is not None, d or 0, t) for d, t in pairs(df)}, key=repr)
    ends = {(t or "")[: len(t or "") - len(t or "") // 2] for _, _, t in distinct}
    assert all(any(r["edited"].startswith(e) for e in ends) for r in rows)
    assert {r["n_chars"] for r in rows} == {len(t or "") for _, _, t in distinct}


def test_one_document_follows_itself(spark):
    (row,) = fingerprints.edited_halves(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert row["edited"] == "abab" and row["bins"] == row["next_bins"]


def test_nothing(nothing):
    assert fingerprints.edited_halves(nothing).collect() == []


def test_likeness(spark):
    text = prose(1, 500)
    got = likeness_of(spark, [(text, text), ("", ""), (None, " "), ("", text), (text, prose(2, 500)), ("one two", "one two"), ("one", "two")])
    assert got[:4] == [1.0, 1.0, 1.0, 0.0] and got[4] < 0.05 and got[5] == 1.0 and got[6] < 0.1


def test_likeness_follows_the_share_of_shingles(spark):
    texts = [(prose(s, n), edited(prose(s, n), every)) for s in range(8) for n in (60, 300, 1500) for every in (10, 40, 200)]
    got = likeness_of(spark, texts)
    off = []
    for (a, b), near in zip(texts, got):
        a, b = brute.shingles(a, lower=False), brute.shingles(b, lower=False)
        off.append(near - len(a & b) / len(a | b))
    assert abs(sum(off) / len(off)) < 0.03 and max(map(abs, off)) < 0.2


def test_fingerprints_are_packed(spark):
    df = spark.createDataFrame([("a b c d e f",), ("",)], "t string")
    got = [r[0] for r in df.select(fingerprints.packed(fingerprints.fingerprint(F.col("t")))).collect()]
    assert len(got[0]) == fingerprints.BINS * fingerprints.LOW_BITS // 4 and int(got[0], 16) and got[1] == ""


def plain_fingerprint(text: str | None) -> str:
    """One permutation, minima by bin, empty bins filled by asking others, low bits as hex digits; whole numbers only."""

    def chained(values, seed: int = 42) -> int:
        for v in values:
            seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else v.to_bytes(8, "little"), seed=seed)
        return seed

    words = [chained([w.encode()]) for w in brute.words(text)]
    if not words:
        return ""
    cuts = [words[i : i + 5] for i in range(len(words) - 4)] or [words]
    minima = {}
    for h in map(chained, cuts):
        minima[h >> 57] = min(h, minima.get(h >> 57, h))
    out = ""
    for j in range(128):
        asked = j
        if j not in minima:
            seed = chained([j.to_bytes(4, "little")])
            step, shift = seed & 127 | 1, seed >> 32
            asked = next(a for a in ((step * t + shift) & 127 for t in range(128)) if a in minima)
        out += f"{minima[asked] & 255:02x}"
    return out


@pytest.mark.parametrize("table", ["awkward", "smoke"])
def test_fingerprints_equal_plain_ones(request, table):
    df = request.getfixturevalue(table)
    rows = df.select("text", fingerprints.packed(fingerprints.fingerprint(F.col("text"))).alias("f")).collect()
    assert [r["f"] for r in rows] == [plain_fingerprint(r["text"]) for r in rows]
