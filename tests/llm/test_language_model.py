from __future__ import annotations

import collections
import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import language_model as lm
from clickpath.storage import stored
from . import brute
from .conftest import SMOKE, pairs


def tokens(text: str | None) -> list:
    return brute.words((text or "").translate(brute.LOWER)) + [None]


def is_training(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


@pytest.mark.parametrize("table", ["awkward", "clashing", "smoke", "nothing"])
def test_counts_and_base(request, table):
    df = request.getfixturevalue(table)
    rows = lm.score_documents(df, lm.training_rows(F.col("doc_id")), rounds=2).collect()
    docs = pairs(df)
    counts = collections.Counter(t for d, text in docs if is_training(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        want.append((d, not is_training(d), len(own), sum(counts[t] > 0 for t in own), n, round(base, 4)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_better_than_the_base_on_held_out_texts(spark):
    rows = [r for r in lm.op4_lm_scoring(spark, SMOKE).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_classes_have_probabilities():
    model = lm.Weights()
    model.rows = np.random.default_rng(1).normal(0, 1, model.rows.shape)
    for before in (0, 5, lm.CLASSES):
        assert np.exp(model.log_probabilities(before)).sum(axis=1) == pytest.approx(np.ones(lm.CONTEXTS))


def test_tokens_of_a_class_sum_to_one():
    counts = np.array([1, 1, 1, 2, 2, 5, 9])
    sums, kinds = np.zeros(lm.SUFFIXES, int), np.zeros(lm.SUFFIXES, int)
    sums[3], kinds[3] = counts.sum(), len(counts)
    discount = np.full(lm.SUFFIXES, (3 + 1) / (3 + 2 * 2 + 2))
    made = lm.Vocabulary(100, 10, sums, kinds, discount, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    known = made.within_class(np.full(7, lm.TOP + 3), counts.astype(float))
    unknown = made.within_class(np.array([lm.TOP + 3]), np.zeros(1))
    assert (10**known).sum() + (10**unknown).sum() == pytest.approx(1)
    assert made.within_class(np.array([0, lm.TOP + 4]), np.zeros(2)).tolist() == [0, 0]


def test_gradient_steps_reach_the_counts(spark):
    """With one context seen often, its probabilities become the shares."""
    counts = np.zeros((lm.CONTEXTS, lm.CLASSES), dtype=np.int64)
    counts[4, [1, 2, 3]] = [6000, 3000, 1000]
    at = np.flatnonzero(counts.ravel())
    raw = at.astype("<i4").tobytes() + counts.ravel()[at].astype("<i8").tobytes()
    table = spark.createDataFrame([(7, 0, bytearray(raw))], "before int, part int, payload binary")
    p = np.exp(lm.train(table, rounds=30).log_probabilities(7)[4])
    assert p[[1, 2, 3]] == pytest.approx([0.6, 0.3, 0.1], abs=0.02)


def test_word_pairs_and_skips_outside_the_top_change_scores(spark):
    """Four rare words of one class, the same counts of tokens and classes, other neighbours."""
    filler = [" ".join(f"w{i}{j}x" for j in range(10)) for i in range(12)] * 5
    near = lambda a, b, c, d: [f"{a} {b}"] * 3 + [f"{c} {d}"] * 3
    skip = lambda a, b, c, d: [f"{a} w00x {b}"] * 3 + [f"{c} w00x {d}"] * 3

    def score(texts: list[str], asked: str) -> float:
        rows = [(i, t, True) for i, t in enumerate(filler + texts)] + [(-1, asked, False)]
        df = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
        (row,) = lm.score_documents(df.select("doc_id", "text", "t"), F.col("t"), rounds=2).where("doc_id = -1").collect()
        return row["score"]

    for made, asked in ((near, "aaqqq bbqqq"), (skip, "aaqqq w00x bbqqq")):
        assert score(made("aaqqq", "bbqqq", "ccqqq", "ddqqq"), asked) > score(made("aaqqq", "ddqqq", "ccqqq", "bbqqq"), asked) + 0.05


def test_word_features_keep_the_sum():
    counts = np.array([[10.0] * 4, [6, 3, 1, 0], [4.0] * 4, [0, 4, 0, 0]])
    assert lm.with_words(np.array([0.4, 0.3, 0.2, 0.1]), counts).sum() == pytest.approx(1)
    assert lm.with_words(np.array([0.4, 0.6]), np.zeros((4, 2))) == pytest.approx([0.4, 0.6])


def test_word_features_are_told_apart():
    hashes = np.arange(1, 9, dtype=np.uint64)
    classes = np.array([lm.TOP, lm.TOP, 3, lm.TOP, lm.TOP + 1, lm.TOP, lm.TOP, lm.TOP])
    at, keys = lm._word_features(hashes, classes, np.array([0, 4]))
    assert at.tolist() == [0, 1, 3, 4, 5, 6, 7] and keys.shape == (4, 7)
    # tokens 0, 1 and 5 have one class and the start of a document two words before
    assert len(np.unique(keys)) == keys.size - 2


def test_packed_slots_come_back():
    draw = np.random.default_rng(2)
    for unused in (0, 20, 63):
        keys = np.unique(draw.integers(0, 2**64, 500, dtype=np.uint64) >> np.uint64(unused) << np.uint64(unused))
        for some in (keys, keys[:1], keys[:0]):
            raw = lm._slots(some, np.uint64(unused)) + lm._packed(np.arange(len(some)) * 999)
            got, at = lm._keys(raw, np.uint64(unused))
            assert got.tolist() == some.tolist() and lm._unpack(raw, at)[0].tolist() == (np.arange(len(some)) * 999).tolist()


def test_word_features_take_few_bytes():
    """Slots at a mean distance of 5,700, as in half a GB, need 14 bits by entropy."""
    draw = np.random.default_rng(3)
    unused = np.uint64(31)
    keys = np.cumsum(1 + draw.geometric(1 / 5700, 50_000).astype(np.uint64), dtype=np.uint64) << unused
    counts = np.where(draw.random(len(keys)) < 0.95, 1, 2)
    (raw,) = lm._sent([(0, 0, lm._slots(keys, unused) + lm._packed(counts))]).column("payload").to_pylist()
    assert len(raw) < 2 * len(keys)
    got, at = lm._keys(lm._opened(raw), unused)
    assert got.tolist() == keys.tolist() and lm._unpack(lm._opened(raw), at)[0].tolist() == counts.tolist()


def test_differences_come_back():
    """Also of hashes in no order, whose differences are below zero."""
    values = np.array([5, 2**64 - 1, 0, 7, 7, 1 << 63], dtype=np.uint64)
    for some in (values, values[:1], values[:0]):
        assert lm._summed(lm._differences(some)).tolist() == some.tolist()
        assert lm._opened(lm._squeezed(some.tobytes())) == some.tobytes()


def test_shuffles_of_stored_rows_are_removed(spark):
    """At once, and only where it is asked for; the session's setting stays as it was."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffles() -> set[str]:
        return set(re.findall(r"shuffle_\d+", blocks.getAllFiles().mkString(" ")))

    rows, setting = spark.range(1000).repartition(3, "id"), spark.conf.get(name, None)
    before = shuffles()
    assert stored(rows, "kept").count() == 1000 and shuffles() - before
    before = shuffles()
    table = stored(rows, "released", release=True)
    by = time.monotonic() + 10
    while shuffles() - before and time.monotonic() < by:
        time.sleep(0.1)
    assert not shuffles() - before and table.count() == 1000
    assert spark.conf.get(name, None) == setting


def plain_scores(docs: list[tuple], rounds: int) -> list[tuple]:
    """(doc_id, score) from counts in dictionaries and dense steps, one token after the other."""
    texts = [(d, is_training(d), [None if t is None else t.encode() for t in tokens(text)]) for d, text in docs]
    counts = collections.Counter(t for _, trains, own in texts if trains for t in own)

    def hash_of(t) -> int:
        if t is None:
            return int(lm.END)
        (words,) = lm.W.word_groups(lm.W.as_binary(lm.pa.array([t])), lower=True)
        return int(lm.W.word_hashes(words)[0])

    def suffix_of(t) -> int:
        tail = 0
        for back in (1, 2, 3):
            tail = (tail * 257 + (t[-back] + 1 if back <= len(t) else 0)) % 2**64 if t is not None else 0
        return int(lm.W.mixed(np.array([tail], dtype=np.uint64))[0] % lm.SUFFIXES) if t is not None else 0

    signed = lambda h: h - (h >> 63 << 64)
    every = {t for _, _, own in texts for t in own}
    hashes, suffix = {t: hash_of(t) for t in every}, {t: suffix_of(t) for t in every}
    top = {t: i for i, t in enumerate(sorted(counts, key=lambda t: (-counts[t], signed(hashes[t])))[: lm.TOP])}
    cls = {t: top.get(t, lm.TOP + suffix[t]) for t in every}
    of_class = collections.defaultdict(list)
    for t in counts:
        if t not in top:
            of_class[cls[t]].append(counts[t])

    def within(t) -> float:
        seen = of_class[cls[t]]
        if t in top or not seen:
            return 1.0
        once, twice = seen.count(1), seen.count(2)
        discount = (once + 1) / (once + 2 * twice + 2)
        return (counts[t] - discount if counts[t] else discount * len(seen)) / sum(seen)

    def places(own):
        for i, t in enumerate(own):
            one, two = (own[i - 1] if i else "start"), (own[i - 2] if i > 1 else "start")
            yield t, one, two

    none = lm.CLASSES
    grid = np.zeros((lm.CONTEXTS, lm.CONTEXTS, lm.CLASSES))
    features = collections.Counter()
    for _, trains, own in texts:
        for t, one, two in places(own) if trains else ():
            grid[cls.get(one, none), cls.get(two, none), cls[t]] += 1
            if t not in top:
                for step, before in ((2, two), (1, one)):
                    features[step, before, cls[t]] += 1
                    features[step, before, cls[t], t] += 1
    model = lm.Weights()
    for turn in range(rounds):
        seen, wanted = np.zeros_like(model.rows), np.zeros_like(model.rows)
        for before in np.flatnonzero(grid.any(axis=(1, 2))):
            p = np.exp(model.log_probabilities(before))
            for two in np.flatnonzero(grid[before].any(axis=1)):
                for row in model.features(before)[:, two]:
                    seen[row] += grid[before, two]
                    wanted[row] += grid[before, two].sum() * p[two]
        if turn == 0:
            model.rows[0] = np.log(seen[0] + 1) - np.log(seen[0].sum() + lm.CLASSES)
        else:
            model.rows += lm.STEP * np.clip((seen - wanted) / (wanted + lm.SMOOTH), -1, 1)
    logs = {c: model.log_probabilities(c) for c in range(lm.CONTEXTS)}
    out = []
    for d, _, own in texts:
        score = 0.0
        for t, one, two in places(own):
            score += logs[cls.get(one, none)][cls.get(two, none), cls[t]] / math.log(10)
            p = within(t)
            if t not in top:
                for prior, step, before in ((lm.SKIP_PRIOR, 2, two), (lm.PAIR_PRIOR, 1, one)):
                    p = (features[step, before, cls[t], t] + prior * p) / (features[step, before, cls[t]] + prior)
            score += math.log10(p)
        out.append((d, score))
    return out


@pytest.mark.parametrize("table", ["awkward", "smoke"])
def test_scores_equal_plain_ones(request, monkeypatch, table):
    """With so many slots that no two features share one."""
    monkeypatch.setattr(lm, "SLOTS", 1 << 40)
    df = request.getfixturevalue(table).where("doc_id is null or doc_id <> 19")
    got = sorted(((r["doc_id"], r["score"]) for r in lm.score_documents(df, lm.training_rows(F.col("doc_id")), rounds=4).collect()), key=repr)
    want = sorted(plain_scores(pairs(df), 4), key=repr)
    assert [d for d, _ in got] == [d for d, _ in want]
    # gradients travel as 32-bit numbers
    for (_, a), (_, b) in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(want, key=lambda r: (str(r[0]), r[1]))):
        assert a == pytest.approx(b, rel=1e-4, abs=1e-3)


def test_scores_do_not_depend_on_chunks_and_buckets(spark, monkeypatch, smoke):
    """Many tasks, several chunks a task and several buckets give the scores of one chunk."""

    def scores(df) -> list:
        rows = lm.score_documents(df, lm.training_rows(F.col("doc_id")), rounds=2).collect()
        return sorted((r["doc_id"], r["n_known"], round(r["base_score"], 6), round(r["score"], 3)) for r in rows)

    monkeypatch.setattr(lm, "SLOTS", 1 << 40)
    whole = scores(smoke.coalesce(1))
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 1)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert scores(smoke.repartition(3)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
