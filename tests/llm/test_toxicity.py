from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import toxicity
from . import brute
from .conftest import SMOKE, prose

BAD = ["wretched", "blockhead", "nincompoop"]


def planted(n: int, bad: list[str], seed: int, first: int = 0) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        w = prose(seed * 10_000 + i, draw.randint(30, 200)).split(" ")
        if i % 4 == 0:
            for _ in range(max(2, len(w) // 40)):
                w.insert(draw.randrange(len(w)), draw.choice(bad))
        rows.append((first + i, " ".join(w), int(i % 4 == 0)))
    return rows


def test_unseen_misspellings_are_found(spark):
    docs = spark.createDataFrame(planted(800, BAD, 1), "doc_id long, text string, label int")
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    other = planted(200, ["wretchedd", "bl0ckhead", "nincompooop"], 2)
    scored = toxicity.score(spark.createDataFrame(other, "doc_id long, text string, label int"), model)
    score = {r["doc_id"]: r["score"] for r in scored.collect()}
    toxic, clean = ([score[i] for i, _, y in other if y == label] for label in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9
    assert np.mean(np.array(clean) >= 0.3) < 0.05


@pytest.mark.parametrize("table", ["awkward", "clashing", "nothing"])
def test_awkward_rows(request, spark, table):
    df = request.getfixturevalue(table)
    labels = [(4, 1, 1), (7, 1, 0), (7, 1, 0), (None, 1, 1), (16, 0, None), (999, 1, 1), (12, 0, 0), (2, 1, 0), (14, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn_from_labels(df, labels)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == df.count()
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_without_labels_nothing_is_toxic(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score(awkward, toxicity.learn_from_labels(awkward, labels)).collect()
    assert len(rows) == awkward.count() and all(r["score"] < 1e-6 for r in rows)


def test_held_out_labels_do_not_matter(spark, smoke):
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.training_rows(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.learn_from_labels(smoke, x) for x in (labels, turned))
    assert a.bias == b.bias and (a.buckets == b.buckets).all()


def test_query(spark, smoke):
    rows = toxicity.op9_toxicity(spark, SMOKE).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in smoke.collect())
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def plain_score(text: str | None, model: toxicity.Model) -> float:
    """The score from bytes and whole numbers: words, their bags, the mean of means."""
    mask = 2**64 - 1

    def bucket(part: bytes) -> int:
        total = sum((b + 1) * pow(toxicity.W._BYTE_BASE, i, 2**64) for i, b in enumerate(part)) + len(part) * toxicity.W._OTHER_BASE
        h = total & mask
        h ^= h >> 32
        h = h * 0xD6E8FEB86659FD93 & mask
        h ^= h >> 32
        h = h * 0xD6E8FEB86659FD93 & mask
        return (h ^ h >> 32) % toxicity.BUCKETS

    total, words = 0.0, brute.words((text or "").translate(brute.LOWER))
    for word in words:
        marked = b"\0" + word.encode() + b"\0"
        bag = [marked] + [marked[i : i + n] for n in toxicity.SIZES for i in range(len(marked) - n + 1)]
        total += sum(model.buckets[bucket(part)] for part in bag) / len(bag)
    return 1 / (1 + np.exp(-np.clip(total / (len(words) + toxicity.NEUTRAL) + model.bias, -40, 40)))


def test_scores_equal_plain_ones(spark, smoke, awkward):
    model = toxicity.learn_from_labels(smoke, spark.read.parquet(f"{SMOKE}/labels.parquet"))
    rows = awkward.where("doc_id is null or doc_id <> 19").select("doc_id", "text").collect()
    rows += smoke.where("doc_id < 30").select("doc_id", "text").collect()
    df = spark.createDataFrame([(i, r["text"]) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx([plain_score(r["text"], model) for r in rows], abs=1e-9)


def test_gradient_steps_lower_the_loss():
    """Two rows of one bucket each: the fit tells them apart."""
    vectors = [np.array([b], "<i4").tobytes() + np.array([0.5], "<f4").tobytes() for b in (3, 9)] * 20
    model = toxicity.fit(toxicity.Sample.of(vectors, np.array([0, 1] * 20)))
    assert model.buckets[9] > 0 > model.buckets[3]
