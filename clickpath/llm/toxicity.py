"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A lower-cased word is a bag of its character n-grams (bytes, with a mark at either end) and of itself,
each hashed into ``BUCKETS`` rows of an embedding. A word is the mean of its bag, a text the mean of its
words and of ``NEUTRAL`` words without meaning, and a softmax over two classes is linear in that. Embedding and softmax are trained jointly in numpy
by gradient descent. A word with letters changed keeps most of its n-grams and so most of its meaning.

A text's mean is a sparse vector of bucket weights, whatever its length. Tasks compute these for at most
``SAMPLE`` labelled rows (those with the smallest seeded hash of their ids), the driver fits, and a tenth
of the rows is held back to choose the best step. As the model is linear, one number per bucket scores all
texts: a word's score is the mean over its bag, a text's the mean over its words.

Cases: null, empty and blank texts have no words and score by the bias alone; documents without a label
or with a null one are not learned from; without labels of both kinds all texts score the share of toxic
ones (0 without any); rows with the same doc_id each keep their score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
DIMENSIONS = 4
SAMPLE = 2400
# entries of the sample that are worked on at once
SLICE = 1 << 19
STEPS = 50
STEP = 2.0
MOMENTUM = 0.5
# the step is halved after so many
SLOWS = 4
BLEND = 0.15
# a bucket's steps are damped as if it had been seen in this many more texts
DAMPED = 10.0
THRESHOLD = 0.3
# neutral words that every text is averaged with, so that a few rare words decide less
NEUTRAL = 30

_EDGE = np.uint8(0)


def training_rows(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def _bags(words: W.Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words ``of``, one bag after the other, and how many each has."""
    length = words.end[of] - words.begin[of]
    starts = np.cumsum(length + 2) - (length + 2)
    padded = np.full(int((length + 2).sum()), _EDGE, dtype=np.uint8)
    padded[W.pieces(length, starts + 1)] = words.data[W.pieces(length, words.begin[of])]
    counts = [np.ones(len(of), dtype=np.int64)] + [np.maximum(length + 2 - n + 1, 0) for n in SIZES]
    begin = [starts] + [W.pieces(c, starts) for c in counts[1:]]
    end = [starts + length + 2] + [b + n for b, n in zip(begin[1:], SIZES)]
    word = np.concatenate([np.repeat(np.arange(len(of)), c) for c in counts])
    hashes = W.range_hashes(padded, np.concatenate(begin), np.concatenate(end), W._BYTE_BASE)
    order = np.argsort(word, kind="stable")
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int64), sum(counts)


def _kinds(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct word, and the distinct word of each place."""
    coded = pa.array(W.word_hashes(words)).dictionary_encode()
    index = coded.indices.to_numpy()
    first = np.zeros(len(coded.dictionary), dtype=np.int64)
    first[index[::-1]] = np.arange(len(index))[::-1]
    return first, index


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's bucket weights, packed, with its label."""
    for batch in batches:
        done, out = 0, []
        for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
            kinds, index = _kinds(words)
            buckets, size = _bags(words, kinds)
            at = np.cumsum(size) - size
            for lo, hi in zip(words.first[:-1], words.first[1:]):
                mine, times = np.unique(index[lo:hi], return_counts=True)
                weight = np.repeat(times / (size[mine] * (hi - lo + NEUTRAL)), size[mine])
                found, back = np.unique(buckets[W.pieces(size[mine], at[mine])], return_inverse=True)
                value = np.bincount(back, weights=weight, minlength=len(found))
                out.append(found.astype("<i4").tobytes() + value.astype("<f4").tobytes())
            done += len(words.first) - 1
        yield pa.record_batch([pa.array(out, pa.binary()), batch.column("label")], names=["vector", "label"])


def _slices(starts: np.ndarray, total: int) -> Iterator[tuple[slice, np.ndarray, int, int]]:
    """Runs of whole segments with about ``SLICE`` entries: which, where they start in the run, and the run's ends."""
    ends = np.append(starts[1:], total)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        yield slice(i, j), starts[i:j] - starts[i], int(starts[i]), int(ends[j - 1])
        i = j


@dataclass
class Sample:
    """Sparse rows: bucket and weight of each entry, where rows start, and their labels."""

    bucket: np.ndarray
    weight: np.ndarray
    starts: np.ndarray
    label: np.ndarray

    @staticmethod
    def of(vectors: list[bytes], labels: np.ndarray) -> Sample:
        n = np.array([len(v) // 8 for v in vectors], dtype=np.int64)
        bucket = np.concatenate([np.frombuffer(v, "<i4", m) for v, m in zip(vectors, n)])
        weight = np.concatenate([np.frombuffer(v, "<f4", m, 4 * m) for v, m in zip(vectors, n)])
        return Sample(bucket, weight, np.concatenate([[0], np.cumsum(n)]), labels)

    def means(self, embedding: np.ndarray) -> np.ndarray:
        """The rows' mean embeddings; ``embedding`` has a row per dimension."""
        out = np.zeros((len(self.label), len(embedding)))
        some = np.flatnonzero(np.diff(self.starts) > 0)
        for at, heads, lo, hi in _slices(self.starts[some], len(self.bucket)):
            for d, column in enumerate(embedding):
                out[some[at], d] = np.add.reduceat(column[self.bucket[lo:hi]] * self.weight[lo:hi], heads)
        return out


@dataclass
class Model:
    """Score of each bucket (class 1 against class 0) and the bias."""

    buckets: np.ndarray
    bias: float


def fit(sample: Sample, steps: int = STEPS, seed: int = 1) -> Model:
    toxic = sample.label.mean() if len(sample.label) else 0.0
    if not 0 < toxic < 1 or not len(sample.bucket):
        return Model(np.zeros(BUCKETS), float(np.clip(np.log(max(toxic, 1e-18) / max(1 - toxic, 1e-18)), -40, 40)))
    draw = np.random.default_rng(seed)
    n = len(sample.label)
    held = draw.permutation(n) < max(1, n // 10)
    target = np.stack([sample.label == 0, sample.label == 1], axis=1)
    share = (~held)[:, None] / max(1, (~held).sum())
    by_bucket = np.argsort(sample.bucket, kind="stable")
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(sample.starts))[by_bucket]
    weights, buckets = sample.weight[by_bucket], sample.bucket[by_bucket]
    heads = np.flatnonzero(np.diff(buckets, prepend=-1))
    used = buckets[heads]
    del by_bucket, buckets
    # gradients of buckets that many texts share grow with the number of texts, noise with its root
    squares = np.add.reduceat(weights.astype(np.float64) ** 2, heads)
    scale = (1 / np.sqrt(squares + DAMPED * np.mean(sample.weight.astype(np.float64) ** 2))).astype(np.float32)
    embedding = draw.normal(0, 0.1, (DIMENSIONS, BUCKETS)).astype(np.float32)
    softmax = draw.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.log([1 - toxic, toxic])
    moved, turned = np.zeros_like(embedding), np.zeros_like(softmax)
    average = np.zeros(BUCKETS + 1)
    best, kept = np.inf, Model(np.zeros(BUCKETS), float(bias[1] - bias[0]))
    for turn in range(steps):
        step = STEP / (1 + turn / SLOWS)
        mean = sample.means(embedding)
        logits = mean @ softmax + bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        # the mean of the last steps is steadier than any of them
        difference = softmax[:, 1] - softmax[:, 0]
        average += (np.concatenate([difference @ embedding, [bias[1] - bias[0]]]) - average) * max(BLEND, 1 / (turn + 1))
        odds = sample.means(average[None, :-1])[held, 0] + average[-1]
        loss = np.logaddexp(0, np.where(target[held, 1], -odds, odds)).mean()
        if loss < best:
            best, kept = loss, Model(average[:-1].copy(), float(average[-1]))
        off = (p - target) * share
        to_rows = (softmax @ off.T).astype(np.float32)
        gradient = np.zeros_like(embedding)
        for at, first, lo, hi in _slices(heads, len(rows)):
            for d in range(DIMENSIONS):
                gradient[d, used[at]] = scale[at] * np.add.reduceat(to_rows[d][rows[lo:hi]] * weights[lo:hi], first)
        moved = MOMENTUM * moved - step * gradient / max(np.abs(gradient).max(), 1e-30)
        to_softmax = mean.T @ off
        turned = MOMENTUM * turned - 0.1 * to_softmax / max(np.abs(to_softmax).max(), 1e-30)
        embedding += moved
        softmax += turned
        bias -= off.sum(axis=0)
    return kept


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    scores = []
    for words in W.word_groups(W.as_binary(texts), lower=True):
        kinds, index = _kinds(words)
        buckets, size = _bags(words, kinds)
        total = np.concatenate([[0.0], np.cumsum(model.buckets[buckets])])
        ends = np.cumsum(size)
        each = ((total[ends] - total[ends - size]) / np.maximum(size, 1))[index]
        run = np.concatenate([[0.0], np.cumsum(each)])
        mean = (run[words.first[1:]] - run[words.first[:-1]]) / (words.counts() + NEUTRAL)
        scores.append(1 / (1 + np.exp(-np.clip(mean + model.bias, -40, 40))))
    return np.concatenate(scores) if scores else np.zeros(0)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A function of a text column: the probability that a text is toxic."""

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        return pa.array(_scores(model, texts), pa.float64())

    return toxic


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, seed: int = 1) -> Model:
    """Fit on at most ``most`` rows (doc_id, text) that have a label (doc_id, label) of 0 or 1."""
    # the smallest hashes first, so that the sample does not depend on how the table is dealt
    known = labels.select(F.col("doc_id").alias("labelled"), F.col("label").cast("int").alias("label"))
    known = known.where("labelled is not null and label in (0, 1)").groupBy("labelled").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "labelled"), "labelled").limit(most)
    # at most ``most`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    vectors = rows.select("doc_id", "text", "label").repartition(8, "doc_id").select("text", "label").mapInArrow(
        _vectors, "vector binary, label int"
    )
    # rows come in any order; the sums of the fit should not
    rows = sorted(zip(*vectors.toArrow().to_pydict().values()))
    if not rows:
        return Model(np.zeros(BUCKETS), -40.0)
    sample = Sample.of([vector for vector, _ in rows], np.array([label for _, label in rows]))
    del rows
    return fit(sample)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    return docs.select("doc_id", scorer(model)(F.col("text")).alias("score"))


def learn_from_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labels' training rows."""
    known = labels.where(training_rows(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    return learn(docs, known)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, learn_from_labels(docs, labels)).select(
        "doc_id",
        (~training_rows(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
