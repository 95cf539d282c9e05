"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are lower-cased words and an end per document. The ``TOP`` most frequent ones are classes of
their own, all others share the class of their last three bytes. The model gives
``p(token | context) = p(class | context) * p(token | class, words before)``:

* ``p(class | context)`` is a softmax over the sum of weights of the context's features: a bias, the
  class of the word before, the class of the word before that (a skip feature), and both together,
  hashed into ``HASHED`` rows. Contexts are pairs of classes, so their number does not depend on the corpus.
* ``p(token | class)`` is the softmax of ``log(count - d)`` over the class' tokens and of ``log(d * types)`` for
  the one unknown token of the class. The discount d comes from the numbers of tokens seen once and twice.
* ``p(token | class, words before)`` adds what was counted of words: how often the token followed the word before
  it (``PAIR_PRIOR``), and the word before that (a skip feature, ``SKIP_PRIOR``). It is the softmax over the class of
  ``log(count of feature and token + prior * p)``, with p the distribution without that feature, starting at
  ``p(token | class)``; its normalizer is the count of the feature in the class plus the prior.

Word features are hashed into slots, ``SLOTS`` for each training token or up to twice as many, so the table of their
counts grows with the corpus and a feature shares its slot with a chance below 4 / ``SLOTS``. Counts are a Spark table over
all training documents, by bucket of slots as those of tokens; each chunk gets back those of its own features. Slots are sent
as differences of neighbours, counts in as many bytes as the largest needs, both compressed with entropy coding. Shuffles whose
rows have been written are removed at once, so that what lies on disk does not hang on the driver's garbage collection.

Words are found and hashed once: each scan task writes its documents as chunks of about ``CHUNK_TOKENS`` tokens, a table of
token hashes and of each token's place among them, the frequent ones first. All later steps read that table; texts are
never shuffled. Counting covers all training documents: token counts go through buckets of hashes (``chunks``), class
trigrams through folded sums. Training takes steps along the gradient; the rows of contexts are spread
over tasks, each sends the gradient of its rows, and weights of fixed size go back. Scoring looks up, for
each chunk of documents, the counts of its tokens and word features and the context's log probabilities.
A document is never split: one longer than a chunk is a chunk of its own, in the memory of one task.

Cases: null text counts as empty and has one token, the end; rows with the same doc_id are documents of
their own; without training documents all classes are alike; an empty table gives an empty one. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

from . import chunks as C
from . import words as W

TOP = 96
SUFFIXES = 32
CLASSES = TOP + SUFFIXES
HASHED = 1024
ROUNDS = 16
STEP = 0.3
SMOOTH = 4.0

# the end of a document; no word hash is reserved for it, as words have 64 bits
END = np.uint64(0x1F83D9ABFB41BD6B)
# context classes have one more, for places before the first word
CONTEXTS = CLASSES + 1
# weight of the distribution without a word feature, in tokens: of the word before, of the one before that
PAIR_PRIOR = 4.0
SKIP_PRIOR = 16.0
# the word before the first one of a document
START = np.uint64(0x5BE0CD19137E2179)
_FEATURE_BASE = np.uint64(0x9FB21C651E98DF25)
# slots of word features for each training token, at the least
SLOTS = 64
# rows of packed counts that one task adds up
FOLD = 64

# of each suffix class: tokens, types, types seen once, types seen twice
SUMS = 4
# tokens after which a chunk is closed, and tokens of the corpus to a bucket: one task holds the word features of either
CHUNK_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 20
TOKENS = "chunk bigint, n bigint, doc_id array<bigint>, training array<boolean>, size array<bigint>, hashes binary, suffix binary, ids binary"
SENT = "chunk bigint, bucket int, payload binary"
COUNTED = "chunk bigint, bucket int, payload binary, sums array<bigint>, top array<struct<hash: bigint, n: bigint, suffix: int>>"


def training_rows(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def _tokens(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and suffix class of every token, ends included, and where each text starts."""
    n, docs = len(words.begin), len(words.first) - 1
    text = np.repeat(np.arange(docs), words.counts())
    at, ends = np.arange(n) + text, words.first[1:] + np.arange(docs)
    hashes = np.empty(n + docs, dtype=np.uint64)
    hashes[at], hashes[ends] = W.word_hashes(words), END
    tail = np.zeros(n, dtype=np.uint64)
    for back in (1, 2, 3):
        inside = words.end - back >= words.begin
        tail = tail * np.uint64(257) + np.where(inside, words.data[np.maximum(words.end - back, 0)] + np.uint64(1), np.uint64(0))
    suffix = np.zeros(n + docs, dtype=np.uint8)
    suffix[at] = W.mixed(tail) % np.uint64(SUFFIXES)
    return hashes, suffix, words.first[:-1] + np.arange(docs)


def _packed(values: np.ndarray) -> bytes:
    """Values as their number, the bytes that the largest needs, and these bytes by place, so that those that are alike compress."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    return len(values).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def _unpack(raw: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """Packed values, and where they end."""
    n, width = int.from_bytes(raw[at : at + 8], "little"), raw[at + 8]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 9).reshape(width, n).T
    return out.view("<u8").ravel(), at + 9 + n * width


def _differences(values: np.ndarray) -> np.ndarray:
    """Each value less the one before, modulo 2**64; the first as it is. ``_summed`` undoes it."""
    return np.diff(values, prepend=np.uint64(0))


def _summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _squeezed(raw: bytes) -> bytes:
    """Bytes as their number and themselves in Zstandard's form, whose entropy coding the codecs of tables and shuffles may lack."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(raw: bytes) -> bytes:
    return pa.decompress(memoryview(raw)[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, bucket, payload = zip(*rows)
    return pa.record_batch([pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(map(_squeezed, payload), pa.binary())],
                           names=["chunk", "bucket", "payload"])


def _tokenized(most: int):
    """A task's documents as chunks of up to ``most`` tokens where documents allow it: rows of ``TOKENS``."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("n", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("training", pa.list_(pa.bool_())),
         ("size", pa.list_(pa.int64())), ("hashes", pa.binary()), ("suffix", pa.binary()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = made = waiting = 0
        held: list[tuple] = []

        def closed() -> pa.RecordBatch:
            nonlocal made, waiting
            doc_id, training, size, hashes, suffix = zip(*held)
            hashes = np.concatenate(hashes)
            found, at, ids, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            row = [
                # tasks and their chunks; neither needs more than half of the bits
                (part << 32) + made, len(hashes), pa.concat_arrays(doc_id), pa.concat_arrays(training), np.concatenate(size),
                *map(_squeezed, (_packed(_differences(found[order])), np.concatenate(suffix)[at][order].tobytes(), _packed(place[ids]))),
            ]
            made, waiting = made + 1, 0
            held.clear()
            return pa.record_batch([pa.array([v.to_pylist() if isinstance(v, pa.Array) else v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            doc_id, training = batch.column("doc_id"), batch.column("training")
            for words in W.word_groups(W.as_binary(batch.column("text")), lower=True):
                hashes, suffix, _ = _tokens(words)
                mine = slice(words.rows.start, words.rows.stop)
                if held and waiting + len(hashes) > most:
                    yield closed()
                rows = mine.stop - mine.start
                held.append((doc_id.slice(mine.start, rows), training.slice(mine.start, rows), words.counts() + 1, hashes, suffix))
                waiting += len(hashes)
        if held:
            yield closed()

    return run


@dataclass
class Chunk:
    """Tokens of some documents: token ``i`` is ``found[ids[i]]``, and ``found`` is in order."""

    number: int
    found: np.ndarray
    suffix: np.ndarray
    ids: np.ndarray
    size: np.ndarray
    # of each token: whether it lies in a training document
    trains: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size


def _chunks(batch: pa.RecordBatch | pa.Table) -> Iterator[Chunk]:
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i] for name in ("chunk", "training", "size", "hashes", "suffix", "ids")}
        hashes, suffix, ids = (_opened(row[name].as_py()) for name in ("hashes", "suffix", "ids"))
        hashes = _summed(_unpack(hashes)[0])
        order = np.argsort(hashes)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        size = row["size"].values.to_numpy()
        trains = np.repeat(row["training"].values.to_numpy(zero_copy_only=False), size)
        suffix = np.frombuffer(suffix, np.uint8)
        yield Chunk(row["chunk"].as_py(), hashes[order], suffix[order], place[_unpack(ids)[0]], size, trains)


def _count(buckets: int):
    """Each chunk's distinct tokens by bucket: hashes, counts in training documents, suffix classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _chunks(batch):
                counts = np.bincount(c.ids[c.trains], minlength=len(c.found))
                rows = []
                for b, at in C.bucket_slices(c.found, buckets):
                    rows.append((c.number, b, _packed(_differences(c.found[at])) + _packed(counts[at]) + c.suffix[at].tobytes()))
                yield _sent(rows)

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Of one bucket: the corpus count of every token each chunk has sent, in its order; and the bucket's sums."""
    chunk, payload = table.column("chunk").to_pylist(), table.column("payload").to_pylist()
    keys, counts, suffix = [], [], []
    for raw in map(_opened, payload):
        steps, at = _unpack(raw)
        times, at = _unpack(raw, at)
        keys.append(_summed(steps))
        counts.append(times)
        suffix.append(np.frombuffer(raw, np.uint8, offset=at))
    n = [len(k) for k in keys]
    keys, counts, suffix = map(np.concatenate, (keys, counts, suffix))
    found, at, back = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(back, weights=counts).astype(np.int64)
    kind = suffix[at]
    sums = np.concatenate(
        [np.bincount(kind, weights=w, minlength=SUFFIXES) for w in (total, total > 0, total == 1, total == 2)]
    ).astype(np.int64)
    top = np.lexsort((found, -total))[:TOP]
    bucket = table.column("bucket")[0].as_py()
    answer = total[back]
    cuts = np.concatenate([[0], np.cumsum(n)])
    rows = [(c, bucket, _squeezed(_packed(answer[a:b]))) for c, a, b in zip(chunk, cuts[:-1], cuts[1:])]
    rows = [r + (None, None) for r in rows]
    best = [{"hash": int(found[i].astype(np.int64)), "n": int(total[i]), "suffix": int(kind[i])} for i in top if total[i]]
    rows.append((None, bucket, None, sums.tolist(), best))
    schema = pa.schema(
        [("chunk", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary()), ("sums", pa.list_(pa.int64())),
         ("top", pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64()), ("suffix", pa.int32())])))]
    )
    return pa.table([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class Vocabulary:
    """Sums over the training tokens: of fixed size, whatever the corpus."""

    tokens: int
    types: int
    # of each suffix class, without the tokens that are classes of their own
    sums: np.ndarray
    kinds: np.ndarray
    discount: np.ndarray
    top: np.ndarray
    top_class: np.ndarray

    @property
    def unused(self) -> np.uint64:
        """Low bits of a hash that do not count, one at the least: the others are its slot."""
        return np.uint64(64 - min(63, (max(self.tokens, 1) * SLOTS).bit_length()))

    def classes(self, hashes: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        out = suffix.astype(np.int64) + TOP
        if len(self.top):
            place = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            own = self.top[place] == hashes
            out[own] = self.top_class[place[own]]
        return out

    def within_class(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 p(token | class)."""
        shared = classes >= TOP
        kind = np.where(shared, classes - TOP, 0)
        weight = np.where(counts > 0, counts - self.discount[kind], self.discount[kind] * self.kinds[kind])
        # all of a class without training tokens is unknown
        empty = self.sums[kind] == 0
        return np.where(shared & ~empty, np.log10(np.where(empty | ~shared, 1, weight) / np.maximum(self.sums[kind], 1)), 0.0)


def _vocabulary(counted: DataFrame) -> Vocabulary:
    sums = counted.where("chunk is null")
    row = sums.agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(SUMS * SUFFIXES)]).first()
    top = sums.select(F.explode("top").alias("t")).select("t.*").orderBy(F.col("n").desc(), "hash").limit(TOP).collect()
    total = np.array([x or 0 for x in row], dtype=np.int64).reshape(SUMS, SUFFIXES)
    tokens, types = int(total[0].sum()), int(total[1].sum())
    for t in top:
        total[0, t["suffix"]] -= t["n"]
        total[1, t["suffix"]] -= 1
        if t["n"] <= 2:
            total[1 + t["n"], t["suffix"]] -= 1
    discount = (total[2] + 1) / (total[2] + 2 * total[3] + 2)
    hashes = np.array([t["hash"] for t in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(tokens, types, total[0], total[1], discount, hashes[order], order.astype(np.int64))


def _contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the token before each one and of the token before that; ``CLASSES`` before the first."""
    one = np.concatenate([[CLASSES], classes[:-1]])
    one[starts] = CLASSES
    two = np.concatenate([[CLASSES], one[:-1]])
    two[starts] = CLASSES
    return one, two


def _word_features(
    hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray, unused: np.uint64 = np.uint64(0)
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that share their class, and four keys of each: the skip feature in its class, with the token; the pair likewise.

    A key is a hash without its ``unused`` low bits.
    """
    one = np.concatenate([[START], hashes[:-1]])
    one[starts] = START
    two = np.concatenate([[START], one[:-1]])
    two[starts] = START
    at = np.flatnonzero(classes >= TOP)
    token, kind = W.mixed(hashes[at] + _FEATURE_BASE), classes[at].astype(np.uint64)
    keys = []
    for step, before in ((np.uint64(2), two), (np.uint64(1), one)):
        feature = W.mixed(before[at] * _FEATURE_BASE + kind * np.uint64(4) + step)
        keys += [feature, W.mixed(feature * _FEATURE_BASE + token)]
    return at, np.stack(keys) >> unused << unused


def _slots(keys: np.ndarray, unused: np.uint64) -> bytes:
    """Keys in order, as the slot of the first and the differences of the others."""
    return _packed(keys[:1] >> unused) + _packed(np.diff(keys >> unused))


def _keys(raw: bytes, unused: np.uint64) -> tuple[np.ndarray, int]:
    first, at = _unpack(raw)
    steps, at = _unpack(raw, at)
    return np.cumsum(np.concatenate([first, steps]), dtype=np.uint64) << unused, at


def _count_features(vocabulary: Vocabulary, buckets: int):
    """Each chunk's distinct word features by bucket: keys, counts in training documents."""
    unused = vocabulary.unused

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _chunks(batch):
                classes = vocabulary.classes(c.found, c.suffix)[c.ids]
                at, asked = _word_features(c.found[c.ids], classes, c.starts, unused)
                # the lowest bit of a key does not count: it tells the training documents' own
                asked |= c.trains[at].astype(np.uint64)
                asked = np.sort(asked, axis=None)
                head = np.flatnonzero(np.concatenate([[True], np.diff(asked >> unused) > 0])[: len(asked)])
                keys = asked[head] >> unused << unused
                counts = np.add.reduceat(asked & np.uint64(1), head) if len(head) else head
                del asked
                rows = [(c.number, b, _slots(keys[at], unused) + _packed(counts[at])) for b, at in C.bucket_slices(keys, buckets)]
                if rows:
                    yield _sent(rows)

    return run


def _feature_totals(unused: np.uint64):
    """Of one bucket: the corpus count of every word feature each chunk has sent, in its order."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        # a payload at a time is unpacked, as together they are large
        for p in table.column("payload"):
            raw = _opened(p.as_py())
            own, at = _keys(raw, unused)
            keys.append(own)
            counts.append(_unpack(raw, at)[0].astype(np.uint32))
        cuts = np.cumsum([0, *map(len, keys)])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys)
        ordered = keys[order]
        head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        del keys, ordered
        total = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(head))
        answer = np.empty(len(order), dtype=np.int64)
        answer[order] = total[np.cumsum(head) - 1]
        rows = [_squeezed(_packed(answer[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table([table.column("chunk"), table.column("bucket"), pa.array(rows, pa.binary())], names=["chunk", "bucket", "payload"])

    return run


def with_words(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """p(token | class, words before) from p(token | class) and the counts of the four keys of ``_word_features``."""
    for prior, feature, both in ((SKIP_PRIOR, counts[0], counts[1]), (PAIR_PRIOR, counts[2], counts[3])):
        p = (both + prior * p) / (feature + prior)
    return p


def _trigrams(vocabulary: Vocabulary):
    """A task's class trigrams in training documents, packed by the class before: cells and counts."""
    cells = CONTEXTS * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CONTEXTS * cells, dtype=np.int64)
        waiting: list[np.ndarray] = []
        part = 0

        def add() -> None:
            if waiting:
                np.add(table, np.bincount(np.concatenate(waiting), minlength=len(table)), out=table)
                waiting.clear()

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for c in _chunks(batch):
                classes = vocabulary.classes(c.found, c.suffix)[c.ids]
                one, two = _contexts(classes, c.starts)
                waiting.append((one * cells + two * CLASSES + classes)[c.trains])
                if sum(map(len, waiting)) > 4_000_000:
                    add()
        add()
        rows = []
        for c in range(CONTEXTS):
            mine = table[c * cells : (c + 1) * cells]
            at = np.flatnonzero(mine)
            if len(at):
                rows.append((c, part, at.astype("<i4").tobytes() + mine[at].astype("<i8").tobytes()))
        if rows:
            before, parts, payload = zip(*rows)
            yield pa.record_batch(
                [pa.array(before, pa.int32()), pa.array(parts, pa.int32()), pa.array(payload, pa.binary())],
                names=["before", "part", "payload"],
            )

    return run


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros(CONTEXTS * CLASSES, dtype=np.int64)
    n = len(raw) // 12
    out[np.frombuffer(raw, "<i4", n)] = np.frombuffer(raw, "<i8", n, 4 * n)
    return out


def _folded(table: pa.Table) -> pa.Table:
    total = np.zeros(CONTEXTS * CLASSES, dtype=np.int64)
    for raw in table.column("payload"):
        total += _unpacked(raw.as_py())
    at = np.flatnonzero(total)
    raw = at.astype("<i4").tobytes() + total[at].astype("<i8").tobytes()
    return pa.table(
        [pa.array([table.column("before")[0].as_py()], pa.int32()), pa.array([table.column("part")[0].as_py()], pa.int32()),
         pa.array([raw], pa.binary())],
        names=["before", "part", "payload"],
    )


def _class_counts(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per class before, with the counts of all trigrams over it, added up ``FOLD`` rows at a time."""
    counted = tokens.withColumn("part", F.spark_partition_id()).mapInArrow(
        _trigrams(vocabulary), "before int, part int, payload binary"
    )
    parts = tokens.rdd.getNumPartitions()
    while True:
        parts = -(-parts // FOLD)
        counted = counted.withColumn("part", F.col("part") % parts)
        counted = counted.groupBy("before", "part").applyInArrow(_folded, "before int, part int, payload binary")
        if parts <= 1:
            return counted


class Weights:
    """Rows of class weights: the bias, then each class before, each class before that, and hashed pairs."""

    def __init__(self) -> None:
        self.rows = np.zeros((1 + 2 * CONTEXTS + HASHED, CLASSES), dtype=np.float64)

    @staticmethod
    def features(before: np.ndarray | int) -> np.ndarray:
        """The four rows of every pair (before, two before)."""
        two = np.arange(CONTEXTS)
        pair = W.mixed((two * CONTEXTS + before).astype(np.uint64)) % np.uint64(HASHED)
        one = np.full(CONTEXTS, 1 + before)
        return np.stack([np.zeros(CONTEXTS, int), one, 1 + CONTEXTS + two, 1 + 2 * CONTEXTS + pair.astype(int)])

    def add(self, total: np.ndarray, before: int, counts: np.ndarray) -> None:
        """Add a row of ``counts`` per class two before to each of its features' rows in ``total``."""
        every = counts.sum(axis=0)
        total[0] += every
        total[1 + before] += every
        total[1 + CONTEXTS : 1 + 2 * CONTEXTS] += counts
        for row, mine in zip(self.features(before)[3], counts):
            total[row] += mine

    def log_probabilities(self, before: int) -> np.ndarray:
        """Natural logs, a row per class two before."""
        logits = self.rows[self.features(before)].sum(axis=0)
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _gradient(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Weights()
        model.rows = weights
        seen, expected = np.zeros_like(weights), np.zeros_like(weights)
        for batch in batches:
            for before, raw in zip(batch.column("before").to_pylist(), batch.column("payload").to_pylist()):
                counts = _unpacked(raw).reshape(CONTEXTS, CLASSES)
                wanted = counts.sum(axis=1, keepdims=True) * np.exp(model.log_probabilities(before))
                for total, mine in ((seen, counts), (expected, wanted)):
                    model.add(total, before, mine)
        raw = seen.astype("<f4").tobytes() + expected.astype("<f4").tobytes()
        yield pa.record_batch([pa.array([raw], pa.binary())], names=["payload"])

    return run


def train(counts: DataFrame, rounds: int = ROUNDS, tasks: int = 4) -> Weights:
    """Steps along the gradient, each feature's scaled by what the model expects of it."""
    model = Weights()
    # what a task sends is as large as the weights, whatever the corpus
    counts = counts.coalesce(tasks)
    for turn in range(rounds):
        parts = counts.mapInArrow(_gradient(model.rows), "payload binary").collect()
        total = np.zeros((2, *model.rows.shape))
        for part in parts:
            total += np.frombuffer(part["payload"], "<f4").reshape(total.shape)
        seen, expected = total
        if turn == 0:
            model.rows[0] = np.log(seen[0] + 1) - np.log(seen[0].sum() + CLASSES)
        else:
            model.rows += STEP * np.clip((seen - expected) / (expected + SMOOTH), -1, 1)
    return model


def _score(vocabulary: Vocabulary, logs: np.ndarray):
    unused = vocabulary.unused

    def run(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        (c,) = _chunks(tokens)
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        payload, featured = answers.column("payload").combine_chunks(), answers.column("featured").to_pylist()
        replies = lambda kind: np.concatenate([_unpack(_opened(payload[int(i)].as_py()))[0] for i in order if featured[i] == kind])
        counts = replies(False).astype(np.float64)
        classes = vocabulary.classes(c.found, c.suffix)
        within = 10 ** vocabulary.within_class(classes, counts)
        plain = np.log10((counts + 1) / (vocabulary.tokens + vocabulary.types + 1))
        classes = classes[c.ids]
        each = logs[(*_contexts(classes, c.starts), classes)]
        at, asked = _word_features(c.found[c.ids], classes, c.starts, unused)
        if len(at):
            back = np.unique(asked, return_inverse=True)[1].reshape(asked.shape)
            del asked
            seen = replies(True)
            each[at] += np.log10(with_words(within[c.ids[at]], seen[back]))
        total = lambda values: pa.array(np.add.reduceat(values, c.starts))
        held_out = ~tokens.column("training").combine_chunks()[0].values.to_numpy(zero_copy_only=False)
        return pa.table(
            [tokens.column("doc_id").combine_chunks()[0].values, pa.array(held_out), pa.array(c.size),
             total((counts > 0).astype(np.int64)[c.ids]), pa.array(np.full(len(c.size), vocabulary.tokens, dtype=np.int64)),
             total(plain[c.ids]), total(each)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def score_documents(docs: DataFrame, training: Column, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows where ``training`` holds, score all: log10 probabilities of whole texts."""
    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(training, F.lit(False)).alias("training"))
    tokens = stored(marked.withColumn("part", F.spark_partition_id().cast("bigint")).mapInArrow(_tokenized(CHUNK_TOKENS), TOKENS), "tokens")
    size = tokens.agg(F.sum("n")).first()[0] or 0
    n = max(-(-size // BUCKET_TOKENS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = stored(
        tokens.mapInArrow(_count(n), SENT).repartition(n, "bucket").groupBy("bucket").applyInArrow(_totals, COUNTED), "token-counts", release=True
    )
    vocabulary = _vocabulary(counted)
    model = train(stored(_class_counts(tokens, vocabulary), "class-counts", release=True), rounds)
    features = stored(
        tokens.mapInArrow(_count_features(vocabulary, n), SENT).repartition(n, "bucket").groupBy("bucket")
        .applyInArrow(_feature_totals(vocabulary.unused), SENT),
        "feature-counts", release=True,
    )
    logs = np.stack([model.log_probabilities(c) for c in range(CONTEXTS)]) / np.log(10)
    answers = counted.where("chunk is not null").select("chunk", "bucket", "payload", F.lit(False).alias("featured"))
    answers = answers.union(features.withColumn("featured", F.lit(True)))
    return (
        tokens.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _score(vocabulary, logs),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, training_rows(F.col("doc_id")))
