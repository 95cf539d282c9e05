"""Substring dedup on the De Bruijn graph of the corpus' words.

Each run of ``k`` words is an edge, from the node of its first ``k - 1`` words to that of its last. An
edge that some document with a smaller doc_id has too is repeated. Where repeated edges of a document
follow each other the path does not branch within it, and they are compacted into one span, which
covers ``edges + k - 1`` words. Spans are cut from the text.

Edges travel packed and once per chunk of documents (see ``chunks``). Chunks are ranges of doc_id, so
the smallest chunk that sends an edge owns it, and the later ones get it back through a join on the
chunk. Repeats within a chunk are found where its documents are, by their coordinates.

Cases: null text counts as empty; texts of fewer than ``k`` words lose nothing; documents with the same
doc_id do not cut each other; a missing doc_id is smaller than all others; an empty table gives an
empty one. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from . import words as W

K = 13

# An edge is sent as this many bytes of its hash; the bucket stands for the rest.
KEY_BYTES = 7
_LOW = np.uint64((1 << (8 * KEY_BYTES)) - 1)

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start: int, length: int>>, kept_text string"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
        ("kept_text", pa.string()),
    ]
)


def _pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    low = np.frombuffer(raw, dtype=np.uint8).reshape(-1, KEY_BYTES)
    whole = np.zeros((len(low), 8), dtype=np.uint8)
    whole[:, :KEY_BYTES] = low
    return whole.view("<u8").ravel().astype(np.uint64)


def _edges(words: W.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all edges, their hashes, and how many each text has."""
    starts, per_text = W.windows(words, k)
    return starts, W.window_hashes(W.word_hashes(words), starts, starts + k), np.diff(per_text)


def _send(k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = defaultdict(list)
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            for words in W.word_groups(W.as_binary(batch.column("text"))):
                _, hashes, counts = _edges(words, k)
                owner = np.repeat(chunk[words.rows], counts)
                for c in np.unique(owner):
                    held[int(c)].append(hashes[owner == c])
        for c in list(held):
            keys = np.unique(np.concatenate(held.pop(c)))
            rows = [(c, b, _pack(keys[at])) for b, at in C.bucket_slices(keys, buckets)]
            if rows:
                yield C.sent(rows)

    return run


def _later(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk, the edges that a smaller chunk has sent."""
    order = np.argsort(table.column("chunk").to_numpy(), kind="stable")
    chunk = table.column("chunk").to_numpy()[order]
    payload = table.column("payload").to_pylist()
    keys = [_unpack(payload[i]) for i in order]
    row = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
    keys = np.concatenate(keys)
    by_key = np.argsort(keys, kind="stable")
    again = by_key[1:][keys[by_key[1:]] == keys[by_key[:-1]]]
    again = again[np.argsort(again, kind="stable")]
    bucket = int(table.column("bucket")[0].as_py())
    cuts = np.searchsorted(row[again], np.arange(len(chunk) + 1))
    rows = [(int(chunk[i]), bucket, _pack(keys[again[cuts[i] : cuts[i + 1]]])) for i in range(len(chunk)) if cuts[i] < cuts[i + 1]]
    return pa.Table.from_batches([C.sent(rows)]) if rows else table.slice(0, 0)


def _repeated(hashes: np.ndarray, rank: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """Which edges of a chunk a document with a smaller id has too; ``rank`` orders the edges' documents."""
    order = np.argsort(hashes, kind="stable")
    ordered, ranks = hashes[order], rank[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.minimum.reduceat(ranks, np.flatnonzero(head))
    found = ranks > first[np.cumsum(head) - 1]
    where = dict(C.bucket_slices(ordered, buckets))
    for bucket, raw in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist()):
        at = where[bucket]
        asked, keys = _unpack(raw), ordered[at] & _LOW
        asked.sort()
        place = np.minimum(np.searchsorted(asked, keys), len(asked) - 1)
        found[at] |= asked[place] == keys
    out = np.empty(len(hashes), dtype=bool)
    out[order] = found
    return out


def _spans(first: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated edges that follow each other in a text, compacted: index of the first one and words covered."""
    head = np.concatenate([[True], (np.diff(first) != 1) | (np.diff(text) != 0)])
    at = np.flatnonzero(head)
    return at, np.diff(np.concatenate([at, [len(first)]])) + k - 1


def _cut(k: int, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _ARROW.empty_table()
        ids = docs.column("doc_id").combine_chunks()
        known = ids.fill_null(-(2**63)).to_numpy()
        rank = np.unique(known, return_inverse=True)[1]
        groups, hashes, ranks = [], [], []
        for words in W.word_groups(C.texts_of(docs)):
            starts, found, counts = _edges(words, k)
            groups.append((words, starts, counts))
            hashes.append(found)
            ranks.append(np.repeat(rank[words.rows], counts))
        hashes = np.concatenate(hashes)
        repeated = _repeated(hashes, np.concatenate(ranks), answers, buckets) if len(hashes) else np.zeros(0, dtype=bool)
        n_words, n_removed, spans, kept = [], [], [], []
        done = 0
        for words, starts, counts in groups:
            mine = repeated[done : done + len(starts)]
            done += len(starts)
            text = np.repeat(np.arange(len(counts)), counts)[mine]
            edge = starts[mine]
            change = np.zeros(len(words.begin) + 1, dtype=np.int64)
            change[edge] += 1
            change[edge + k] -= 1
            gone = np.cumsum(change[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            n_words.append(words.counts())
            n_removed.append(np.diff(total[words.first]))
            kept += _texts(words, ~gone)
            at, length = _spans(edge, text, k) if len(edge) else (edge, edge)
            start = edge[at] - words.first[text[at]]
            cuts = np.searchsorted(text[at], np.arange(len(counts) + 1))
            spans += [
                [{"start": int(a), "length": int(n)} for a, n in zip(start[lo:hi], length[lo:hi])]
                for lo, hi in zip(cuts[:-1], cuts[1:])
            ]
        return pa.table(
            [ids, np.concatenate(n_words).astype(np.int64), np.concatenate(n_removed).astype(np.int64),
             pa.array(spans, _ARROW.field("spans").type), pa.array(kept, pa.string())],
            schema=_ARROW,
        )

    return run


def _texts(words: W.Words, keep: np.ndarray) -> list[str]:
    """The kept words of each text, joined by one space."""
    kept = np.flatnonzero(keep)
    length = words.end[kept] - words.begin[kept]
    to = np.concatenate([[0], np.cumsum(length + 1)])
    out = np.full(to[-1], 0x20, dtype=np.uint8)
    out[W.pieces(length, to[:-1])] = words.data[W.pieces(length, words.begin[kept])]
    raw = out.tobytes()
    cuts = to[np.searchsorted(kept, words.first)]
    return [raw[a : max(a, b - 1)].decode() for a, b in zip(cuts[:-1], cuts[1:])]


def drop_repeated_substrings(docs: DataFrame, k: int = K) -> DataFrame:
    """Every document without the words of its repeated spans: doc_id, n_words, n_removed, spans, kept_text."""
    n = C.chunk_count(docs)
    chunked = C.dealt(C.range_chunks(docs.select("doc_id", "text"), n), n)
    answers = (
        chunked.mapInArrow(_send(k, n), C.SENT)
        .repartition(n, "bucket")
        .groupBy("bucket")
        .applyInArrow(_later, C.SENT)
    )
    return chunked.groupBy(C.CHUNK).cogroup(answers.groupBy(C.CHUNK)).applyInArrow(_cut(k, n), RESULT)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("spans").alias("n_spans")
    )
