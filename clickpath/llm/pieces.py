"""SentencePiece models run by the tokenizers library: encoding to ids and decoding back.

``read_model`` parses the model's protobuf. ``segment_tokenizer`` builds the same model from it: unigram
scores, or the merges that the scores of a BPE model imply, with byte fallback, and spaces turned into the
metaspace marker. The normaliser (precompiled map, extra spaces, space in front) comes from the model too.

When the normaliser leaves texts as they are and no piece has a marker behind another character, pieces
never cross from a character to a space. Texts are then cut before each space (one is put in front), and each
distinct segment is encoded once per worker, in multithreaded batches; otherwise whole texts are.
Parity: every batch that goes through the rebuilt model goes through the sentencepiece library as well.
Where they differ the library's ids are taken, and ``n_differing`` counts the segments (or texts) concerned.

Cases: null and empty texts have no ids and decode to the empty text; ids that are no part of valid UTF-8
decode to U+FFFD; a marker that a text has itself decodes to a space; rows with the same doc_id keep their own results; an empty table gives an empty one.
Other columns of the input are not read.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .word_cache import PieceCache, per_text

MARKER = "▁"

# fixed values of the model file: kinds of pieces, kinds of models
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

RESULT = "doc_id bigint, ids array<int>, n_differing bigint, decoded string"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}[kind] if kind in (1, 5) else varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    space_in_front: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True

    @property
    def by_segments(self) -> bool:
        """Whether texts may be cut before spaces."""
        inner = any(MARKER in p.lstrip(MARKER) for p in self.pieces)
        return not (self.charsmap or self.remove_extra_spaces or inner) and self.space_in_front and self.escape_spaces


def read_model(path: str) -> Model:
    model = Model()
    with open(path, "rb") as file:
        data = file.read()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            model.pieces.append(piece)
            model.scores.append(score)
            model.kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.space_in_front = bool(v)
                elif n == 4:
                    model.remove_extra_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    model.unknown = model.kinds.index(UNKNOWN)
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make up a piece, best score first."""
    ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-model.scores[i], i, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def segment_tokenizer(model: Model):
    """The model without its normaliser: spaces become markers, nothing is put in front."""
    from tokenizers import Tokenizer, models, normalizers

    if model.kind == UNIGRAM:
        # control pieces are never found in text
        worst = min(model.scores) - 1000.0
        vocabulary = [
            (p, s if k in (NORMAL, USER_DEFINED, BYTE, UNKNOWN) else worst)
            for p, s, k in zip(model.pieces, model.scores, model.kinds)
        ]
        core = models.Unigram(vocabulary, model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)}, _merges(model), unk_token=model.pieces[model.unknown],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"unigram and BPE models can be rebuilt, not kind {model.kind}")
    tokenizer = Tokenizer(core)
    if model.escape_spaces:
        tokenizer.normalizer = normalizers.Replace(" ", MARKER)
    return tokenizer


def text_tokenizer(model: Model):
    """The whole model, for whole texts."""
    from tokenizers import Regex, normalizers

    tokenizer = segment_tokenizer(model)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(left=True, right=True), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.space_in_front:
        steps.append(normalizers.Prepend(MARKER if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    return tokenizer


def segment_groups(column: pa.Array) -> Iterator[W.Words]:
    """Texts with a space in front, cut before every space that follows another character."""
    for rows, data, offsets in W.groups(column):
        full = offsets[:-1][np.diff(offsets) > 0]
        data = np.insert(data, full, 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        space = data == 0x20
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(head)
        yield W.Words(rows, data, begin, np.concatenate([begin[1:], [len(data)]]), np.searchsorted(begin, offsets))


class Codec:
    """Encodes and decodes with the rebuilt model, beside the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = read_model(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_segments = self.model.by_segments
        self.tokenizer = segment_tokenizer(self.model) if self.by_segments else text_tokenizer(self.model)
        self.cache = PieceCache(self._segments)
        self.differing: set[str] = set()
        spelled = [self._spelled(p, k) for p, k in zip(self.model.pieces, self.model.kinds)]
        self._bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self._length = np.array([len(s) for s in spelled], dtype=np.int64)
        self._start = np.cumsum(self._length) - self._length

    def _spelled(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARKER, " ").encode()

    def _checked(self, texts: list[str], asked: list[str]) -> list[list[int]]:
        """Ids of ``texts`` from the rebuilt model, against the library's for ``asked``."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        expected = self.library.encode(asked, num_threads=THREADS)
        for i, (a, b) in enumerate(zip(found, expected)):
            # a segment that is the space in front alone cannot be asked for
            if a != b and (asked[i] or not self.by_segments):
                self.differing.add(texts[i])
                found[i] = b
        return found

    def _segments(self, segments: list[str]) -> list[list[int]]:
        return self._checked(segments, [s[1:] for s in segments])

    def encode_texts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each group of texts: ids, where each text's start, and how many parts of each differ."""
        if self.by_segments:
            for words in segment_groups(column):
                ids, lengths = self.cache.ids(words)
                wrong = np.zeros(len(words.first) - 1, dtype=np.int64)
                if self.differing:
                    off = np.array([words.text_of(i).decode() in self.differing for i in range(len(lengths))])
                    wrong = np.diff(np.concatenate([[0], np.cumsum(off)])[words.first])
                yield ids, per_text(lengths, words), wrong
        else:
            for rows, _, _ in W.groups(column):
                texts = [t.decode() for t in column[rows.start : rows.stop].to_pylist()]
                found = self._checked(texts, texts)
                lengths = [len(x) for x in found]
                wrong = np.array([t in self.differing for t in texts], dtype=np.int64)
                self.differing.clear()
                yield np.array([i for x in found for i in x], dtype=np.int32), np.concatenate([[0], np.cumsum(lengths)]), wrong

    def decode_texts(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Text of each run of ids: the pieces' bytes, without the space in front."""
        length = self._length[ids]
        raw = self._bytes[W.pieces(length, self._start[ids])].tobytes()
        cuts = np.concatenate([[0], np.cumsum(length)])[at]
        out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
        return [t[1:] if t.startswith(" ") else t for t in out] if self.model.space_in_front else out


# threads that encode a batch, as many as the cores of a small executor
THREADS = 2

_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker and model, with what it remembers."""
    if path not in _codecs:
        # more threads than cores cost memory and no less time
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        _codecs[path] = Codec(path)
    return _codecs[path]


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(path)
        for batch in batches:
            done = 0
            for ids, at, wrong in made.encode_texts(W.as_binary(batch.column("text"))):
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(done, len(wrong)),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))),
                        pa.array(wrong),
                        pa.array(made.decode_texts(ids, at), pa.string()),
                    ],
                    names=["doc_id", "ids", "n_differing", "decoded"],
                )
                done += len(wrong)

    return run


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_differing and the text decoded from the ids, for every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_round_trip(path), RESULT)


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "n_differing", F.sha2("decoded", 256).alias("decoded_sha256")
    )
