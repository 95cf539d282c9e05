"""Token ids in files of length-delimited binary records, with an offset index beside each file.

A record is: the payload's length (8 bytes), the length's masked checksum (4), the payload, the payload's
masked checksum (4). All numbers are little-endian. Checksums are CRC-32 (zlib's polynomial), rotated
right by 15 bits plus a constant, so that a checksum of bytes that hold checksums stays useful. A payload
is one byte for the width of an id (2 or 4), one byte that tells whether there is a doc_id, the doc_id (8
bytes) and the ids. The index file ``.idx`` holds the offset of every record (8 bytes each), so that single
records can be read in any order.

Documents are dealt by ranges of doc_id and ordered within; file ``part-00007-...`` holds the seventh
range. Each attempt of a task writes files of its own name, and only files that a finished task has named are
in the manifest, so a lost executor leaves no record twice. Files go through ``pyarrow.fs`` to the folder
that all executors share.

Cases: null text counts as empty, and has only the end id; rows with the same doc_id are records of their
own, ordered by a hash of their texts; a missing doc_id comes first and is kept as such; an empty table
gives no files. Other columns are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpath.storage import stored, work_dir

from . import words as W
from .word_cache import PieceCache, per_text

END_ID = 1
# a file is closed after so many bytes
FILE_BYTES = 256 << 20
# text bytes that are encoded at once, and words a worker remembers
GROUP_BYTES = 4 << 20
REMEMBERED = 750_000
# read at once from a file
READ_BYTES = 2 << 20

# fixed values of the file format
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<BBq")
_LENGTH = struct.Struct("<Q")
_CHECK = struct.Struct("<I")

MANIFEST = "part int, number int, path string, records bigint, tokens bigint, bytes bigint"


class DamagedRecord(ValueError):
    pass


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join([length, _CHECK.pack(masked_checksum(length)), payload, _CHECK.pack(masked_checksum(payload))])


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the record at an offset, and the offset after it."""
    head = data[at : at + 12]
    if len(head) < 12 or _CHECK.unpack_from(head, 8)[0] != masked_checksum(head[:8]):
        raise DamagedRecord(f"length of the record at {at}")
    (n,) = _LENGTH.unpack_from(head)
    payload, check = data[at + 12 : at + 12 + n], data[at + 12 + n : at + 16 + n]
    if len(payload) < n or len(check) < 4 or _CHECK.unpack(check)[0] != masked_checksum(payload):
        raise DamagedRecord(f"payload of the record at {at}")
    return payload, at + 16 + n


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    return _HEAD.pack(ids.dtype.itemsize, doc_id is not None, doc_id or 0) + ids.tobytes()


def document_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, known, doc_id = _HEAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)


class _File:
    def __init__(self, fs: pafs.FileSystem, root: str, part: int, number: int):
        self.fs, self.part, self.number = fs, part, number
        self.path = f"{root}/part-{part:05d}-{number:03d}-{uuid.uuid4().hex}.rec"
        self.out = fs.open_output_stream(self.path)
        self.offsets, self.size, self.tokens = [], 0, 0

    def add(self, records: list[bytes], tokens: int) -> None:
        for r in records:
            self.offsets.append(self.size)
            self.size += len(r)
        self.out.write(b"".join(records))
        self.tokens += tokens

    def close(self) -> tuple:
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}.idx") as out:
            out.write(np.array(self.offsets, dtype="<u8").tobytes())
        return self.part, self.number, self.path, len(self.offsets), self.tokens, self.size


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["part", "number", "path", "records", "tokens", "bytes"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# words that show whether a tokenizer works on words alone, and whether case and marks can be taken off before
_PROBES = ["ab", "straße", "été", "слово", "日本", "naïveté", "x", "aabbaabb"]


class WordTokenizer:
    """Ids of words from the tokenizers library, each distinct word once per worker.

    White space never joins the words beside it in tokenizers that cut at words first, so words are
    encoded alone. Words of letters that the normaliser leaves as they are need the model only: many of
    them are encoded as one text that is cut at spaces. ``_PROBES`` decide whether that gives the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        alone = [self._ids(w) for w in _PROBES]
        self.by_words = self._ids(" ".join(_PROBES)) == sum(alone, []) == self._ids("\n\t".join(_PROBES))
        self.by_model = self.by_words and self._joined(_PROBES) == alone
        # case and marks do not matter for the words they are taken from
        self.plain = self.by_words and all(
            self._ids(w.upper() + ".,") == self._ids(w) + self._ids(".,") for w in _PROBES if w.isascii()
        )
        # added tokens are found in whole texts as they are spelled, so texts that may hold one go to the library
        self.added = [t.content.encode().lower() for t in self.whole.get_added_tokens_decoder().values()]
        self.cache = PieceCache(self._encode, REMEMBERED)

    def _ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _joined(self, words: list[str], many: int = 512) -> list[list[int]]:
        texts = [" ".join(words[i : i + many]) for i in range(0, len(words), many)]
        out = []
        for i, e in enumerate(self.model.encode_batch(texts, add_special_tokens=False)):
            ids = e.ids
            cuts = np.searchsorted(e.word_ids, np.arange(min(many, len(words) - i * many) + 1)).tolist()
            out += [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return out

    def _encode(self, words: list[str]) -> list[list[int]]:
        simple = [self.by_model and w.isalpha() and w == w.lower() and is_normalized("NFC", w) for w in words]
        easy = iter(self._joined([w for w, s in zip(words, simple) if s]))
        hard = iter(self.whole.encode_batch_fast([w for w, s in zip(words, simple) if not s], add_special_tokens=False))
        return [next(easy) if s else next(hard).ids for s in simple]

    def groups(self, column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Rows of each group of texts, their ids, and where each text's ids start."""
        if self.by_words:
            for words in W.word_groups(column, lower=self.plain, marks=self.plain, most=most):
                raw = words.data.tobytes().lower()
                if any(token in raw for token in self.added):
                    yield self._whole_texts(column, words.rows)
                    continue
                ids, lengths = self.cache.ids(words)
                yield words.rows, ids, per_text(lengths, words)
            return
        for rows, _, _ in W.groups(column):
            yield self._whole_texts(column, rows)

    def _whole_texts(self, column: pa.Array, rows: slice) -> tuple[slice, np.ndarray, np.ndarray]:
        texts = [t.decode() for t in column[rows.start : rows.stop].to_pylist()]
        found = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = [len(x) for x in found]
        return rows, np.array([i for x in found for i in x], dtype=np.int32), np.concatenate([[0], np.cumsum(lengths)])


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker and file, with what it remembers."""
    if path not in _tokenizers:
        # more threads than cores cost memory and no less time
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _write(tokenizer: str, root: str, end_id: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(root)
        made = word_tokenizer(tokenizer)
        kind = np.dtype("<u2" if max(made.size, end_id + 1) <= 1 << 16 else "<u4")
        part, number, file, done = TaskContext.get().partitionId(), 0, None, []
        end = np.array([end_id], dtype=kind)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for rows, ids, at in made.groups(W.as_binary(batch.column("text"))):
                ids = ids.astype(kind)
                records = [
                    frame(payload_of(doc_id, np.concatenate([ids[a:b], end])))
                    for doc_id, a, b in zip(doc_ids[rows], at[:-1], at[1:])
                ]
                file = file or _File(fs, folder, part, number)
                file.add(records, len(ids) + len(records))
                if file.size >= file_bytes:
                    done.append(file.close())
                    file, number = None, number + 1
        if file:
            done.append(file.close())
        if done:
            yield _rows(done)

    return run


def write_token_records(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all documents in order of doc_id; returns the manifest with the ids before each file."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    manifest = stored(
        rows.repartitionByRange("doc_id", "text_hash")
        .sortWithinPartitions("doc_id", "text_hash")
        .select("doc_id", "text")
        .mapInArrow(_write(tokenizer, root, end_id, file_bytes), MANIFEST),
        "record-manifest",
    )
    # one row per file
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read(root: str, read_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for path, start, size in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "bytes")]):
                with fs.open_input_stream(f"{path}.idx") as index:
                    offsets = np.frombuffer(index.read(), "<u8").astype(np.int64)
                cuts = np.concatenate([offsets, [size]])
                with fs.open_input_file(path) as file:
                    lo = 0
                    while lo < len(offsets):
                        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + read_bytes, side="right")) - 1)
                        data = file.read_at(int(cuts[hi] - cuts[lo]), int(cuts[lo]))
                        docs = [document_of(unframe(data, int(at - cuts[lo]))[0]) for at in offsets[lo:hi]]
                        n = np.array([len(ids) for _, ids in docs], dtype=np.int64)
                        yield pa.record_batch(
                            [
                                pa.array([d for d, _ in docs], pa.int64()),
                                pa.array(start + np.cumsum(n) - n),
                                pa.array([ids.astype("<u4").tobytes() for _, ids in docs], pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )
                        start += int(n.sum())
                        lo = hi

    return run


def read_token_records(spark: SparkSession, manifest: DataFrame, root: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """doc_id, start (ids before it in all files) and ids of every record, as little-endian 32-bit numbers.

    A damaged record raises.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("path", "start", "bytes").repartition(tasks, "path")
    return files.mapInArrow(_read(root, read_bytes), "doc_id bigint, start bigint, ids binary")


def read_one(root: str, path: str, number: int) -> tuple[int | None, np.ndarray]:
    """The ``number``-th document of a file, through its index."""
    fs, _ = pafs.FileSystem.from_uri(root)
    with fs.open_input_file(f"{path}.idx") as index:
        (at,) = _LENGTH.unpack(index.read_at(8, 8 * number))
    with fs.open_input_file(path) as file:
        (n,) = _LENGTH.unpack(file.read_at(8, at))
        return document_of(unframe(file.read_at(n + 16, at))[0])


def new_record_folder(spark: SparkSession) -> str:
    root = f"{work_dir(spark)}/clickpath/records-{uuid.uuid4().hex}"
    fs, folder = pafs.FileSystem.from_uri(root)
    fs.create_dir(folder, recursive=True)
    return root


def op7_token_records(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = new_record_folder(spark)
    manifest = write_token_records(docs, root, public_tokenizers.path("word_bpe_49k.json"))
    back = read_token_records(spark, manifest, root)
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return back.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
