"""Words and word windows of Arrow text columns as numpy arrays, without a Python object per word.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. Its hash is the sum of one random number
per place and byte, so that no algebra relates the hashes of different words; a window's hash is a
polynomial over the hashes of its words, taken from prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in groups of about this many bytes; one longer text is a group of its own.
GROUP_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord("."), ord(",")]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# places in a word whose numbers are kept in a table; those further on are computed
_PLACES = 64

# odd multipliers, with their inverses modulo 2**64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_OTHER_BASE = 0xAF251AF3B0F025B5


@dataclass
class Words:
    """Words of a group of texts: word ``i`` is ``data[begin[i]:end[i]]``; text ``d`` has words ``first[d]:first[d + 1]``."""

    rows: slice
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


@lru_cache(maxsize=32)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i up to 2**bits."""
    size = (1 << bits) + 1

    def run(b: int) -> np.ndarray:
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        out[1:] = b
        return np.multiply.accumulate(out)

    return run(base), run(pow(base, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A hash of each ``values[begin:end]``."""
    up, down = _powers(base, max(12, int(len(values)).bit_length()))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(_OTHER_BASE))


def _place_numbers(codes: np.ndarray) -> np.ndarray:
    return mixed((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BYTE_BASE))


@lru_cache(maxsize=1)
def _place_table() -> np.ndarray:
    return _place_numbers(np.arange(_PLACES << 8))


def word_hashes(words: Words) -> np.ndarray:
    length = words.end - words.begin
    total = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], length)
    code = (place << 8) + words.data[place + np.repeat(words.begin, length)]
    table = _place_table()
    if length.max(initial=0) <= _PLACES:
        numbers = table[code]
    else:
        numbers = table[np.minimum(code, len(table) - 1)]
        far = code >= len(table)
        numbers[far] = _place_numbers(code[far])
    sums = np.zeros(len(numbers) + 1, dtype=np.uint64)
    np.cumsum(numbers, out=sums[1:])
    return mixed(sums[total[1:]] - sums[total[:-1]] + length.astype(np.uint64) * np.uint64(_OTHER_BASE))


def word_bytes(words: Words) -> pa.LargeBinaryArray:
    """The words themselves."""
    length = words.end - words.begin
    offsets = np.concatenate([[0], np.cumsum(length)])
    data = words.data[pieces(length, words.begin)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def window_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, other: bool = False) -> np.ndarray:
    """A hash of each run of words; ``other`` gives a second, independent one."""
    return range_hashes(hashes, begin, end, _OTHER_BASE if other else _WORD_BASE)


def as_binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as 64-bit-offset binary, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows, bytes and text offsets into these of each group of whole texts."""
    n = len(column)
    if not n:
        return
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64, count=column.offset + n + 1)[column.offset :]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield slice(lo, hi), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_groups(column: pa.Array, lower: bool = False, most: int = GROUP_BYTES, marks: bool = False) -> Iterator[Words]:
    """Words of groups of texts; with ``marks`` a stop or comma behind a letter or digit (A-Z, 0-9) begins a word."""
    for rows, data, offsets in groups(column, most):
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        # one more place at either end, so that each text starts after a gap
        before = np.concatenate([[True], space])
        before[offsets[:-1]] = True
        after = np.concatenate([space, [True]])
        after[offsets[1:]] = True
        word = ~space
        if marks:
            cut = np.flatnonzero(_MARK[data[1:]] & _ALNUM[data[:-1]])
            before[cut + 1] = True
            after[cut + 1] = True
        begin = np.flatnonzero(word & before[:-1])
        end = np.flatnonzero(word & after[1:]) + 1
        yield Words(rows, data, begin, end, np.searchsorted(begin, offsets))


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all runs of ``k`` words, and where each text's runs start among them."""
    per_text = np.maximum(words.counts() - k + 1, 0)
    starts = np.concatenate([[0], np.cumsum(per_text)])
    text = np.repeat(np.arange(len(per_text)), per_text)
    return np.arange(starts[-1]) - starts[text] + words.first[text], starts


def pieces(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of each piece, one piece after the other."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(total[-1]) - np.repeat(total[:-1] - starts, lengths)
