"""Token ids of repeated pieces of text: each distinct piece goes through the tokenizer once per worker.

Pieces are told apart by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

from . import words as W

# Pieces a worker remembers before it starts afresh; results do not depend on it.
REMEMBERED = 200_000
# and the bytes of these
REMEMBERED_BYTES = 32 << 20


class PieceCache:
    """``encode`` turns a list of pieces into a list of id lists."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.held = 0
        self.start, self.length = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        self.flat = np.zeros(1 << 18, dtype=np.int32)
        self.used = 0

    def _learn(self, pieces: list[bytes]) -> None:
        found = self.encode([p.decode() for p in pieces])
        n, size = len(self.slots), [len(x) for x in found]
        while n + len(found) > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        total = sum(size)
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        ends = self.used + np.cumsum(size, dtype=np.int64)
        self.length[n : n + len(found)] = size
        self.start[n : n + len(found)] = ends - size
        self.flat[self.used : self.used + total] = [i for x in found for i in x]
        self.used += total
        self.slots.update(zip(pieces, range(n, n + len(found))))
        self.held += sum(map(len, pieces))

    def ids(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces of a group, one after the other, and how many each piece has."""
        if len(self.slots) > self.remembered or self.held > REMEMBERED_BYTES:
            self._clear()
        coded = W.word_bytes(words).dictionary_encode()
        kinds, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        slot = np.fromiter(map(self.slots.get, kinds, repeat(-1)), dtype=np.int64, count=len(kinds))
        new = np.flatnonzero(slot < 0)
        if len(new):
            slot[new] = np.arange(len(self.slots), len(self.slots) + len(new))
            self._learn([kinds[i] for i in new.tolist()])
        slot = slot[index]
        length = self.length[slot]
        return self.flat[W.pieces(length, self.start[slot])], length


def per_text(lengths: np.ndarray, words: W.Words) -> np.ndarray:
    """Where each text's ids start among those of the group."""
    return np.concatenate([[0], np.cumsum(lengths)])[words.first]
