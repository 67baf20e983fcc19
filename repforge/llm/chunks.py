"""Ids of many texts through a table of distinct chunks.

Tokenizers never merge across certain blanks, so a text cut there can be
encoded chunk by chunk, and a chunk that was seen before costs one lookup.
The table is per Python worker and bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

#: Distinct chunks kept by a worker; a fuller table is emptied before the
#: next slice of texts.
MAX_CHUNKS = 600_000


class _Numbers(dict):
    """Numbers chunks in the order they come."""

    def __missing__(self, chunk):
        self[chunk] = n = len(self)
        self.fresh.append(chunk)
        return n


class ChunkIds:
    """``encode`` maps a list of new chunks to one list of ids (or other
    numbers) for each."""

    def __init__(self, encode: Callable[[list], list[list]], limit: int = MAX_CHUNKS, dtype=np.int32):
        self.encode, self.limit, self.dtype = encode, limit, dtype
        self.clear()

    def clear(self) -> None:
        self.index = _Numbers()
        self.index.fresh = []
        self.flat = np.empty(1 << 16, self.dtype)
        self.start = np.empty(1 << 14, np.int64)
        self.length = np.empty(1 << 14, np.int64)
        self.used = 0

    def _learn(self) -> None:
        """Encode the chunks that were numbered last."""
        fresh, self.index.fresh = self.index.fresh, []
        got = self.encode(fresh)
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        n, more = len(self.index), int(lengths.sum())
        while self.used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.flat[self.used: self.used + more] = np.fromiter(chain.from_iterable(got), self.dtype, more)
        self.start[n - len(got): n] = self.used + np.cumsum(lengths) - lengths
        self.length[n - len(got): n] = lengths
        self.used += more

    def ids(self, texts: list[list]) -> list[np.ndarray]:
        """The ids of each text, given as its list of chunks."""
        if len(self.index) > self.limit:
            self.clear()
        total = sum(map(len, texts))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, total)
        if self.index.fresh:
            self._learn()
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if total else 0
        out = self.flat[np.repeat(self.start[at] - (ends - lengths), lengths) + np.arange(n)]
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, texts)])]
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
