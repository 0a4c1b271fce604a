"""Rows of ids of different lengths in one growing numpy array, and a bounded cache of words over them."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rows ``flat[start : start + size]`` one after the other."""
    total = np.cumsum(size)
    return flat[np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)]


class Ragged:
    """Rows are added at the end and taken by their numbers; memory doubles when it is full."""

    def __init__(self) -> None:
        self.flat, self.start, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.rows = 0

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])

    def add(self, flat: np.ndarray, size: np.ndarray) -> int:
        """Appends the rows and returns the number of the first."""
        first, n, m = self.rows, len(size), len(flat)
        self.flat = self._room(self.flat, self.used + m)
        self.start, self.size = self._room(self.start, first + n), self._room(self.size, first + n)
        self.flat[self.used : self.used + m] = flat
        self.size[first : first + n] = size
        self.start[first : first + n] = self.used + np.cumsum(size) - size
        self.used, self.rows = self.used + m, first + n
        return first

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[rows]
        return gather(self.flat, self.start[rows], size), size


class WordCache:
    """Numbers of words in one or more ``Ragged`` stores; a full cache starts again.

    ``learn`` gets an Arrow array of different words that are not known, adds their rows to every
    store in that order and returns nothing.  A word of more than ``long`` characters is forgotten
    with its batch's dictionary, but its ids stay until the cache starts again.
    """

    def __init__(self, stores: int, most: int, long: int):
        self.most, self.long, self.count = most, long, stores
        self.clear()

    def clear(self) -> None:
        self.stores = [Ragged() for _ in range(self.count)]
        self.number: dict[str, int] = {}

    def full(self) -> bool:
        return self.stores[0].rows > self.most or self.stores[0].used > 8 * self.most

    def find(self, words: pa.Array, learn: Callable[[pa.Array], None]) -> np.ndarray:
        """The row of each of the different ``words``."""
        listed = words.to_pylist()
        out = np.fromiter(map(self.number.get, listed, repeat(-1)), np.int64, len(listed))
        gaps = np.flatnonzero(out < 0)
        if len(gaps):
            missing = words.take(pa.array(gaps))
            learn(missing)
            first = self.stores[0].rows - len(gaps)
            out[gaps] = np.arange(first, first + len(gaps))
            names = [listed[i] for i in gaps.tolist()]
            if max(map(len, names)) > self.long:
                self.number.update((w, k) for k, w in enumerate(names, first) if len(w) <= self.long)
            else:
                self.number.update(zip(names, range(first, first + len(names))))
        return out
