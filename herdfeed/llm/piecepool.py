"""Bounded memory of a Python worker: arrays of numbers, known by the 64-bit hash of a piece of text."""

from __future__ import annotations

import ctypes
import sys
import types

import numpy as np

from .tokens import _Table as HashTable


class PiecePool:
    """Hash of a piece to its arrays of numbers, one for each of ``dtypes``. At most ``most``
    pieces; a caller that has more empties the pool and puts the pieces that it needs again."""

    def __init__(self, most: int, *dtypes) -> None:
        self.most, self.dtypes = most, dtypes
        self.empty()

    def empty(self) -> None:
        self.table = HashTable(self.most)
        self.pieces = 0
        self.used = [0] * len(self.dtypes)
        # Pieces lie one after the other: a piece ends where the next one starts.
        self.start = [np.zeros(1 << 12, np.int64) for _ in self.dtypes]
        self.pool = [np.zeros(1 << 14, x) for x in self.dtypes]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, -1 where unknown."""
        return self.table.find(keys)

    def put(self, keys: np.ndarray, *columns: tuple[np.ndarray, np.ndarray]) -> None:
        """Add distinct, unknown pieces; a column is the pieces' arrays one after the other, and
        the size of each."""
        stop = self.pieces + len(keys)
        for k, (flat, sizes) in enumerate(columns):
            used = self.used[k] + len(flat)
            self.start[k] = _with_room(self.start[k], self.pieces + 1, stop + 1)
            self.pool[k] = _with_room(self.pool[k], self.used[k], used)
            self.pool[k][self.used[k]:used] = flat
            self.start[k][self.pieces + 1:stop + 1] = self.used[k] + np.cumsum(sizes)
            self.used[k] = used
        self.table.add(keys, np.arange(self.pieces, stop, dtype=np.int32))
        self.pieces = stop

    def gather(self, numbers: np.ndarray, column: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """A column's arrays of the pieces one after the other, and the size of each."""
        first = self.start[column][numbers]
        sizes = self.start[column][numbers + 1] - first
        return gather_runs(self.pool[column], first, sizes), sizes


def _with_room(held: np.ndarray, used: int, needed: int) -> np.ndarray:
    """``held``, or its first ``used`` numbers in an array of half as much again, for ``needed`` ones.
    New room is memory only once it is written to."""
    if needed <= len(held):
        return held
    more = np.zeros(max(len(held) * 3 // 2, needed), held.dtype)
    more[:used] = held[:used]
    return more


def gather_runs(pool: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``pool[start[i]:start[i] + sizes[i]]`` for every i, one after the other."""
    upto = np.cumsum(sizes)
    return pool[np.repeat(start - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]


def worker_kept(name: str, make):
    """An object of this Python worker, made once and kept from task to task."""
    kept = sys.modules.setdefault("_herdfeed_llm_worker", types.ModuleType("_herdfeed_llm_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def give_back() -> None:
    """Give memory that this worker has freed back to the system, where the C library does so."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
