"""Vectorised word splitting and hashing of UTF-8 text straight from Arrow buffers.

Word classes are byte classes: every rule used here only names ASCII characters, so bytes
0x80-0xFF (parts of multi-byte characters) are always word bytes and no decoding is needed.
Work goes through chunks of whole texts of about ``CHUNK_BYTES``; memory is bounded by the
chunk size or the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

#: ``[^\x20\x09-\x0D]+``: everything but the six ASCII white-space characters.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z, all non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of ``n_texts`` texts: ``hashes`` of all words in order; words of text ``i`` are
    ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.first) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (splitmix64) on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_MULTIPLIER, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of whole texts; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, column.offset + n + 1)[column.offset:]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[at] = inside[at]
    ends = inside[:-1] & ~inside[1:]
    last = at[1:] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: polynomial over random byte values, then mixed."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def words_of(column: pa.Array, is_word: np.ndarray) -> Iterator[tuple[int, Words]]:
    """``(first row, Words)`` per chunk of lower-cased (A-Z) texts."""
    for row, data, offsets in text_chunks(column):
        data = _LOWER[data]
        start, end, first = word_bounds(data, offsets, is_word)
        yield row, Words(hash_words(data, start, end), first)


def hash_word_list(words: list[str]) -> np.ndarray:
    """Hashes of already lower-cased words, equal to those of :func:`words_of`."""
    column = pa.array(words, pa.large_string())
    return np.concatenate([hash_words(d, o[:-1], o[1:]) for _, d, o in text_chunks(column)] or [np.zeros(0, np.uint64)])


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; a shorter, non-empty text gives one."""
    if not len(hashes):
        return hashes
    if len(hashes) < width:
        width = len(hashes)
    n = len(hashes) - width + 1
    total = hashes[:n].copy()
    for k in range(1, width):
        total = mix(total) + hashes[k:k + n] * np.uint64(2 * k + 1)
    return mix(total + np.uint64(width))
