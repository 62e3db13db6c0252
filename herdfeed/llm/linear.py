"""Small helpers of the linear text classifiers: hashed character n-grams, sparse rows, and
bounded labelled samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap_of, in_bitmap

_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text; every run of ASCII non-letters is one blank, with
    a blank at both ends. Empty if there is nothing but blanks."""
    if not text:
        return np.zeros(0, np.uint64)
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (x < 97) | ((x > 122) & (x < 192))
    x = np.where(blank, 32, x)
    x = np.concatenate(([32], x, [32])).astype(np.uint64)
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = x[keep]
    return x if len(x) > 1 else np.zeros(0, np.uint64)


def grams(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed n-grams (one entry an occurrence) of the code points."""
    out, h = [], points
    for n in range(1, max(sizes) + 1):
        if n > 1:
            if len(h) < 2:
                break
            h = h[:-1] * _STEP + points[n - 1:]
        if n in sizes:
            out.append(((h + np.uint64(n)) * _STEP ^ (h >> np.uint64(29))) * _STEP >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def distinct(values: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The values, each once, in the order of their last places; ``scratch`` has room for each value
    and may hold anything. Unlike a sort it takes time in proportion."""
    at = np.arange(len(values), dtype=scratch.dtype)
    scratch[values] = at
    return values[scratch[values] == at]


class SparseRows:
    """Rows of ``(column, value)`` entries, held flat in 32 bits; products go through some rows at a
    time, so they need little more room than the rows themselves."""

    ENTRIES = 1 << 18

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], columns: int) -> None:
        bounds = np.concatenate(([0], np.cumsum([len(i) for i, _ in rows], dtype=np.int64)))
        self._hold(bounds, np.concatenate([np.asarray(i, np.int32) for i, _ in rows] or [np.zeros(0, np.int32)]),
                   np.concatenate([np.asarray(v, np.float32) for _, v in rows] or [np.zeros(0, np.float32)]), columns)

    @classmethod
    def flat(cls, bounds: np.ndarray, column: np.ndarray, value: np.ndarray, columns: int) -> SparseRows:
        """Rows ``bounds[i]:bounds[i + 1]`` of the entries."""
        own = cls.__new__(cls)
        own._hold(bounds, column.astype(np.int32), value.astype(np.float32), columns)
        return own

    def _hold(self, bounds, column, value, columns) -> None:
        self.bounds, self.column, self.value = bounds, column, value
        self.shape = (len(bounds) - 1, columns)
        self.blocks, at = [], 0
        while at < self.shape[0]:
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + self.ENTRIES, "right")) - 1)
            self.blocks.append((at, stop))
            at = stop

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape[0])
        for first, stop in self.blocks:
            a, b = self.bounds[first], self.bounds[stop]
            upto = np.concatenate(([0.0], np.cumsum(self.value[a:b] * w[self.column[a:b]])))
            out[first:stop] = np.diff(upto[self.bounds[first:stop + 1] - a])
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape[1])
        for first, stop in self.blocks:
            a, b = self.bounds[first], self.bounds[stop]
            out += np.bincount(self.column[a:b], self.value[a:b] * np.repeat(g[first:stop], np.diff(self.bounds[first:stop + 1])), self.shape[1])
        return out


def minimise(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero; deterministic."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def usable_labels(labels: DataFrame, id_col: str, label_col: str, keep: Column) -> DataFrame:
    """``(doc_id, label)`` of the ids labelled 0 or 1. Rows without an id or label, and ids with
    labels that disagree, are left out; ``keep`` (over ``doc_id``) says which ids may be learnt from."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").filter(keep).select("doc_id", "label"))


def sampled_labels(labels: DataFrame, id_col: str, label_col: str, keep: Column, bound: int) -> DataFrame:
    """``(doc_id, label)``: at most ``bound`` :func:`usable_labels` of each of the classes 0 and 1,
    the first in the order of the id's hash."""
    clean = usable_labels(labels, id_col, label_col, keep)
    by_hash = F.xxhash64("doc_id")
    part = [clean.filter(F.col("label") == k).orderBy(by_hash, "doc_id").limit(bound) for k in (0, 1)]
    return part[0].union(part[1])


def class_weights(labels: DataFrame, id_col: str, label_col: str, keep: Column, bound: int) -> np.ndarray:
    """Usable labels that each row of class 0 and 1 of :func:`sampled_labels` stands for: 1 for a
    class within ``bound``. With them a sample has the class mix of all usable labels."""
    sizes = dict(usable_labels(labels, id_col, label_col, keep).groupBy("label").count().collect())
    return np.array([max(1.0, sizes.get(k, 0) / bound) for k in (0, 1)])


def labelled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, label, text)`` of the chosen ids, one row an id: of rows that repeat an id the one
    whose text has the least hash, so there are never more rows than labels."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(least).select("doc_id", "label", "least.text")


def _room(n: int) -> int:
    """Bits (as a power of two) of a bitmap for ``n`` ids: 16 and more an id, 2 kB to 32 MB."""
    return min(28, max(14, (16 * n).bit_length()))


def texts_of_labels(docs: DataFrame, usable: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(label, text)`` of every row with a usable label. A bitmap of the labelled ids drops nearly
    all other rows where they are read, so the texts that are shuffled are those that count."""
    bits = _room(usable.count())
    held = docs.sparkSession.sparkContext.broadcast(bitmap_of(usable.select(F.xxhash64("doc_id")), bits))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("doc_id"))

    def pick(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(held.value, batch.column(2).to_numpy()))).select([0, 1])

    picked = texts.mapInArrow(pick, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, text string")
    # The hint keeps the plan the same at every size.
    return picked.join(usable.hint("merge"), "doc_id").select("label", "text")
