"""Benchmark decontamination (operator 10): a generalised suffix automaton of the normalised
test items; training words stream through it and the longest matching length ending at each
word decides which spans of a text repeat a test item.

Spark hashes and counts the items' words and deals them into blocks of at most ``BLOCK_WORDS``
words, so the item set may be of any size. A bitmap of the hashes of all windows of all blocks picks
the texts that may hold one; all others are done with, without a shuffle. The picked texts are
written once and run against the automaton of one block after the other, which is the only one that
a task holds; what the blocks find is put together by row. A word that no item of a block holds sends
the automaton to its root, so only runs of item words that are as long as the shortest window need
the stream.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bitmap_of, free_name, in_bitmap, share, shared, written
from .textbytes import ALNUM, hash_words, mix, shingles, text_chunks, word_bounds, words_of, _LOWER

WINDOW = 10
#: Words of a block of items; its automaton takes about 1.1 kB a word in a worker.
BLOCK_WORDS = 250_000
#: Bits of the bitmap of windows: 48 and more a window, within these sizes (8 kB to 32 MB), and bits
#: that a window sets. With that room one in 400,000 other windows is taken for one of an item.
LEAST_BITS, MOST_BITS, PROBES = 16, 28, 6


class SuffixAutomaton:
    """Generalised suffix automaton over integer sequences, online construction."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _add(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        """A copy of state ``q`` that ends the strings reached through ``p``."""
        clone = self._add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, symbol: int) -> int:
        """State after ``symbol`` from state ``last`` of the sequence being added."""
        q = self.next[last].get(symbol)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, symbol)
        state = self._add(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
        return state

    def add(self, sequence) -> None:
        state = 0
        for symbol in sequence:
            state = self.extend(state, symbol)

    def step(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        """State and longest matching length after reading ``symbol``."""
        while symbol not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return self.next[state][symbol], matched + 1


class ItemIndex:
    """Automaton of all items plus, for each window, the items that hold it.

    A window of ``width`` words is known by the automaton's state and matched length: the
    items of every window are kept under the window's symbols, so equal windows of several
    items count for each of them.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]], width: int) -> None:
        self.width = width
        self.vocabulary = np.unique(np.concatenate([w for _, w in items] or [np.zeros(0, np.uint64)]))
        self.automaton = SuffixAutomaton()
        self.owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            symbols = np.searchsorted(self.vocabulary, words).tolist()
            if symbols:
                self.automaton.add(symbols)
                size = min(width, len(symbols))
                for at in range(len(symbols) - size + 1):
                    self.owners.setdefault(tuple(symbols[at:at + size]), set()).add(item)
        self.sizes = sorted({len(w) for w in self.owners})
        bits = np.zeros(1 << 16, bool)
        bits[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.bits = bits

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word, -1 for words of no item."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe):
            found = np.searchsorted(self.vocabulary, hashes[maybe])
            found[found == len(self.vocabulary)] = 0
            known = self.vocabulary[found] == hashes[maybe]
            out[maybe[known]] = found[known]
        return out

    def stream(self, symbols: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans ``[start, end)`` of the sequence that are windows, and their items."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = 0
        step, shortest = self.automaton.step, self.sizes[0]
        for at, symbol in enumerate(symbols):
            state, matched = step(state, matched, symbol)
            if matched < shortest:
                continue
            for size in self.sizes:
                if size > matched:
                    break
                owners = self.owners.get(tuple(symbols[at + 1 - size:at + 1]))
                if owners:
                    spans.append((at + 1 - size, at + 1))
                    items |= owners
        return spans, items

    def runs(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of item words as long as the shortest window."""
        known = np.zeros(len(symbols) + 2, bool)
        known[1:-1] = symbols >= 0
        edge = np.flatnonzero(known[1:] != known[:-1])
        start, end = edge[::2], edge[1::2]
        long = end - start >= self.sizes[0]
        return start[long], end[long]


def item_pieces(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Written table ``(pack, item, n_words, words)`` of the items' word hashes; rows without an
    id or without words are left out, repeated rows count once. A task fills packs of at most a
    sixteenth of a block. Longer items are cut into pieces that share ``width - 1`` words, so that
    every window lies in one piece."""
    limit = max(1, BLOCK_WORDS // 16)
    items = (benchmark.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).distinct())

    def split(batches):
        pack, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, words in words_of(batch.column(1), ALNUM):
                out = []
                for i in range(words.n_texts):
                    hashes = words.hashes[words.first[i]:words.first[i + 1]]
                    for at in range(0, max(len(hashes) - width, 0) + 1 if len(hashes) else 0, limit):
                        piece = hashes[at:at + limit + width - 1]
                        if filled and filled + len(piece) > limit:
                            pack, filled = pack + 1, 0
                        filled += len(piece)
                        out.append((pack, names[row + i], len(piece), piece.astype("<u8").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.binary()))],
                    names=["pack", "item", "n_words", "words"])

    return written(items.mapInArrow(split, "pack long, item string, n_words long, words binary"), "benchmark-items")


class Items:
    """Blocks of a benchmark table's items, and the bitmap of all their windows."""

    def __init__(self, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> None:
        self.spark, self.width = benchmark.sparkSession, width
        self.pieces = item_pieces(benchmark, id_col, text_col, width)
        self.ranges: list[list[int]] = []
        total = 0
        for pack, n in sorted(self.pieces.groupBy("pack").agg(F.sum("n_words")).collect()):
            if not self.ranges or total + n > BLOCK_WORDS:
                self.ranges.append([pack, pack])
                total = 0
            self.ranges[-1][1] = pack
            total += n
        self.windows = WindowFilter(self.pieces, width)
        self._handles: dict[int, Broadcast] = {}

    def blocks(self):
        """Broadcast :class:`ItemIndex` of one block after the other."""
        for k, (low, high) in enumerate(self.ranges):
            if k not in self._handles:
                table = self.pieces.filter(F.col("pack").between(low, high)).select("item", "words").toArrow()
                items = [(item, np.frombuffer(words, "<u8")) for item, words in zip(table["item"].to_pylist(), table["words"].to_pylist())]
                self._handles[k] = share(self.spark, ItemIndex(items, self.width))
            yield self._handles[k]
            if len(self.ranges) > 1:
                self._handles[k].unpersist()


def _probe(hashes: np.ndarray, k: int) -> np.ndarray:
    return mix(hashes + np.uint64(k)) if k else hashes


class WindowFilter:
    """Tells the texts that may hold a window of an item; no text that holds one is missed."""

    def __init__(self, pieces: DataFrame, width: int) -> None:
        size = F.least(F.col("n_words"), F.lit(width))
        found = pieces.groupBy(size.alias("size")).agg(F.sum(F.col("n_words") - size + 1).alias("n")).collect()
        self.sizes = sorted(int(r["size"]) for r in found)
        bits = min(MOST_BITS, max(LEAST_BITS, (48 * sum(int(r["n"]) for r in found)).bit_length()))

        def hashes(batches):
            for batch in batches:
                for words in batch.column(0).to_pylist():
                    own = shingles(np.frombuffer(words, "<u8").astype(np.uint64), width)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_probe(own, k) for k in range(PROBES)]).view(np.int64))], names=["hash"])

        self.bitmap = bitmap_of(pieces.select("words").mapInArrow(hashes, "hash long"), bits)

    def judge(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and whether it may hold a window."""
        counts, flags = [], []
        for _, words in words_of(column, ALNUM):
            may = np.zeros(words.n_texts, bool)
            for size in self.sizes:
                if len(words.hashes) >= size:
                    runs = shingles(words.hashes, size)
                    at = np.arange(len(runs))
                    for k in range(PROBES):
                        at = at[in_bitmap(self.bitmap, _probe(runs[at], k))]
                    text = np.searchsorted(words.first, at, "right") - 1
                    may[text[at + size <= words.first[text + 1]]] = True
            counts.append(np.diff(words.first)), flags.append(may)
        return np.concatenate(counts or [np.zeros(0, np.int64)]), np.concatenate(flags or [np.zeros(0, bool)])


def _hits(index: ItemIndex, symbols: np.ndarray) -> tuple[np.ndarray, set[str]]:
    """Which words of one text lie in a window, and the items of those windows."""
    hit = np.zeros(len(symbols) + 1, np.int64)
    items: set[str] = set()
    if index.sizes:
        for start, end in zip(*index.runs(symbols)):
            spans, found = index.stream(symbols[start:end].tolist())
            items |= found
            for a, b in spans:
                hit[start + a] += 1
                hit[start + b] -= 1
    return np.cumsum(hit[:-1]) > 0, items


def _without(raw: np.ndarray, start: np.ndarray, end: np.ndarray, mask: np.ndarray) -> bytes:
    """The text without its hit words, each run of them cut from its first to its last byte."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    kept, since = [], 0
    for a, b in zip(edge[::2], edge[1::2]):
        kept.append(raw[since:start[a]].tobytes())
        since = end[b - 1]
    return b"".join([*kept, raw[since:].tobytes()])


def _split(column):
    """Per chunk of whole texts: first row, bytes, offsets, word starts and ends (bytes), first
    word of each text, word hashes."""
    for row, raw, offsets in text_chunks(column):
        data = _LOWER[raw]
        start, end, first = word_bounds(data, offsets, ALNUM)
        yield row, raw, offsets, start, end, first, hash_words(data, start, end)


def _matches(index: ItemIndex, column):
    """``(row, hit mask over its words, items)`` of each text of the column with a hit."""
    for row, _, _, _, _, first, hashes in _split(column):
        symbols = index.symbols(hashes)
        known = np.concatenate(([0], np.cumsum(symbols >= 0)))
        for i in np.flatnonzero(np.diff(known[first]) >= index.sizes[0]).tolist():
            mask, items = _hits(index, symbols[first[i]:first[i + 1]])
            if items:
                yield row + i, mask, items


def _hits_by_row(texts: DataFrame, items: Items, key: str) -> DataFrame:
    """``key, mask, items`` of the rows of ``(key, text)`` with a hit in any block: the hit words as
    packed bits. One block's automaton is in use at a time."""
    schema = f"`{key}` long, mask binary, items array<string>"

    def match(handle):
        def work(batches):
            index = shared(handle)
            for batch in batches:
                found = list(_matches(index, batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([r for r, _, _ in found], pa.int64())), pa.array([np.packbits(m).tobytes() for _, m, _ in found], pa.binary()),
                     pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string()))], names=[key, "mask", "items"])
        return work

    def merge(table: pa.Table) -> pa.Table:
        masks = [np.frombuffer(m, np.uint8) for m in table["mask"].to_pylist()]
        names = sorted({i for own in table["items"].to_pylist() for i in own})
        return pa.table({key: table[key][:1], "mask": pa.array([np.bitwise_or.reduce(masks).tobytes()], pa.binary()), "items": pa.array([names], pa.list_(pa.string()))})

    parts = [written(texts.mapInArrow(match(handle), schema), "benchmark-hits") for handle in items.blocks()]
    if not parts:
        return texts.sparkSession.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else reduce(DataFrame.union, parts).groupBy(key).applyInArrow(merge, schema)


def _suspects(docs: DataFrame, items: Items, text_col: str, key: str) -> DataFrame:
    """Written table of the rows that may hold a window, with a row number."""
    windows = share(docs.sparkSession, items.windows)
    at = docs.columns.index(text_col)

    def pick(batches):
        own = shared(windows)
        for batch in batches:
            yield batch.filter(pa.array(own.judge(batch.column(at))[1]))

    return written(docs.mapInArrow(pick, docs.schema).withColumn(key, F.monotonically_increasing_id()), "benchmark-suspects")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of each row.

    Words are runs of a-z (A-Z lower-cased), digits and non-ASCII characters. A window is
    ``width`` consecutive words of an item; an item of fewer words, but not none, is one window.
    A word is hit if it lies in an occurrence of a window. NULL and empty texts have no words;
    repeated rows each give a row; an empty item table hits nothing; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = Items(benchmark, width=width)
    windows = share(docs.sparkSession, items.windows)
    nothing = hashlib.sha256(b"").hexdigest()
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def batch_of(ids, words, hits, counts, digests):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    def clean(batches):
        own = shared(windows)
        for batch in batches:
            words, may = own.judge(batch.column(1))
            n = int((~may).sum())
            yield batch_of(batch.column(0).filter(pa.array(~may)), words[~may], [0] * n, [0] * n, [nothing] * n)

    def report(batches):
        own = shared(windows)
        for batch in batches:
            masks, names = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            hits = [int(np.unpackbits(np.frombuffer(m, np.uint8)).sum()) if m else 0 for m in masks]
            digests = [hashlib.sha256(",".join(sorted(x or ())).encode()).hexdigest() for x in names]
            yield batch_of(batch.column(0), own.judge(batch.column(1))[0], hits, [len(x or ()) for x in names], digests)

    suspects = _suspects(rows, items, "text", "row")
    found = suspects.join(_hits_by_row(suspects.select("row", "text"), items, "row"), "row", "left").select("doc_id", "text", "mask", "items")
    return rows.mapInArrow(clean, schema).union(found.mapInArrow(report, schema))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WINDOW,
                  max_coverage: float = 0.8) -> DataFrame:
    """``docs`` with spans that repeat test items cut out of the text; columns are unchanged.

    Hit words that follow each other form a span, at least a window long, which is cut from its
    first to its last character; if the words around a cut form a window, that is cut too. A row
    of which more than ``max_coverage`` of the words are hit is removed. Rows without a hit keep
    their text byte for byte; NULL texts stay NULL.
    """
    items = Items(benchmark, width=width)
    windows = share(docs.sparkSession, items.windows)
    columns, at = docs.columns, docs.columns.index(text_col)
    key, mask, changed = (free_name(docs, name) for name in ("row", "mask", "changed"))

    def clean(batches):
        own = shared(windows)
        for batch in batches:
            yield batch.filter(pa.array(~own.judge(batch.column(at))[1]))

    def cut(first_round: bool):
        def work(batches):
            for batch in batches:
                masks, texts = batch.column(len(columns) + 1).to_pylist(), batch.column(at).to_pylist()
                dropped = np.zeros(batch.num_rows, bool)
                hit = [i for i, m in enumerate(masks) if m]
                for row, raw, offsets, start, end, first, _ in _split(batch.column(at).take(pa.array(hit, pa.int64()))):
                    for k in range(len(offsets) - 1):
                        i, a, b = hit[row + k], first[k], first[k + 1]
                        own = np.unpackbits(np.frombuffer(masks[i], np.uint8), count=b - a).astype(bool)
                        if first_round and own.mean() > max_coverage:
                            dropped[i] = True
                        else:
                            texts[i] = _without(raw[offsets[k]:offsets[k + 1]], start[a:b] - offsets[k], end[a:b] - offsets[k], own).decode()
                out = pa.RecordBatch.from_arrays(
                    [*[pa.array(texts, batch.column(at).type) if k == at else batch.column(k) for k in range(len(columns))], pa.array([bool(m) for m in masks], pa.bool_())],
                    names=[*columns, changed])
                yield out.filter(pa.array(~dropped))
        return work

    flagged = T.StructType([*docs.schema.fields, T.StructField(changed, T.BooleanType())])
    done = [docs.mapInArrow(clean, docs.schema)]
    rest, first_round = docs, True
    while True:
        suspects = _suspects(rest, items, text_col, key)
        hits = _hits_by_row(suspects.select(key, F.col(text_col).alias("text")), items, key).select(key, F.col("mask").alias(mask))
        both = suspects.join(hits, key, "left").select(*columns, key, mask)
        out = written(both.mapInArrow(cut(first_round), flagged), "benchmark-cut")
        # A written table has lost which columns are never NULL; the schema says it again.
        done.append(out.filter(~F.col(changed)).select(columns).mapInArrow(lambda batches: batches, docs.schema))
        # Words that a cut brings together can form a window again.
        rest, first_round = out.filter(changed).select(columns), False
        if rest.isEmpty():
            return reduce(DataFrame.union, done)
        done.append(rest.mapInArrow(clean, docs.schema))
