"""Packing (operator 1): minimum bin slack. Each window is filled by a bitset subset-sum
dynamic programme over the multiset of remaining lengths, with counts found by backtracking.

Every input partition packs its own documents, so nothing is shuffled and a lost task is
simply run again. A document's full windows are cut off first; the remainder (under one
window) waits in a pool of at most ``POOL`` remainders. When the pool is full, windows are
filled from it until ``POOL // 4`` are left. At the partition's end the last slack is closed by
cutting a remainder, and the last ids go to sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoded_runs, read_tokenizer, worker_encoder

POOL = 4096


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length to take so that their sum is as near ``capacity`` as
    any choice gets, without exceeding it.

    Bit ``t`` of the bitset says that the lengths looked at so far can sum to ``t``. A length
    held ``c`` times enters as 1, 2, 4, ... copies, so every count up to ``c`` can be chosen.
    Long pieces come first; the search ends when the capacity itself is reached.
    """
    reach, limit = 1, (1 << (capacity + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity & 1:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & limit
            left -= take
            copies *= 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


class Packer:
    """Packs the documents of one partition. A piece is ``(document, start, ids)``."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window = window
        self.sequence = first_sequence
        self.pool: dict[int, list] = {}
        self.size = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for document, start, ids in pieces:
            self.out.append((document, start, ids, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _hold(self, piece) -> None:
        self.pool.setdefault(len(piece[2]), []).append(piece)
        self.size += 1

    def _take(self, length: int):
        held = self.pool[length]
        piece = held.pop()
        if not held:
            del self.pool[length]
        self.size -= 1
        return piece

    def add(self, document, ids: np.ndarray) -> None:
        start = 0
        while len(ids) - start >= self.window:
            self._emit([(document, start, ids[start:start + self.window])])
            start += self.window
        if start < len(ids):
            self._hold((document, start, ids[start:].copy()))
        if self.size >= POOL:
            self._pack(POOL // 4)

    def _pack(self, leave: int) -> None:
        while self.size > leave:
            pieces = [self._take(max(self.pool))]
            slack = self.window - len(pieces[0][2])
            for length, n in fill_window({k: len(v) for k, v in self.pool.items()}, slack).items():
                pieces += [self._take(length) for _ in range(n)]
                slack -= length * n
            if slack and self.pool:  # no choice fits exactly: cut the shortest piece that is longer
                document, start, ids = self._take(min(k for k in self.pool if k > slack))
                pieces.append((document, start, ids[:slack]))
                self._hold((document, start + slack, ids[slack:]))
                slack = 0
            if slack:
                self._close(pieces)
            else:
                self._emit(pieces)

    def _close(self, pieces: list) -> None:
        """The last pieces, cut into sequences of powers of two."""
        total = sum(len(p[2]) for p in pieces)
        for size in (1 << k for k in reversed(range(total.bit_length())) if total >> k & 1):
            part = []
            while size:
                document, start, ids = pieces.pop(0)
                part.append((document, start, ids[:size]))
                if len(ids) > size:
                    pieces.insert(0, (document, start + size, ids[size:]))
                size -= len(part[-1][2])
            self._emit(part)

    def finish(self) -> None:
        self._pack(0)

    def drain(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    (and the piece's ``ids`` if ``with_ids``).

    A document is its text's ids followed by ``end_id``; NULL and empty texts are that one id.
    Repeated rows are packed each; NULL ids stay NULL; other columns are not read; an empty
    table gives none. Every id lies in exactly one piece; offsets in a sequence are gapless.
    ``sequence_id`` counts on from the input partition's number times 2**40.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokenizer = read_tokenizer(tokenizer_path)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        encoder = worker_encoder(tokenizer)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        id_type = pa.null()

        def rows_of(pieces):
            document, start, ids, sequence, offset = zip(*pieces)
            columns = {
                "doc_id": pa.array([d for d, _ in document], id_type), "start": pa.array(start, pa.int64()),
                "length": pa.array([len(x) for x in ids], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                "doc_tokens": pa.array([n for _, n in document], pa.int64()),
                "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            id_type = batch.column(0).type
            names = batch.column(0).to_pylist()
            for first, ids, bounds in encoded_runs(encoder, batch.column(1), end_id):
                for i in range(len(bounds) - 1):
                    own = ids[bounds[i]:bounds[i + 1]]
                    packer.add((names[first + i], len(own)), own)
                if packer.out:
                    yield rows_of(packer.drain())
        packer.finish()
        if packer.out:
            yield rows_of(packer.drain())

    return rows.mapInArrow(pack, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
                           + ", ids array<int>" * with_ids)
