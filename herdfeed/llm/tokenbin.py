"""Token-ID output (operator 2): Simple-8b word-aligned coding.

File format: a folder of Parquet files, one row per block, so that every store Spark reaches can
hold it and commits are Spark's. Columns: ``shard``, ``block`` (number in the shard), ``first``
(ids of the shard before the block), ``n_ids``, ``doc_ids`` and ``doc_ends`` (last id + 1 of each
document, in the block) and ``payload``. Shards are ascending ranges of the sort key; documents
lie whole in one block, a block takes documents until it has ``BLOCK_IDS`` ids.

Payload, little-endian: uint32 words, uint32 offsets, uint32 escapes; the 64-bit words; the
offsets; the escapes. The top four bits of a word are its selector, the low 60 bits hold
``COUNTS[selector]`` values of ``BITS[selector]`` bits, first value lowest; a last word may hold
fewer. ``COUNTS`` 240 and 120 are runs of zeros. Selector 15 is an escape: the low bits number
an entry of the escapes, for a value of more than 60 bits. Offset ``k`` is the number of ids
before word ``k * OFFSET_WORDS``, so a reader can start at any of these words.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import encoded_runs, read_tokenizer, worker_encoder

# Fixed values of the code: values per word and bits per value, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: One value of up to 60 bits takes the place of a 16th selector; the escape shares it by bit 59.
ESCAPE_BIT = np.uint64(1 << 59)
OFFSET_WORDS = 128
BLOCK_IDS = 1 << 16


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; 0 for zero."""
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    high = values >> np.uint64(32)
    if high.any():
        low = np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], low)
    return low.astype(np.uint8)


def encode_block(values: np.ndarray) -> bytes:
    """Payload of unsigned 64-bit ``values``."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(3, "<u4").tobytes()
    width = _widths(values)
    # Widest value of the next c values, for every start, by doubling; past the end counts 0.
    selector = np.full(n, 15, np.uint8)
    tables = {1: width}
    size, narrowest = 1, int(width.min())
    usable = [s for s in range(14, -1, -1) if BITS[s] >= narrowest]
    while size * 2 <= COUNTS[usable[-1]] if usable else False:
        last = tables[size]
        shifted = np.concatenate((last[size:], np.zeros(min(size, n), np.uint8)))[:n]
        tables[size * 2] = np.maximum(last, shifted)
        size *= 2
    for s in usable:
        c, b = int(COUNTS[s]), int(BITS[s])
        half = 1 << (c.bit_length() - 1)
        most = tables[half]
        if half != c:
            back = c - half
            most = np.maximum(most, np.concatenate((most[back:], np.zeros(min(back, n), np.uint8)))[:n])
        np.copyto(selector, s, where=most <= b)
    step = COUNTS[selector]
    follow = (np.arange(n) + step).tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = follow[at]
    start = np.array(starts, np.int64)
    chosen = selector[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate((values, np.zeros(240, np.uint64)))
    for s in np.unique(chosen):
        if BITS[s]:
            rows = np.flatnonzero(chosen == s)
            if s == 15:
                continue
            block = padded[start[rows][:, None] + np.arange(COUNTS[s])] << (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
            words[rows] |= np.bitwise_or.reduce(block, axis=1)
    single = np.flatnonzero(chosen == 15)
    wide = width[start[single]] > 59
    words[single[~wide]] |= values[start[single[~wide]]]
    words[single[wide]] |= ESCAPE_BIT | np.arange(wide.sum(), dtype=np.uint64)
    escapes = values[start[single[wide]]]
    offsets = start[::OFFSET_WORDS].astype("<u4")
    head = np.array([len(words), len(offsets), len(escapes)], "<u4")
    return head.tobytes() + words.astype("<u8").tobytes() + offsets.tobytes() + escapes.astype("<u8").tobytes()


def decode_block(payload: bytes, n_ids: int, first_group: int = 0) -> np.ndarray:
    """Values of a payload, all at once; from offset number ``first_group`` on if given."""
    n_words, n_offsets, n_escapes = np.frombuffer(payload, "<u4", 3).tolist()
    words = np.frombuffer(payload, "<u8", n_words, 12)
    offsets = np.frombuffer(payload, "<u4", n_offsets, 12 + 8 * n_words)
    escapes = np.frombuffer(payload, "<u8", n_escapes, 12 + 8 * n_words + 4 * n_offsets)
    if first_group:
        words, n_ids = words[first_group * OFFSET_WORDS:], n_ids - int(offsets[first_group])
    selector = (words >> np.uint64(60)).astype(np.int64)
    start = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    out = np.zeros(n_ids + 240, np.uint64)
    for s in np.unique(selector):
        if not BITS[s]:
            continue
        rows = np.flatnonzero(selector == s)
        body = words[rows] & np.uint64((1 << 60) - 1)
        if s == 15:
            wide = body & ESCAPE_BIT != 0
            body[wide] = escapes[(body[wide] ^ ESCAPE_BIT).astype(np.int64)]
            out[start[rows]] = body
        else:
            shifts = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
            out[start[rows][:, None] + np.arange(COUNTS[s])] = body[:, None] >> shifts & np.uint64((1 << int(BITS[s])) - 1)
    return out[:n_ids]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 2) -> None:
    """Write the ids of every text, ``end_id`` after each, in ascending order of ``id_col``.

    NULL and empty texts are the end id alone. NULL ids come first; equal ids are ordered by
    their text's hash, and each row is written. Other columns are not read. An empty table
    gives files without blocks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    tokenizer = read_tokenizer(tokenizer_path)

    def encode(batches):
        encoder = worker_encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        block = before = 0
        names: list = []
        parts: list[np.ndarray] = []
        ends: list[int] = []
        size = 0
        id_type = pa.null()

        def flush():
            nonlocal block, before, size
            row = {"shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "first": pa.array([before], pa.int64()),
                   "n_ids": pa.array([size], pa.int64()), "doc_ids": pa.array([names], pa.list_(id_type)),
                   "doc_ends": pa.array([ends], pa.list_(pa.int64())),
                   "payload": pa.array([encode_block(np.concatenate(parts))], pa.binary())}
            block, before, size = block + 1, before + size, 0
            names.clear(), parts.clear(), ends.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            id_type = batch.column(0).type
            own = batch.column(0).to_pylist()
            for at, ids, bounds in encoded_runs(encoder, batch.column(1), end_id):
                for i in range(len(bounds) - 1):
                    names.append(own[at + i])
                    parts.append(ids[bounds[i]:bounds[i + 1]])
                    size += len(parts[-1])
                    ends.append(size)
                    if size >= BLOCK_IDS:
                        yield flush()
        if size:
            yield flush()

    schema = f"shard int, block int, first long, n_ids long, doc_ids array<{kind}>, doc_ends array<long>, payload binary"
    ordered.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, base)``: ids before each shard, from the small columns of the files. There is
    a row per shard (a task of the write), so the sums go through the driver."""
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    base, rows = 0, []
    for shard, n in sorted(sizes):
        rows.append((shard, base))
        base += n
    return spark.createDataFrame(rows, "shard int, base long")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each document in the files."""
    blocks = spark.read.parquet(path).join(F.broadcast(shard_starts(spark, path)), "shard")
    blocks = blocks.select(F.expr("base + first").alias("first"), "n_ids", "doc_ids", "doc_ends", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = decode_block(batch.column(4)[k].as_py(), batch.column(1)[k].as_py()).astype("<u4")
                names = batch.column(2)[k].values
                ends = batch.column(3)[k].values.to_numpy()
                start = np.concatenate(([0], ends[:-1]))
                columns = [names, pa.array(start + batch.column(0)[k].as_py(), pa.int64()), pa.array(ends - start, pa.int64()),
                           pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(start, ends)], pa.int64())]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(start, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return blocks.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
