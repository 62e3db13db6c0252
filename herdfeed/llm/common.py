"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of this package (pickled by value); read it with :func:`shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(handle: Broadcast):
    return cloudpickle.loads(handle.value)


SLICE = 1 << 14  # counters a row of a partial count array holds
FAN_IN = 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of an Arrow batch of texts. The JVM and the Python worker hold a batch several
#: times over, and both keep the memory that they once had.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Let this session send texts to Python workers in small batches. Jobs call it; the
    operators themselves leave the session's settings alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it if a column is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """``2 ** bits`` bits as unsigned 64-bit words, with the slot ``hash mod 2 ** bits`` of every row
    of the one column set. Spark puts the words together; the driver gets them alone."""
    h = F.col(hashes.columns[0])
    slot = F.pmod(h, F.lit(1 << bits))
    words = (hashes.groupBy(F.shiftright(slot, 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the slot of each (64-bit) hash is set."""
    at = hashes.view(np.uint64) & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def id_remainder(id_col: str | Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``: a split that ignores row order.
    NULL ids give NULL."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % mod


def partial_counts(counts: np.ndarray):
    """Rows ``(slice, part, counts)`` of one task's array of counters (int64)."""
    part = TaskContext.get().partitionId()
    for k, at in enumerate(range(0, len(counts), SLICE)):
        piece = counts[at:at + SLICE]
        if piece.any():
            packed = b"4" + piece.astype("<i4").tobytes() if piece.max() < 1 << 31 else b"8" + piece.astype("<i8").tobytes()
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()),
                "counts": pa.array([packed], pa.binary())})


PARTIAL_COUNTS = "slice int, part int, counts binary"


def sum_counts(df: DataFrame, n_parts: int, size: int) -> np.ndarray:
    """Sum the tasks' partial counters in a tree: groups of ``FAN_IN`` rows of one slice, so
    no task holds more than that, whatever the number of input partitions. Only the final
    array of ``size`` counters comes to the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for raw in table["counts"].to_pylist():
            piece = _unpack(raw)
            total[:len(piece)] += piece
        return pa.table({"slice": table["slice"][:1], "part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int32()),
                         "counts": pa.array([b"8" + total.tobytes()], pa.binary())})

    while True:
        df = df.groupBy("slice", F.floor(F.col("part") / FAN_IN)).applyInArrow(add, PARTIAL_COUNTS)
        n_parts = -(-n_parts // FAN_IN)
        if n_parts <= 1:
            break
    out = np.zeros(-(-size // SLICE) * SLICE, np.int64)
    for k, raw in df.select("slice", "counts").collect():
        piece = _unpack(bytes(raw))
        out[k * SLICE:k * SLICE + len(piece)] += piece
    return out[:size]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, each in as few bytes (1, 2, 4 or 8) as the largest takes."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return b"%d" % kind.itemsize + numbers.astype(kind.newbyteorder("<")).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """The numbers of :func:`packed` (int64)."""
    return np.frombuffer(raw, f"<u{int(raw[:1])}", offset=1).astype(np.int64)


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if raw[:1] == b"4" else "<i8", offset=1)
