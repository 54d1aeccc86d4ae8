"""What the operators share: reading tables, lineage cuts, Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of up to a few numbers that a broadcast may hold; larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Stands for a null doc_id while rows are joined; outputs turn it back into null.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch while texts pass through Python. Spark's 10,000 take tens of MB in each worker, several times over.
BATCH = 1000


def lean(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH rows; smaller settings stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, str(BATCH))


def texts_of(docs: DataFrame, *more) -> DataFrame:
    """doc_id (long, NO_ID for null), text ('' for null) and `more`; all other columns go."""
    lean(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def real_id(name: str = "doc_id"):
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder, so that a lost executor costs no recomputation.

    The folder is that of spark.checkpoint.dir; where that is unset (as in tests) it is one in the warehouse.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df.checkpoint(eager=True)


def free(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more, as after a cut()."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """ids with a broadcast hint when it is counted to hold few rows; larger sides are joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def released(make: Callable) -> Callable:
    """make, a function for mapInArrow, that gives unused memory back at a task's end: workers outlive a stage and would keep it."""

    def run(batches):
        yield from make(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run


class Memo:
    """Values of byte strings in two generations: when the newer one holds `room` bytes, what wasn't met since then goes.

    Workers outlive a stage, so a memo is bounded by its bytes; each entry counts EACH bytes besides its own.
    """

    EACH = 160

    def __init__(self, room: int):
        self.room, self.held = room, 0
        self.new: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def find(self, keys: list[bytes], make) -> list[tuple]:
        """The value of each key: a tuple of byte strings or texts, made by make(keys) for keys that aren't held."""
        if self.held > self.room:
            self.new, self.old, self.held = {}, self.new, 0
        new, old = self.new, self.old
        missing = [k for k in keys if k not in new]
        again = {k: old[k] for k in missing if k in old}
        fresh = [k for k in missing if k not in again] if again else missing
        again.update(zip(fresh, make(fresh) if fresh else (), strict=True))
        new.update(again)
        self.held += sum(self.EACH + len(k) + sum(map(len, v)) for k, v in again.items())
        return list(map(new.__getitem__, keys))


def crc_bucket(ids: np.ndarray, mod: int) -> np.ndarray:
    """crc32 of each id's decimal text, modulo mod."""
    return np.fromiter((zlib.crc32(b"%d" % i) % mod for i in ids.tolist()), np.int64, len(ids))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    n = len(column)
    _, at, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(at, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def slices(at: np.ndarray, size: int):
    """Ranges of rows that hold about `size` units each (one row at least)."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
