"""Helpers shared by the corpus operators: inputs, scratch tables and bounded Arrow chunks."""

from __future__ import annotations

import atexit
import gc
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Used only by a local session that names no spark.checkpoint.dir, as in tests.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Tables written between two collections of the driver's garbage.
TIDY = 4
_written: list = []
_since = 0


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers started beside the driver import this package (a cluster ships it with --py-files)."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. A cluster has to name it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session or its gateway may be gone by the end of the process
        pass


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        _delete(spark, path)


def tidy(spark: SparkSession) -> None:
    """Frees what finished steps left in the driver: their plans hold broadcast tables and the status of shuffles until both
    Python's and the JVM's garbage is collected, which the JVM puts off until its heap is full."""
    global _since
    _since = 0
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, so that a lost executor
    costs a read and not a recomputation. The tables go by discard(), or when the driver's process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/scrivena/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    global _since
    _since += 1
    if _since >= TIDY:
        tidy(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by scratch() that nothing reads any more."""
    for t in tables:
        path = t._scratch_path
        _delete(t.sparkSession, path)
        _written[:] = [w for w in _written if w[1] != path]


def numbered(rows: DataFrame, name: str, label: str) -> DataFrame:
    """rows, written, with dense numbers from 0 in the order of their partitions and of the rows inside."""
    found = scratch(rows.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    counts = found.groupBy(part.alias("_p")).agg(F.count("*").alias("_c"))  # a row for each partition
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = found.withColumn("_p", part).join(F.broadcast(counts.select("_p", before.alias("_b"))), "_p")
    out = out.withColumn(name, F.col("_b") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_p", "_b")
    out._scratch_path = found._scratch_path
    return out


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id long, text string and tk, the text's hash (and the columns named in more), whatever else df holds.

    tk keeps rows apart that share a doc_id but not the text; rows that share both are copies of one document.

    Rows whose doc_id is null cannot be named in a result and are left out. Column names that clash with those that
    the operators use inside do no harm, as only these columns go on.
    """
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return df.select(*cols, F.xxhash64(F.col("text").cast("string")).alias("tk"), *(F.col(c) for c in more)).where(F.col("doc_id").isNotNull())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices whose texts hold about max_bytes at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(col: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def covered(n: int, starts, ends) -> np.ndarray:
    """Which of n places lie in one of the intervals [start, end)."""
    if not len(starts):
        return np.zeros(n, bool)
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, np.asarray(starts), 1)
    np.add.at(d, np.asarray(ends), -1)
    return np.cumsum(d[:-1]) > 0


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP, _BACK = 0x9FB21C651E98DF25, pow(0x9FB21C651E98DF25, -1, 1 << 64)


class _Powers:
    """Powers of the word hash's base and of its inverse, as many as were asked for so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def first(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate((cls.up, cls.up * np.uint64(pow(_STEP, k, 1 << 64))))
            cls.down = np.concatenate((cls.down, cls.down * np.uint64(pow(_BACK, k, 1 << 64))))
        return cls.up[:n], cls.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_at(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ in an array of bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[text], [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words, end to end, and how many words each text has. lower: A-Z count as a-z.

    A word's hash is a polynomial in random byte values, taken from prefix sums over all texts, and mixed.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        data = _LOWER[data]
    start, end = words_at(data)
    up, down = _Powers.first(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * up, dtype=np.uint64)))
    h = (sums[end] - sums[start]) * down[start]
    count = np.diff(np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes)))))
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), count
