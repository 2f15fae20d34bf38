"""Shared helpers of the training-data operators: scratch tables and vectorised text.

Texts reach Python as Arrow batches. A batch may hold ten thousand whole
documents, so every helper works through it in slices of ``SLICE_BYTES`` of
text; the memory of a task follows the slice (or the longest single document),
not the batch or the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.session import scratch_path
from lakevault.sources.versioned import delete_folder

SLICE_BYTES = 1 << 20
U64 = np.uint64

# bytes of a word: anything but \x20 and \x09-\x0D (multi-byte characters have no such byte)
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: odd multipliers of the polynomial hashes over bytes, and of two over words
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
WORD_BASE_2 = 0xD6E8FEB86659FD93


def stored(df: DataFrame, name: str, *partition_by: str, **options) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch root and read it back.

    Cuts the lineage: a lost executor later costs a re-read, not a re-run.
    ``discard`` deletes the folder once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``stored`` returned; no other frame may still read them."""
    for frame in frames:
        path = getattr(frame, "_scratch", None)
        if path:
            delete_folder(frame.sparkSession, path)


def text_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, its session's Arrow batches limited to ``rows`` rows.

    Whole texts are long rows: at Spark's default of 10,000 a batch takes tens of MB,
    several times over, in every task's JVM and Python buffers.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, rows)
    return df


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> Iterator[None]:
    """Within it, tables that are written or collected pass to Python at most ``rows`` rows and about ``size`` bytes at a time.

    The caller's settings come back at the end.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def release_memory() -> None:
    """Give freed memory back to the system; a reused Python worker else keeps its peak."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def one_blas_thread() -> None:
    """Keep numpy's matrix products in this task's thread.

    A pool of threads gains nothing on small products, and its waiting costs each task as much
    processor time again, times the threads.
    """
    if _BLAS:
        return
    _BLAS.append(True)
    try:
        with open("/proc/self/maps") as maps:
            libraries = {line.split()[-1] for line in maps if "openblas" in line}
        for library in libraries:
            loaded = ctypes.CDLL(library)
            for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(loaded, name):
                    getattr(loaded, name)(1)
    except OSError:  # another system or library: the caller's settings hold
        pass


_BLAS: list[bool] = []


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` plus a long column ``name`` that tells its rows apart (repeated rows too)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def require(df: DataFrame, *cols: str) -> None:
    """Fail early, and by name, when an input column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the input has {df.columns}")


def slices(column: pa.Array, limit: int = SLICE_BYTES, max_rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, text bytes, offsets) of consecutive rows of a string column.

    A null counts as an empty text. A slice holds at most ``limit`` bytes
    and ``max_rows`` rows, or one row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, lo + max_rows, max(lo + 1, hi))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row index of each word ``[^\\x20\\x09-\\x0D]+`` of the rows in ``data``."""
    if len(data) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    word = WORD_BYTE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = word[cuts]  # a row starts a new word
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        have = tuple(
            np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, b, U64), dtype=U64)])
            for b in (base, inverse)
        )
        if size <= 1 << 21:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection that spreads every input bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.empty(0, U64)
    up, down = powers(BYTE_BASE, len(data) + 1)
    total = np.concatenate([np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[:-1], dtype=U64)])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value ^ (ends - starts).astype(U64) * U64(WORD_BASE))


def window_hashes(words: np.ndarray, rows: np.ndarray, size: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of every run of ``size`` words within one row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    up, down = powers(base, len(words) + 1)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(words * up[:-1], dtype=U64)])
    at = np.flatnonzero(rows[size - 1 :] == rows[:n])
    return at, mix((total[at + size] - total[at]) * down[at])
