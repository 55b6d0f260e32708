"""Arrow batches in pieces of bounded size, for the operators that work inside Python tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes of text that a task holds in expanded form at a time; one longer text is a piece of its own.
PIECE_BYTES = 2 << 20
# Bytes of one Arrow batch between Spark and a Python task, unless the session says otherwise.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for whole texts: a task holds a batch twice, in the JVM and in Python."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut ``batch`` at row borders into pieces of at most about ``limit`` bytes of ``column``."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for begin, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(begin, end - begin)
    give_back()


def give_back() -> None:
    """Workers live on after a task; what it has freed goes back to the system, where the allocators can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of ``array`` end to end, and the n + 1 borders between them; null is empty."""
    filled = pc.fill_null(array.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if len(filled) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
