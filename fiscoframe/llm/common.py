"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

#: Ids that are sent to all tasks at most: 24 MB as a hash table.
BROADCAST_IDS = 1_000_000
#: Characters that one Python slice of an Arrow batch holds at most (one longer text is a slice of its own).
SLICE_CHARS = 1_500_000
#: Rows that an Arrow batch holds at most.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(module: str) -> None:
    """Send functions of ``module`` to executors by value, so that they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, a null text as empty: no other column can clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_or_joined(ids: DataFrame) -> DataFrame:
    """Stored ids for a semi or anti join: sent to all tasks if their counted number is bounded, else joined by a shuffle."""
    ids = stage(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def kept_by_worker(key: tuple, make: Callable):
    """An object that the tasks of one Python worker share: shipped functions have globals of their own in every task."""
    kept = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Return memory that earlier work of this Python worker has freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``most`` bytes of ``column``; every row is in exactly one piece."""
    give_back()
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // most
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(a, b - a)
    give_back()


def in_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_ROWS rows, unless the session names a number of its own.

    Spark's default of 10 000 whole texts holds tens of megabytes, in the JVM and in Python, for each task at once.
    """
    spark = df.sparkSession
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """``mapInArrow`` over slices of bounded size."""

    def run(batches):
        for piece in slices(batches, column):
            yield work(piece)

    return in_batches(df, run, schema)


def flat_words(parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words in order, the distinct words, and the offsets of the lists (one more than lists)."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.empty(int(offsets[-1]), dtype=object)
    for words, a, b in zip(parts, offsets[:-1], offsets[1:], strict=True):
        flat[a:b] = words
    codes, distinct = pd.factorize(flat)
    return codes, np.asarray(distinct, dtype=object), offsets


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of distinct words, the same in every process."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(words, categorize=False)


def shingle_hashes(codes_hash: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each document and the document of each.

    A document of fewer words has one shingle of all its words, one without words has none.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    docs = np.repeat(np.arange(len(lengths)), counts)
    first = spread(offsets[:-1], counts)
    padded = np.concatenate([codes_hash, np.zeros(size, dtype=np.uint64)])
    end = offsets[1:][docs]
    out = np.zeros(len(first), dtype=np.uint64)
    for j in range(size):
        part = padded[first + j]
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.where(first + j < end, part, np.uint64(0)) + np.uint64(j))
    return out, docs


def add_by(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` (one row per index) by index."""
    if values.ndim == 1:
        return np.bincount(index, values, minlength=size)
    return np.stack([np.bincount(index, values[:, j], minlength=size) for j in range(values.shape[1])], axis=1)
