"""Helpers shared by the operators: stored tables, text slices, words and hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import new_path

#: Texts are handled in slices of about so many characters, so memory follows the slice.
SLICE_CHARS = 1 << 20
BATCH_ROWS = 1000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_WORD_CACHE = 1 << 17


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back.

    Later jobs read files, so a lost executor costs only the tasks that it ran.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the files replace the shuffles that made them
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows: documents are long, and workers keep what they grew."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def freeing(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The batch function, which at the end of a partition gives unused memory back to the system.

    Workers serve many partitions; without this they keep the most that one partition needed.
    """

    def run(batches: Iterator) -> Iterator:
        yield from rows(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
        if trim is not None:
            trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that a column of ``df`` has already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id the first column of ``gone`` lists; null ids stay."""
    (key,) = free_names(docs, "gone_id")
    return docs.join(gone.toDF(key), F.col("doc_id") == F.col(key), "left_anti")


def parts(spark: SparkSession) -> int:
    """Partitions of the packed exchanges: the session's setting, which follows the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: Sequence[str | bytes], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges ``(from, to)`` of consecutive texts of about ``limit`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    return x ^ (x >> _S33)


class _Words(dict):
    """64-bit hash of each word; frequent words are looked up, not hashed again."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORD_CACHE and len(word) <= 64:
            self[word] = value
        return value


_WORDS = _Words()


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def run_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values, in order."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = values[:n].copy()
    for i in range(1, size):
        out *= _M1
        out += values[i : i + n]
        out ^= out >> _S33
    return mixed(out)
