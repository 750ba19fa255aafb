"""Sequences equal up to their ends: one inside another, or the end of one being the start of the other.

Containment: the inner sequence offers one word, its rarest; the outer ones offer each of their words
once. What meets is verified on the texts. Overlap: every end and every start of at least ``least``
bases is a key by itself, hashed at constant cost, so what meets is an overlap and nothing else. Rows
grow with the length of the sequences, not with the number of lengths in use.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators.edits import FREQUENCY_BITS, hash_pairs, prefix_hashes, window_hashes
from tidemark.skew import by_sorting, grid_join

#: Word lengths; a sequence uses the longest that fits.
WORDS = (20, 12, 6, 2, 1)
_SHIFT = np.uint64(64 - FREQUENCY_BITS)


def _word_of(length: int) -> int:
    return next((w for w in WORDS if w <= length), 0)


def _by_length(texts: list[str | None], least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts of one length of bytes at a time, as their numbers and a row of codes each."""
    data = [b"" if t is None else t.encode() for t in texts]
    sizes = np.array([-1 if t is None else len(d) for t, d in zip(texts, data, strict=True)], np.int64)
    for size in np.unique(sizes[sizes >= least]).tolist():
        at = np.flatnonzero(sizes == size)
        step = max(1, (1 << 20) // (size + 1))
        for a in range(0, len(at), step):
            own = at[a : a + step]
            yield own, np.frombuffer(b"".join(data[i] for i in own), np.uint8).reshape(len(own), size)


def _sorted_words(codes: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of each row in order, and which are the first of equal ones."""
    words = np.sort(window_hashes(codes, q), axis=1)
    fresh = np.ones(words.shape, bool)
    fresh[:, 1:] = words[:, 1:] != words[:, :-1]
    return words, fresh


def _sizes_in_use(inner: DataFrame) -> list[int]:
    cases = F.coalesce(*[F.when(F.octet_length("sequence") >= w, F.lit(w)) for w in WORDS], F.lit(0))
    return sorted(r[0] for r in inner.select(cases.alias("w")).distinct().collect())  # at most one row per word length


def _word_classes(outer: DataFrame, sizes: Sequence[int]) -> np.ndarray:
    """How often words of each of ``2^FREQUENCY_BITS`` classes occur in the outer sequences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FREQUENCY_BITS, np.int64)
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                for q in sizes:
                    if codes.shape[1] >= q:
                        words, fresh = _sorted_words(codes, q)
                        total += np.bincount((words[fresh] >> _SHIFT).astype(np.int64), minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["c", "n"])

    found = outer.select("sequence").mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << FREQUENCY_BITS, np.int64)
    for row in found.collect():  # one row per class
        out[row["c"]] = row["n"]
    return out


def _offered(df: DataFrame, keep: list[str], sizes: Sequence[int], classes: np.ndarray | None) -> DataFrame:
    """``(keep.., q, w)``: all distinct words, or with ``classes`` the rarest word of each sequence."""
    shared = None if classes is None else df.sparkSession.sparkContext.broadcast(classes)  # 2^FREQUENCY_BITS numbers

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, size, word = [], [], []
            for own, codes in _by_length(batch.column(len(keep)).to_pylist()):
                for q in sizes if shared is None else [_word_of(codes.shape[1])]:
                    if codes.shape[1] < q:
                        continue
                    words, use = _sorted_words(codes, q)
                    if shared is not None:
                        rarest = np.argmin(shared.value[(words >> _SHIFT).astype(np.int64)], axis=1)
                        use = np.arange(words.shape[1]) == rarest[:, None]
                    who.append(own[np.nonzero(use)[0]])
                    size.append(np.full(len(who[-1]), q, np.int32))
                    word.append(words[use].astype(np.int64))
            if who:
                taken = batch.select(keep).take(pa.array(np.concatenate(who)))
                added = [pa.array(np.concatenate(v)) for v in (size, word)]
                yield pa.RecordBatch.from_arrays([*taken.columns, *added], [*keep, "q", "w"])

    schema = StructType([*[df.schema[c] for c in keep], StructField("q", IntegerType()), StructField("w", LongType())])
    return df.select(*keep, "sequence").mapInArrow(rows, schema)


def containments(inner: DataFrame, outer: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """``(inner, outer)`` ids of sequences that hold another: both have ``id``, ``sequence`` and the scope.

    Ids are unique on each side; equal sequences hold each other.
    """
    scope = list(scope)
    sizes = _sizes_in_use(inner)
    asked = _offered(inner, [*scope, "id"], sizes, _word_classes(outer, sizes)).withColumnRenamed("id", "inner")
    offered = _offered(outer, [*scope, "id"], sizes, None).withColumnRenamed("id", "outer")
    met = grid_join(asked, offered, [*scope, "q", "w"], ["inner"], ["outer"], F.lit(True)).select("inner", "outer")
    both = met.join(by_sorting(inner.select(F.col("id").alias("inner"), F.col("sequence").alias("_i"))), "inner").join(
        by_sorting(outer.select(F.col("id").alias("outer"), F.col("sequence").alias("_o"))), "outer"
    )
    return both.where(F.contains("_o", "_i")).select("inner", "outer")


def end_keys(df: DataFrame, least: int) -> DataFrame:
    """``(rank, side, n, ka, kb)``: proper starts and ends of at least ``least`` bases, as hashes of their text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            sizes = np.array([len(t) for t in texts])
            for size in np.unique(sizes[sizes > least]):
                at = np.flatnonzero(sizes == size)
                codes = np.frombuffer(b"".join(texts[i] for i in at), np.uint8).reshape(len(at), size)
                n = np.arange(least, size)
                heads, tails = prefix_hashes(codes.astype(np.uint64))
                ranks = batch.column(0).take(pa.array(np.repeat(at, len(n))))
                for side, hashes, column in (("S", heads, n), ("E", tails, size - n)):
                    keys = hash_pairs([h[:, column] for h in hashes])
                    arrays = [ranks, pa.array([side] * len(ranks)), pa.array(np.tile(n, len(at)).astype(np.int32)), *(pa.array(k.ravel()) for k in keys)]
                    yield pa.RecordBatch.from_arrays(arrays, ["rank", "side", "n", "ka", "kb"])

    added = [StructField("side", StringType()), StructField("n", IntegerType()), StructField("ka", LongType()), StructField("kb", LongType())]
    return df.select("rank", "sequence").mapInArrow(rows, StructType([df.schema["rank"], *added]))


def staggered_pairs(nodes: DataFrame, least: int) -> DataFrame:
    """``(left, right)`` ranks where a proper end of the left sequence is a proper start of the right one."""
    keys = end_keys(nodes, least)
    ends = keys.where("side = 'E'").select(F.col("rank").alias("left"), "n", "ka", "kb")
    starts = keys.where("side = 'S'").select(F.col("rank").alias("right"), "n", "ka", "kb")
    met = grid_join(ends, starts, ["n", "ka", "kb"], ["left"], ["right"], F.col("left") != F.col("right"))
    return met.select("left", "right").distinct()
