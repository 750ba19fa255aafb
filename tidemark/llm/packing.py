"""Operator 4: best-fit packing of documents into token sequences, in bulk-synchronous rounds.

Pieces of one size are alike, so the rounds work on size classes: how many pieces wait and how many gaps are
open of each size. There are at most as many classes as a sequence has tokens, whatever the number of documents.
Read upwards by size, every gap takes the largest piece before it that no smaller gap took: the sweep for
successors keeps the waiting classes on a stack. Gaps shrink by what they took, and the rounds repeat
until no piece is left. What a round matches is written as slots: the next so many pieces of a size, by
rank, go to so many consecutive sequences at one offset.

The documents take part twice: their sizes are counted, and a range sort by size and place gives each
its rank in its class. The slot of a rank is found by binary search. No task holds more than a partition
of the sort, and equal sizes may be split over partitions.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import encoder, local_path
from tidemark.skew import number_rows

SEQUENCE_TOKENS = 2048
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, spaces: str | None, end_id: int, limit: int = SEQUENCE_TOKENS
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's ids and its end id.

    A document of up to ``limit`` ids is one piece. A longer one is cut into pieces of ``limit``;
    what does not divide evenly is the first, shorter piece. A null text is empty.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(local_path(tokenizer), spaces)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for doc_id, ids in zip(doc_ids, ids_of.encode(texts), strict=True):
                data = ids + end
                n = len(data) // 4
                cuts = [0, *range(n % limit or min(n, limit), n, limit), n]
                for k in range(len(cuts) - 1):
                    a, b = cuts[k], cuts[k + 1]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECE)


@dataclass
class Slots:
    """Places by size and rank, ascending: ``count`` pieces from ``rank`` on go to sequences from ``sequence`` on."""

    size: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def places(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by size and rank in their size."""
        out = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for s in np.unique(size):
            own = slice(*np.searchsorted(self.size, [s, s + 1]))
            at = np.flatnonzero(size == s)
            slot = own.start + np.searchsorted(self.rank[own], rank[at], "right") - 1
            out[0][at] = self.sequence[slot] + rank[at] - self.rank[slot]
            out[1][at] = self.offset[slot]
        return out


def match_round(
    waiting: dict[int, int], gaps: dict[int, list[tuple[int, int]]], limit: int
) -> tuple[list[tuple[int, int, int, int]], dict[int, list[tuple[int, int]]]]:
    """Matches ``(size, count, first sequence, offset)`` of one sweep, and the gaps that it leaves.

    ``waiting`` has the number of pieces by size and is reduced; ``gaps`` has runs of consecutive
    sequences by the size of their gap. A gap takes one piece a round.
    """
    matches, left, stack = [], defaultdict(list), []
    for size in sorted(waiting.keys() | gaps.keys()):
        if waiting.get(size):
            stack.append(size)
        for first, count in gaps.get(size, []):
            while count and stack:
                piece = stack[-1]
                n = min(count, waiting[piece])
                matches.append((piece, n, first, limit - size))
                left[size - piece].append((first, n))
                waiting[piece] -= n
                first, count = first + n, count - n
                if not waiting[piece]:
                    stack.pop()
            if count:
                left[size].append((first, count))
    return matches, left


def fill(counts: dict[int, int], limit: int) -> Slots:
    """The slots of all pieces, from the number of pieces of each size below ``limit``.

    The first round opens as many sequences as the tokens need at least. Later rounds open more
    only for tokens that all open gaps together cannot hold, or when nothing fits any more. Gaps
    that could take nothing are closed.
    """
    waiting = {s: n for s, n in counts.items() if n}
    taken: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = {}
    slots, opened = [], 0
    while waiting:
        tokens = sum(s * n for s, n in waiting.items())
        room = sum(s * n for s, runs in gaps.items() for _, n in runs)
        fresh = max(0, -(-(tokens - room) // limit))
        if not fresh and max(gaps, default=-1) < min(waiting):
            fresh = max(1, -(-tokens // limit))
        if fresh:
            gaps.setdefault(limit, []).append((opened, fresh))
            opened += fresh
        matches, gaps = match_round(waiting, gaps, limit)
        for size, n, first, offset in matches:
            slots.append((size, taken[size], first, offset))
            taken[size] += n
        waiting = {s: n for s, n in waiting.items() if n}
        least = min(waiting, default=0)
        gaps = {s: runs for s, runs in gaps.items() if s >= max(1, least)}
    columns = np.array(sorted(slots), np.int64).reshape(-1, 4).T
    return Slots(*(np.ascontiguousarray(c) for c in columns))


def pack(pieces: DataFrame, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces plus ``sequence_id`` and ``offset``: their place in a sequence of ``limit`` tokens.

    Pieces of full length are sequences by themselves. A longer piece than ``limit`` is an error.
    Of equal sizes the pieces keep the order in which they are stored.
    """
    spark = pieces.sparkSession
    items = stored(pieces.withColumn("_item", F.monotonically_increasing_id()), "pack-items")
    full = items.where(F.col("length") >= limit).select(
        *pieces.columns,
        F.when(F.col("length") > limit, F.raise_error(F.lit("a piece is longer than a sequence")).cast("long"))
        .otherwise(-1 - F.col("_item"))
        .alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = items.where(F.col("length") < limit)
    sizes = short.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # fewer rows than a sequence has tokens
    if not sizes:
        return full
    counts = {r["length"]: r["n"] for r in sorted(sizes)}
    starts = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((fill(counts, limit), starts))  # follows the classes, not the pieces
    columns, names = list(pieces.columns), list(full.columns)
    length_at = columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, first = shared.value
        for batch in batches:
            size = batch.column(length_at).to_numpy()
            rank = batch.column(len(columns)).to_numpy() - np.fromiter(map(first.__getitem__, size.tolist()), np.int64, len(size))
            found = [pa.array(c) for c in slots.places(size, rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *found], names)

    numbered = number_rows(short, [F.asc("length"), F.asc("_item")], "_no", start=0)
    return full.union(numbered.select(*columns, "_no").mapInArrow(place, full.schema))
