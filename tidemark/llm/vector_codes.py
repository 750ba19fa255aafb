"""Operator 13: product codes of vectors by integer Lloyd rounds with adaptive distance bounds.

A vector becomes integers and is cut into equal parts; each part position has a codebook of a few
entries. The state that goes from round to round has, for every part, its entry, the ``b`` closest other
entries with lower bounds of their distances in ascending order, and one outer bound for all
entries beyond. When entries move, the bounds shrink by how far they moved. A part whose own
distance lies below all bounds keeps its entry; otherwise the entries whose bounds it reaches are
compared by exact integer distances, and all entries only where it reaches the outer bound. ``b``
follows how many bounds the last round needed. Bounds are rounded down and own distances up, so they
save work and never decide: every decision is one of integers, ties to the lower index.

Rows travel in blocks, each round written to the shared folder and the round before deleted there. Only
sums and counts per entry reach the driver, one number per part, entry and component.

Rows whose vector is null or holds null or non-finite components take no part. Vectors must have one
length that the number of parts divides, and components small enough for exact 64-bit squares; others raise a
ValueError. Entries start as the smallest vec_ids; rows with equal ids follow by their vectors, null
ids come last. With fewer rows than entries there are as many entries as rows. Repeated rows are rows of
their own; null ids and labels are kept, and null labels are one label. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import new_path
from tidemark.skew import lookup_join

BLOCK_ROWS = 4096
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12


def is_kept(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & fine, F.lit(False))


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this operator wrote and no later plan reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def integer_blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Blocks ``(ids, labels, size, largest, vectors)`` of floor(scale * x) as 32-bit integers.

    ``vectors`` has vec_id, label and an array of doubles without gaps.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
            ends = np.cumsum(lengths)
            # a new block where the length changes, which the caller refuses, or the block is full
            cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1), len(lengths)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                for a in range(low, high, BLOCK_ROWS):
                    b = min(high, a + BLOCK_ROWS)
                    own = flat[ends[a] - lengths[a] : ends[b - 1]]
                    largest = float(np.abs(own).max(initial=0))
                    raw = own.astype("<i4") if largest < 1 << 31 else own[:0].astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[a:b].to_pylist()], pa.list_(pa.int64())),
                            pa.array([batch.column(1)[a:b].to_pylist()], pa.list_(batch.column(1).type)),
                            pa.array([int(lengths[a])], pa.int32()),
                            pa.array([largest]),
                            pa.array([raw.tobytes()], pa.binary()),
                        ],
                        ["ids", "labels", "size", "largest", "vectors"],
                    )

    label = vectors.schema[vectors.columns[1]].dataType.simpleString()
    return vectors.mapInArrow(rows, f"ids array<bigint>, labels array<{label}>, size int, largest double, vectors binary")


def smallest_rows(blocks: DataFrame, n: int) -> np.ndarray:
    """The vectors of the ``n`` smallest ids, ties by vector, null ids last."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vectors"], "<i4").reshape(len(row["ids"]), -1)
                order = sorted(range(len(x)), key=lambda k: (row["ids"][k] is None, row["ids"][k] or 0, x[k].tolist()))[:n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["ids"][k] for k in order], pa.int64()), pa.array([x[k].tolist() for k in order], pa.list_(pa.int32()))],
                    ["id", "x"],
                )

    best = blocks.select("ids", "vectors").mapInArrow(rows, "id long, x array<int>").orderBy(F.asc_nulls_last("id"), "x").limit(n)
    found = best.collect()
    return np.array([r["x"] for r in found], np.int64).reshape(len(found), -1)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all entries."""
    out = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        gap = x[:, j, None] - book[None, :, j]
        out += gap * gap
    return out


def _down(values: np.ndarray) -> np.ndarray:
    """32-bit values that are not above the given ones."""
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


@dataclass
class Bounds:
    """State of one part position: entry of each row, closest others, their lower bounds, outer bound."""

    entry: np.ndarray
    closest: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    @classmethod
    def fresh(cls, x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        """From exact distances to all entries."""
        k = len(book)
        key = np.sort(distances(x, book) * k + np.arange(k), axis=1)
        order, far = (key % k).astype(np.uint8), np.sqrt(key // k) * _DOWN
        outer = far[:, b + 1] if b + 1 < k else np.full(len(x), np.inf)
        return cls(order[:, 0], order[:, 1 : b + 1], _down(far[:, 1 : b + 1]), _down(outer))

    def resized(self, b: int) -> Bounds:
        """With ``b`` bounds: dropped ones go into the outer bound, added ones repeat it."""
        have = self.lower.shape[1]
        if b < have:
            return Bounds(self.entry, self.closest[:, :b], self.lower[:, :b], self.lower[:, b])
        pad = [(0, 0), (0, b - have)]
        lower = np.concatenate((self.lower, np.repeat(self.outer[:, None], b - have, axis=1)), axis=1)
        return Bounds(self.entry, np.pad(self.closest, pad), lower, self.outer)

    def advance(self, x: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[Bounds, np.ndarray]:
        """The state for entries that moved by ``moved``, and how many bounds each row needed.

        A row that needed all entries counts ``b + 1``.
        """
        k, b = len(book), self.lower.shape[1]
        gap = x - book[self.entry]
        own = (gap * gap).sum(axis=1)
        reach = np.sqrt(own) * _UP
        outer = _down(self.outer - moved.max(initial=0))
        lower = _down(self.lower - moved[self.closest])
        _ordered(lower, outer)
        needed = (lower <= reach[:, None]).sum(axis=1)
        beyond = outer <= reach
        entry, closest = self.entry.copy(), self.closest.copy()
        rows = np.flatnonzero((needed > 0) & ~beyond)
        if len(rows):
            # exact distances of the entries whose bounds are reached, which come first
            key = np.full((len(rows), b + 1), np.iinfo(np.int64).max)
            key[:, 0] = own[rows] * k + entry[rows]
            at, slot = np.nonzero(np.arange(b) < needed[rows, None])
            near = closest[rows[at], slot]
            gap = x[rows[at]] - book[near]
            key[at, slot + 1] = (gap * gap).sum(axis=1) * k + near
            key.sort(axis=1)
            entry[rows] = key[:, 0] % k
            closest[rows[at], slot] = key[at, slot + 1] % k
            lower[rows[at], slot] = _down(np.sqrt(key[at, slot + 1] // k) * _DOWN)
            _ordered(lower, outer)
        rows = np.flatnonzero(beyond)
        if len(rows):
            new = Bounds.fresh(x[rows], book, b)
            entry[rows], closest[rows], lower[rows], outer[rows] = new.entry, new.closest, new.lower, new.outer
        return Bounds(entry, closest, lower, outer), np.where(beyond, b + 1, needed)


def _ordered(lower: np.ndarray, outer: np.ndarray) -> None:
    """Lower bounds in ascending order, none above the outer bound; they stay lower bounds."""
    for k in range(lower.shape[1] - 1, -1, -1):
        np.minimum(lower[:, k], outer if k + 1 == lower.shape[1] else lower[:, k + 1], out=lower[:, k])


def _pack(state: list[Bounds]) -> list[bytes]:
    columns = [[getattr(s, f) for s in state] for f in ("entry", "closest", "lower", "outer")]
    return [np.concatenate([c.ravel() for c in col]).tobytes() for col in columns]


def _unpack(row: dict, n: int, parts: int) -> list[Bounds]:
    entry, closest = (np.frombuffer(row[c], np.uint8).reshape(parts, n, -1) for c in ("entry", "closest"))
    lower, outer = (np.frombuffer(row[c], np.float32).reshape(parts, n, -1) for c in ("lower", "outer"))
    return [Bounds(entry[p, :, 0], closest[p], lower[p], outer[p, :, 0]) for p in range(parts)]


def assign(blocks: DataFrame, books: np.ndarray, moved: np.ndarray | None, b: int) -> DataFrame:
    """Blocks with their state for the codebooks, ``sums`` and counts per entry, and ``needs``.

    ``needs`` counts the parts by how many bounds they needed; ``moved`` is None before the first round.
    """
    parts, k, size = books.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, row in enumerate(batch.select(batch.schema.names[2:]).to_pylist()):
                raw = np.frombuffer(row["vectors"], "<i4").astype(np.int64).reshape(-1, parts, size)
                n = len(raw)
                needs, state = np.zeros(b + 2, np.int64), []
                sums = np.zeros((parts, k, size + 1), np.int64)
                old = None if moved is None else _unpack(row, n, parts)
                for p in range(parts):
                    x = raw[:, p]
                    if old is None:
                        new, needed = Bounds.fresh(x, books[p], b), np.full(n, b + 1)
                    else:
                        new, needed = old[p].resized(b).advance(x, books[p], moved[p])
                    state.append(new)
                    needs += np.bincount(needed, minlength=b + 2)
                    for j in range(size):
                        sums[p, :, j] = np.bincount(new.entry, x[:, j], k)  # exact: below 2^53
                    sums[p, :, size] = np.bincount(new.entry, minlength=k)
                kept = [batch.column(c)[number : number + 1] for c in ("ids", "labels", "vectors")]
                packed = [pa.array([v], pa.binary()) for v in _pack(state)]
                lists = [pa.array([v.ravel().tolist()], pa.list_(pa.int64())) for v in (sums, needs)]
                yield pa.RecordBatch.from_arrays([*kept, *packed, *lists], [*_STATE])

    label = blocks.schema["labels"].dataType.simpleString()
    schema = f"ids array<bigint>, labels {label}, vectors binary, entry binary, closest binary, lower binary, outer binary"
    columns = ["ids", "labels", "vectors"] + (["entry", "closest", "lower", "outer"] if moved is not None else [])
    return blocks.select(*columns).mapInArrow(rows, schema + ", sums array<bigint>, needs array<bigint>")


_STATE = ["ids", "labels", "vectors", "entry", "closest", "lower", "outer", "sums", "needs"]


def column_sums(state: DataFrame, column: str) -> np.ndarray:
    """Sums of an array column by position, added up in every task first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(len(batch), -1).sum(axis=0)
            total = values if total is None else total + values
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["v"])

    each = state.select(column).mapInArrow(rows, "v array<bigint>").select(F.posexplode("v").alias("pos", "value"))
    found = each.groupBy("pos").agg(F.sum("value").alias("value")).collect()  # one row per number of the codebooks
    out = np.zeros(len(found), np.int64)
    for r in found:
        out[r["pos"]] = r["value"]
    return out


def next_width(needs: np.ndarray, entries: int) -> int:
    """How many bounds to keep: as many as all but few parts needed, within an eighth and half of the entries."""
    b, total = len(needs) - 2, needs.sum()
    if needs[-1] * 16 > total:
        b += 1  # the outer bound was reached too often
    else:
        while b > 0 and needs[b:].sum() * 64 < total:
            b -= 1
    return min(max(b, 1, entries // 8), max(1, entries // 2), max(0, entries - 1))


def code_vectors(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, code, error)`` of every kept row, and the codebooks by part, entry and component.

    ``code`` has two hex digits for each part; ``error`` sums the squared distances of the parts.
    """
    spark = vectors.sparkSession
    kept = vectors.where(is_kept(vector)).select("vec_id", "label", F.col(vector).cast("array<double>").alias("v"))
    blocks, path = _written(integer_blocks(kept, scale), "vector-blocks")
    seen = blocks.agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max("largest").alias("largest")).first()
    if seen["low"] is None:
        none = np.zeros((parts, 0, 0), np.int64)
        return _codes(blocks.select("ids", "labels", "vectors", F.lit(b"").alias("entry")), none), none
    size = seen["high"] // parts
    if seen["low"] != seen["high"] or size * parts != seen["high"]:
        raise ValueError(f"vectors have {seen['low']} to {seen['high']} components; {parts} equal parts need one length")
    if entries > 256 or size * (2 * (seen["largest"] + 1)) ** 2 * entries >= 2**62:
        raise ValueError("components are too large, or entries too many, for exact 64-bit distances")
    first = smallest_rows(blocks, entries)
    books = np.ascontiguousarray(first.reshape(len(first), parts, size).transpose(1, 0, 2))
    k, moved = len(first), None
    b = min(max(1, k // 4), k - 1)
    state = blocks
    for _ in range(rounds):
        state, written = _written(assign(state, books, moved, b), "vector-codes")
        _delete(spark, path)
        path = written
        sums = column_sums(state, "sums").reshape(parts, k, size + 1)
        count = sums[..., size:]
        new = np.where(count > 0, sums[..., :size] // np.maximum(count, 1), books)
        if moved is not None:  # the first round had no bounds
            b = next_width(column_sums(state, "needs"), k)
        moved = np.sqrt(((new - books) ** 2).sum(axis=2)) * _UP
        books = new
    last, _ = _written(assign(state, books, moved, b).select("ids", "labels", "vectors", "entry"), "vector-codes")
    _delete(spark, path)
    return _codes(last, books), books


def _codes(state: DataFrame, books: np.ndarray) -> DataFrame:
    parts = len(books)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(len(batch)):
                ids, labels = (batch.column(c)[number : number + 1].flatten() for c in (0, 1))
                entry = np.frombuffer(batch.column(3)[number].as_py(), np.uint8).reshape(parts, len(ids)).T
                x = np.frombuffer(batch.column(2)[number].as_py(), "<i4").astype(np.int64).reshape(len(ids), parts, -1)
                gap = x - books[np.arange(parts), entry]
                digits = np.ascontiguousarray(entry).tobytes().hex()
                codes = [digits[2 * parts * i : 2 * parts * (i + 1)] for i in range(len(ids))]
                columns = [ids, labels, pa.array(codes, pa.string()), pa.array((gap * gap).sum(axis=(1, 2)))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    label = state.schema["labels"].dataType.elementType.simpleString()
    return state.mapInArrow(rows, f"vec_id bigint, label {label}, code string, error bigint")


def books_digest(books: np.ndarray) -> str:
    """Digest of all entries' components by part, entry and position, comma between them."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame, **options: int) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``; label_error sums over equal labels.

    Errors are summed per label before the join, and labels that hold many rows are salted.
    """
    codes, books = code_vectors(vectors, **options)
    keyed = codes.withColumns({"_none": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    per_label = keyed.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    out = lookup_join(keyed, per_label, ["_none", "_label"], spread=["vec_id", "code"], sort=False)
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
