"""Operator 8: exact top-k inner products over norm-sorted blocks with residual bounds.

Components become integers, so scores are exact. Vectors are range-sorted by descending length
and packed into blocks. All are rotated onto the right singular vectors of the whole set (from
its d x d Gram matrix), so the first coordinates hold most of a product. With the partial sum of
the first coordinates, Cauchy-Schwarz bounds the rest by the product of both residual lengths; a
pair whose bound is below the query's k-th score so far is never computed. The stated query
set meets the candidates block by block, and whole block pairs are left out by their lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import parts, stored

SCALE = 256.0
#: Vectors of a candidate block, of a query block and of one pruning step.
BLOCK, QUERY_BLOCK, STEP = 8192, 1024, 1024
GRAM_SLOTS = 32
#: Shares of the coordinates after which the residual bound is tried.
CUTS = (0.25, 0.5)
_PACKED = "block long, n int, longest double, ids binary, ints binary"


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``(vec_id, v, norm)``: integers floor(scale * x), without unusable vectors.

    A vector that is null, or holds a null or non-finite component, takes no part; nor does a
    row without id. An empty vector has length 0 and scores 0 with all.
    """
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(usable, F.lit(False)))
    return kept.select("vec_id", ints.alias("v")).withColumn("norm", norm)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, the strongest first, as columns."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims).astype(np.float64)
            total += x.T @ x
        slot = TaskContext.get().partitionId() % GRAM_SLOTS
        yield pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([total.tobytes()], pa.binary())], ["slot", "g"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(g, np.float64) for g in pdf["g"])
        return pd.DataFrame({"g": [np.asarray(total).tobytes()]})

    sums = vectors.select("v").mapInArrow(gram, "slot long, g binary").groupBy("slot").applyInPandas(add, "g binary")
    total = sum((np.frombuffer(r["g"], np.float64) for r in sums.collect()), np.zeros(dims * dims))  # GRAM_SLOTS rows
    values, basis = np.linalg.eigh(total.reshape(dims, dims))
    return basis[:, np.argsort(-values)]


def norm_blocks(vectors: DataFrame, dims: int, size: int) -> DataFrame:
    """Blocks of ``size`` vectors in descending length, ties by id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block(ids: np.ndarray, ints: np.ndarray, norms: np.ndarray) -> pa.RecordBatch:
            columns = [
                pa.array([(part << 32) + k]), pa.array([len(ids)], pa.int32()), pa.array([float(norms[0])]),
                pa.array([ids.tobytes()], pa.binary()), pa.array([ints.tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "n", "longest", "ids", "ints"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), dims), batch.column(2).to_numpy(zero_copy_only=False)))
            while sum(len(h[0]) for h in held) >= size:
                ids, ints, norms = (np.concatenate(x) for x in zip(*held, strict=True))
                yield block(ids[:size], ints[:size], norms[:size])
                held, k = [(ids[size:], ints[size:], norms[size:])], k + 1
        if held and sum(len(h[0]) for h in held):
            yield block(*(np.concatenate(x) for x in zip(*held, strict=True)))

    spread = vectors.select("vec_id", "v", "norm").repartitionByRange(parts(vectors.sparkSession), F.desc("norm"), "vec_id")
    return spread.sortWithinPartitions(F.desc("norm"), "vec_id").mapInArrow(pack, _PACKED)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def block_top_k(
    q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, c_ids: np.ndarray, c: np.ndarray, basis: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, id, score) of each query's k best in a block, given a score it has already."""
    dims = q.shape[1]
    cuts = sorted({max(1, int(dims * share)) for share in CUTS}) if dims else []
    qr, cr = q.astype(np.float64) @ basis, c.astype(np.float64) @ basis
    q_norm, c_norm = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_rest = [np.linalg.norm(qr[:, m:], axis=1) for m in cuts]
    c_rest = [np.linalg.norm(cr[:, m:], axis=1) for m in cuts]
    best_id: list[np.ndarray] = [np.empty(0, np.int64) for _ in q_ids]
    best_score: list[np.ndarray] = [np.empty(0, np.int64) for _ in q_ids]
    least = floor.astype(np.float64).copy()
    for a in range(0, len(c_ids), STEP):
        b = min(a + STEP, len(c_ids))
        slack = 1e-9 * q_norm * c_norm[a] + 1e-6
        live = np.flatnonzero(q_norm * c_norm[a] + slack >= least)
        if not len(live):
            continue
        keep = q_norm[live, None] * c_norm[None, a:b] + slack[live, None] >= least[live, None]
        done, partial = 0, np.zeros((len(live), b - a))
        for m, qx, cx in zip(cuts, q_rest, c_rest, strict=True):
            partial += qr[live, done:m] @ cr[a:b, done:m].T
            done = m
            keep &= partial + qx[live, None] * cx[None, a:b] + slack[live, None] >= least[live, None]
        keep &= q_ids[live, None] != c_ids[None, a:b]
        rows, cols = np.nonzero(keep)
        bounds = np.searchsorted(rows, np.arange(len(live) + 1))
        for r in np.unique(rows):
            i, at = live[r], a + cols[bounds[r] : bounds[r + 1]]
            scores = np.concatenate((best_score[i], c[at] @ q[i]))
            ids = np.concatenate((best_id[i], c_ids[at]))
            order = _best(scores, ids, k)
            best_score[i], best_id[i] = scores[order], ids[order]
            if len(order) == k:
                least[i] = max(least[i], float(scores[order[-1]]))
    index = np.repeat(np.arange(len(q_ids)), [len(x) for x in best_id])
    return index, np.concatenate(best_id), np.concatenate(best_score)


def _unpacked(row: dict, side: str, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}_ids"], np.int64)
    return ids, np.frombuffer(row[f"{side}_ints"], np.int64).reshape(len(ids), dims)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best others by integer inner product.

    Equal scores go by smaller id. A shorter vector is padded with zeros. Rows that share the
    query's id are its own row. Fewer than k candidates give all of them; scores must fit a long.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, scale), "top-k-vectors")
    dims = rows.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    basis = rotation(rows, dims)
    side = lambda df, s: df.select([F.col(c).alias(f"{s}_{c}") for c in df.columns])
    candidates = side(stored(norm_blocks(rows, dims, BLOCK), "top-k-blocks"), "c")
    asked = stored(norm_blocks(rows.where(is_query), dims, QUERY_BLOCK), "top-k-queries")
    asked = side(asked, "q")
    # One block of the longest vectors gives every query a first k-th score.
    head = candidates.orderBy(F.desc("c_longest"), "c_block").limit(1)

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q = _unpacked(row, "q", dims)
                c_ids, c = _unpacked(row, "c", dims)
                floor = np.full(len(ids), -np.inf)
                index, _, score = block_top_k(ids, q, floor, c_ids, c, basis, k)
                for i in range(len(ids)):
                    own = score[index == i]
                    if len(own) == k:
                        floor[i] = float(own[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["q_block"]]), pa.array([floor.tobytes()], pa.binary()), pa.array([float(floor.min())])],
                    ["q_block", "q_floor", "q_least"],
                )

    # A single block of a fixed number of rows: bounded, so broadcast.
    floors = stored(asked.join(F.broadcast(head)).mapInArrow(seed, "q_block long, q_floor binary, q_least double"), "top-k-floors")
    heads = asked.select("q_block", "q_longest").join(floors.select("q_block", "q_least"), "q_block")
    reach = F.col("q_longest") * F.col("c_longest") * (1 + 1e-9) + 1e-6 >= F.col("q_least")
    pairs = heads.join(candidates.select("c_block", "c_longest"), reach).select("q_block", "c_block")
    work = (
        pairs.repartition(parts(spark), "c_block", "q_block")
        .join(candidates.drop("c_longest"), "c_block")
        .join(asked.drop("q_longest").join(floors.drop("q_least"), "q_block"), "q_block")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q = _unpacked(row, "q", dims)
                c_ids, c = _unpacked(row, "c", dims)
                index, found, score = block_top_k(ids, q, np.frombuffer(row["q_floor"], np.float64), c_ids, c, basis, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[index]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    found = work.mapInArrow(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
