"""Chimeras with sequencing errors: nearest parents by segments, and a three-way vote.

A candidate's nearest parents share words and runs of segments with it at the same place, counted from the left
or from the right end, so a few errors hide few of them. Per word or run only the two most
abundant owners are known, so neither parents nor candidates are ever paired; a candidate meets a bounded number
of parents, of which those with most matches before or behind some cut are scored. A parent's side
without a shared word of six bases is not found.

For a left and a right parent and a cut, each base votes for the parent on its side, for the other one, or,
where it equals neither, for none. The published score of a side is
``yes / (8 * (no + 1.4) + abstain)``, that of a model the product of both. The best model counts, of those
that match more bases than every single parent does: a copy of one parent is no chimera of two others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.sequences import wide_hash
from tidemark.session import cut_lineage, new_path
from tidemark.skew import by_sorting, lookup_join, number_rows

# The published weights of a no vote and of the pseudo count, the least score, the least number of
# differences on each side, and the least gain in identity (percent) of the model over the nearest parent.
NO_WEIGHT, PSEUDO = 8.0, 1.4
MIN_SCORE, MIN_DIFFERENCES, MIN_DIVERGENCE = 0.28, 3, 0.8
SEGMENTS = 6
#: Words at every place, and how many parents with most matches are kept for each side of each cut.
WORDS = (6, 12)
NEAREST = 3

_MODEL = "amplicon long, chimera string, score double, left_parent long, right_parent long, cut int"


def _segment_sizes(length: Column) -> Column:
    """Segment lengths in use for a sequence: powers of two, so that similar lengths share one."""

    def power(x: Column) -> Column:
        return F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(x / SEGMENTS, F.lit(2.0))))).cast("int")

    return F.array_distinct(F.array(power(length * 0.9), power(length * 1.1)))


def segment_runs(df: DataFrame) -> DataFrame:
    """``(amplicon, size, k)``: every word and every run of whole segments, by its place from either end."""
    s = F.col("sequence")
    n = F.length(s)

    def words(size: int) -> Column:
        places = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(
            F.transform(
                places,
                lambda i: F.array(
                    wide_hash(F.lit("l"), i, F.substring(s, i, F.lit(size))), wide_hash(F.lit("r"), n - i, F.substring(s, i, F.lit(size)))
                ),
            )
        )

    def of_size(w: Column) -> Column:
        last = F.floor(n / w).cast("int")
        starts = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))

        def from_start(a: Column) -> Column:
            return F.flatten(
                F.transform(
                    F.sequence(F.lit(1), last - a),
                    lambda m: F.array(
                        wide_hash(F.lit("L"), w, a, F.substring(s, a * w + 1, m * w)),
                        wide_hash(F.lit("R"), w, a, F.substring(s, n - (a + m) * w + 1, m * w)),
                    ),
                )
            )

        return F.flatten(F.transform(starts, from_start))

    keys = F.concat(F.flatten(F.transform(_segment_sizes(n), of_size)), *[words(size) for size in WORDS])
    return df.select("amplicon", "size", F.explode(keys).alias("k"))


def nearest_parents(amplicons: DataFrame, fold: float, min_parent: int = 1) -> DataFrame:
    """``(amplicon, parent)``: owners of shared runs that are ``fold`` times as abundant, distinct.

    Runs are sorted once, by key and falling size. A run's two most abundant owners are the first two of its key,
    which are known when a row comes by, so runs are neither stored nor joined and no task holds a key's rows.
    """
    runs = segment_runs(amplicons.select("amplicon", "sequence", "size"))
    order = Window.partitionBy("k").orderBy(F.desc("size"), "amplicon")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.struct("size", "amplicon")
    second = F.when(F.row_number().over(order) == 1, F.lead(row).over(order)).otherwise(F.nth_value(row, 2).over(upto))
    met = runs.select("amplicon", "size", F.first(row).over(upto).alias("p1"), second.alias("p2"))
    each = met.select("amplicon", "size", F.explode(F.array_compact(F.array("p1", "p2"))).alias("p"))
    enough = (F.col("p.size") >= F.col("size") * F.lit(float(fold))) & (F.col("p.size") >= min_parent)
    return each.where(enough & (F.col("p.amplicon") != F.col("amplicon"))).select(
        "amplicon", F.col("p.amplicon").alias("parent")
    ).distinct()


def matched_bases(query: str, parent: str) -> np.ndarray:
    """Which bases of the query a best alignment of both whole sequences matches.

    Sequences of equal length are compared place by place.
    """
    q, p = (np.frombuffer(t.encode(), np.uint8) for t in (query, parent))
    if len(q) == len(p):
        return q == p
    rows = np.empty((len(q) + 1, len(p) + 1), np.int32)
    steps = np.arange(len(p) + 1)
    rows[0] = steps
    for i in range(1, len(q) + 1):
        new = rows[i - 1] + 1
        new[1:] = np.minimum(new[1:], rows[i - 1, :-1] + (q[i - 1] != p))
        rows[i] = np.minimum.accumulate(new - steps) + steps
    out, i, j = np.zeros(len(q), bool), len(q), len(p)
    while i and j:
        here = rows[i, j]
        if here == rows[i - 1, j - 1] + (q[i - 1] != p[j - 1]):
            i, j = i - 1, j - 1
            out[i] = q[i] == p[j]
        elif here == rows[i - 1, j] + 1:
            i -= 1
        else:
            j -= 1
    return out


def nearest(matched: np.ndarray) -> np.ndarray:
    """Rows with most matches before or behind some cut, in their order."""
    n, size = matched.shape
    if n <= 2 * NEAREST:
        return np.arange(n)
    sums = np.cumsum(matched, axis=1)
    behind = sums[:, -1:] - sums
    best = [np.argsort(-side[:, :-1], axis=0, kind="stable")[:NEAREST].ravel() for side in (sums, behind)]
    return np.unique(np.concatenate(best))


def best_model(matched: np.ndarray) -> tuple[str, float, int, int, int]:
    """``(call, score, left, right, cut)`` of a query from the matched bases of its parents, one per row.

    A model must match more bases than any parent. Ties go to the first left parent, then right parent, then
    cut. Y needs the least score, differences on both sides and a gain in identity; with the score alone
    the call is ``?``.
    """
    n, size = matched.shape
    best = ("N", 0.0, -1, -1, 0)
    if n < 2 or size < 2:
        return best
    sums = np.zeros((n, size + 1), np.int64)
    np.cumsum(matched, axis=1, out=sums[:, 1:])
    cuts, top = np.arange(1, size), sums[:, -1].max()
    behind = sums[:, -1:] - sums[:, cuts]
    for left in range(n):
        # votes of all right parents at once
        both = np.zeros((n, size + 1), np.int64)
        np.cumsum(matched & matched[left], axis=1, out=both[:, 1:])
        mine, other = sums[left][None, :] - both, sums - both
        none = np.arange(size + 1)[None, :] - sums[left][None, :] - sums + both
        yes_l, no_l, no_vote_l = mine[:, cuts], other[:, cuts], none[:, cuts]
        yes_r, no_r, no_vote_r = (v[:, -1:] - v[:, cuts] for v in (other, mine, none))
        score = yes_l / (NO_WEIGHT * (no_l + PSEUDO) + no_vote_l) * (yes_r / (NO_WEIGHT * (no_r + PSEUDO) + no_vote_r))
        model = sums[left, cuts][None, :] + behind
        score[(yes_l <= no_l) | (yes_r <= no_r) | (model <= top)] = 0.0
        at = int(score.argmax())
        right, k = divmod(at, size - 1)
        if score[right, k] > best[1] + 1e-12:
            cut = int(cuts[k])
            sides = [int(a[right, k] + b[right, k] + c[right, k]) for a, b, c in ((yes_l, no_l, no_vote_l), (yes_r, no_r, no_vote_r))]
            gain = 100.0 * (model[right, k] - top) / size
            sure = min(sides) >= MIN_DIFFERENCES and gain >= MIN_DIVERGENCE
            found = float(score[right, k])
            best = ("N" if found < MIN_SCORE else "Y" if sure else "?", found, left, right, cut)
    return best


def score_chimeras(amplicons: DataFrame, fold: float = 2.0, min_parent: int = 1) -> DataFrame:
    """Every amplicon with ``chimera`` (Y, N, ?), the score of its best model, its two parents and the cut.

    Parents are ``fold`` times as abundant. Amplicons without two parents are N with score 0.
    """
    # numbers in the order of the ids; runs and pairs hold them instead of the ids
    named = cut_lineage(number_rows(amplicons.select("amplicon").dropna().distinct(), [F.asc("amplicon")], "no"))
    numbered = amplicons.select("amplicon", "sequence", "size").join(by_sorting(named), "amplicon")
    spark = amplicons.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the work is heavy per row: the number of partitions does not follow the few bytes
    text = cut_lineage(numbered.select(F.col("no").alias("amplicon"), "sequence", "size").repartition(tasks))
    path = new_path(spark, "parents")
    nearest_parents(text, fold, min_parent).write.parquet(path)  # read twice
    pairs = spark.read.parquet(path)
    of_parent = text.select(F.col("amplicon").alias("parent"), F.col("sequence").alias("_p"), F.col("size").alias("_ps"))
    with_parent = lookup_join(pairs, of_parent, ["parent"], spread=["amplicon"])
    # a candidate has at most two parents for each of its runs
    parents = F.sort_array(F.collect_list(F.struct((-F.col("_ps")).alias("order"), "parent", "_p"))).alias("parents")
    gathered = with_parent.groupBy("amplicon").agg(parents).join(by_sorting(text.select("amplicon", "sequence")), "amplicon")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                names = [p["parent"] for p in row["parents"]]
                matched = np.stack([matched_bases(row["sequence"], p["_p"]) for p in row["parents"]])
                rows = nearest(matched)
                names, matched = [names[k] for k in rows], matched[rows]
                call, score, left, right, cut = best_model(matched)
                known = left >= 0
                out.append((row["amplicon"], call, score, names[left] if known else None, names[right] if known else None, cut if known else None))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            names = ["amplicon", "chimera", "score", "left_parent", "right_parent", "cut"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    judged = cut_lineage(gathered.mapInArrow(judge, _MODEL))
    name = {c: by_sorting(named.select(F.col("no").alias(c), F.col("amplicon").alias(f"_{c}"))) for c in ("amplicon", "left_parent", "right_parent")}
    called = judged.join(name["amplicon"], "amplicon").join(name["left_parent"], "left_parent", "left").join(
        name["right_parent"], "right_parent", "left"
    ).select(F.col("_amplicon").alias("amplicon"), "chimera", "score", F.col("_left_parent").alias("left_parent"),
             F.col("_right_parent").alias("right_parent"), "cut")
    return amplicons.join(by_sorting(called), "amplicon", "left").withColumns(
        {"chimera": F.coalesce("chimera", F.lit("N")), "score": F.coalesce("score", F.lit(0.0))}
    )
