"""Similarity search against a reference: seed words, chains, banded extension, best hits."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sequences import reverse_complement
from tidemark.operators.extension import Scheme, best_alignments
from tidemark.operators.taxonomy import best_hits
from tidemark.session import cut_lineage, spread_small_scan
from tidemark.skew import grid_join, lookup_join

# Seed word length of each search task, its scores in half points (match, mismatch, opening a
# gap, each base of a gap), and the published statistics of these scores.
TASK_WORDS = {"megablast": 28, "blastn": 11, "dc-megablast": 11, "blastn-short": 7}
SCHEMES = {
    "megablast": Scheme(2, -4, 0, 5, 1.28, 0.46),
    "blastn": Scheme(4, -6, 10, 4, 0.625, 0.41),
    "dc-megablast": Scheme(4, -6, 10, 4, 0.625, 0.41),
    "blastn-short": Scheme(2, -6, 10, 4, 1.37, 0.711),
}

WORD_SPLITS = 32
SHARES = 1000

ALIGNMENT = (
    "pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, "
    "half_score int"
)


def align_runs(
    query: Column | str, reference: Column | str, runs: Column, identity: float, task: str,
    least: Column | None = None, coverage: float = 0.0,
) -> Column:
    """Best alignment of each row's two sequences through one of its exact runs, as a struct.

    Rows below ``least`` half points or ``coverage`` percent of the query have identity -1.
    """
    scheme = SCHEMES[task]

    @F.pandas_udf(ALIGNMENT)
    def run(q: pd.Series, r: pd.Series, qp: pd.Series, rp: pd.Series, floor: pd.Series) -> pd.DataFrame:
        places = [list(zip(x.tolist(), y.tolist(), strict=True)) for x, y in zip(qp, rp, strict=True)]
        done = pd.DataFrame(best_alignments(q.tolist(), r.tolist(), places, identity, scheme, floor, coverage))
        return done.astype({c: "float64" if c == "pident" else "int32" for c in done.columns})

    floor = F.lit(float("-inf")) if least is None else least
    # evaluated once, not again per filter
    return run.asNondeterministic()(query, reference, runs["qp"], runs["rp"], floor)


def seed_words(df: DataFrame, word: int) -> DataFrame:
    """``df`` without its sequence, once for every word: the word, its place from 0, and the base before it."""
    s = F.col("sequence")
    n = F.length(s) - F.lit(word - 1)
    at = F.when(n > 0, F.sequence(F.lit(1), n))
    words = F.transform(
        at,
        lambda i: F.struct(
            F.substring(s, i, F.lit(word)).alias("word"),
            (i - 1).alias("place"),
            F.when(i > 1, F.substring(s, i - 1, F.lit(1))).otherwise(F.lit("")).alias("before"),
        ),
    )
    rest = [c for c in df.columns if c != "sequence"]
    return df.select(*rest, F.inline(words)).where(~F.col("word").contains("N"))


def candidate_pairs(queries: DataFrame, references: DataFrame, word: int) -> DataFrame:
    """``(qseqid, sseqid, minus, runs)`` of pairs that share a word on either strand.

    ``runs`` has the places where an exact run begins; words inside a run are not repeated. Words held
    by more than 1/1000 of the rows of a side are split on both sides into a grid, each cell of
    which is one small join group. All pairs are kept: nothing is dropped for being frequent.
    """
    plus = queries.select("qseqid", F.lit(False).alias("minus"), "sequence")
    minus = queries.select("qseqid", F.lit(True).alias("minus"), reverse_complement("sequence").alias("sequence"))
    qw = seed_words(plus.unionByName(minus), word).withColumnRenamed("place", "qp")
    rw = seed_words(references.select("sseqid", "sequence"), word).withColumnsRenamed({"place": "rp", "before": "_rb"})
    begins = (F.col("before") != F.col("_rb")) | (F.col("before") == "")
    met = grid_join(qw, rw, ["word"], ["qseqid", "minus"], ["sseqid"], begins, SHARES, WORD_SPLITS)
    return met.groupBy("qseqid", "sseqid", "minus").agg(F.collect_list(F.struct("qp", "rp")).alias("runs"))


def similarity_search(
    queries: DataFrame,
    references: DataFrame,
    perc_identity: float = 80.0,
    qcov: float = 80.0,
    evalue: float = 1e-25,
    max_targets: int = 5,
    task: str = "megablast",
) -> DataFrame:
    """The 12 columns of a search result for queries ``(qseqid, sequence)``.

    A hit runs through a shared seed word, reaches identity and query coverage, and stays below the
    expected number of chance hits. Scores are our own, from published statistics; gaps are linear
    for ``megablast`` and affine for the other tasks.
    """
    if task not in TASK_WORDS:
        raise ValueError(f"task is one of {sorted(TASK_WORDS)}; got {task!r}")
    # words are heavy per row
    q = spread_small_scan(queries.select("qseqid", F.upper("sequence").alias("sequence")))
    r = spread_small_scan(references.select("sseqid", F.upper("sequence").alias("sequence")))
    pairs = cut_lineage(candidate_pairs(q, r, TASK_WORDS[task]))
    with_q = lookup_join(pairs, q.withColumnRenamed("sequence", "_q"), ["qseqid"], spread=["sseqid"])
    full = lookup_join(with_q, r.withColumnRenamed("sequence", "_r"), ["sseqid"], spread=["qseqid"])
    oriented = F.when(F.col("minus"), reverse_complement("_q")).otherwise(F.col("_q"))
    db_size = r.agg(F.coalesce(F.sum(F.length("sequence")), F.lit(0))).scalar()
    # alignment is heavy per row: spread the pairs over all cores, however few bytes they are
    spark = queries.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scheme = SCHEMES[task]
    n = F.length("_q")
    least = None
    if evalue > 0:  # the score that the bound on chance hits asks for, less one for rounding
        asked = F.log(n * db_size / F.lit(float(evalue))) + F.lit(math.log(scheme.constant))
        least = asked * 2 / F.lit(scheme.scale) - 1
    alignment = align_runs(oriented, "_r", F.col("runs"), perc_identity, task, least, qcov)
    scored = full.repartition(tasks).withColumn("_a", alignment).where("_a.pident >= 0")
    bits = (F.lit(scheme.scale) * F.col("_a.half_score") / 2 - F.lit(math.log(scheme.constant))) / F.lit(math.log(2))
    hits = scored.select(
        "qseqid",
        "sseqid",
        "_a.pident",
        "_a.length",
        "_a.mismatch",
        "_a.gapopen",
        F.when(F.col("minus"), n - F.col("_a.qend") + 1).otherwise(F.col("_a.qstart")).alias("qstart"),
        F.when(F.col("minus"), n - F.col("_a.qstart") + 1).otherwise(F.col("_a.qend")).alias("qend"),
        F.when(F.col("minus"), F.col("_a.send")).otherwise(F.col("_a.sstart")).alias("sstart"),
        F.when(F.col("minus"), F.col("_a.sstart")).otherwise(F.col("_a.send")).alias("send"),
        (n * db_size * F.pow(F.lit(2.0), -bits)).alias("evalue"),
        F.round(bits, 1).alias("bitscore"),
        ((F.col("_a.qend") - F.col("_a.qstart") + 1) / n * 100).alias("_cov"),
    )
    good = hits.where(
        (F.col("pident") >= perc_identity) & (F.col("_cov") >= qcov) & (F.col("evalue") <= evalue)
    ).drop("_cov")
    best = best_hits(good.withColumn("hit_no", F.lit(0)), max_targets)
    return best.drop("hit_no").withColumnRenamed("target_no", "hit_no")
