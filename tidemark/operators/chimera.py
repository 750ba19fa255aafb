"""Two-parent chimeras, from the longest prefix and suffix shared with abundant parents.

A sequence is a chimera when some cut exists with one parent matching everything left of it
and another parent everything right of it. Per prefix it is enough to know its two most
abundant owners, so neither parents nor candidates are ever paired.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.sequences import wide_hash
from tidemark.session import cut_lineage
from tidemark.skew import by_sorting, lookup_join, number_rows


def _ends(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Every proper prefix and suffix: ``cut`` (place from the left, negative for a suffix), key ``ka, kb``.

    The key holds the scope, side and place, too.
    """
    s = F.col("sequence")
    cuts = F.when(F.length(s) > 1, F.sequence(F.lit(1), F.length(s) - 1))

    def end(side: str, cut: Column, text: Column) -> Column:
        key = wide_hash(F.lit(side), *scope, text)
        return F.struct(cut.alias("cut"), key["a"].alias("ka"), key["b"].alias("kb"))

    left = F.transform(cuts, lambda i: end("L", i, F.substring(s, F.lit(1), i)))
    right = F.transform(cuts, lambda i: end("R", -i, F.substring(s, i + 1, F.length(s))))
    return df.select("no", "size", F.inline(F.concat(left, right)))


def two_owners(ends: DataFrame, keys: Sequence[str], owner: str = "amplicon") -> DataFrame:
    """Per key (a prefix, suffix or run) its two most abundant owners; the limit applies before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("size"), owner)
    top = ends.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= 2)
    return top.groupBy(*keys).agg(
        F.max(F.when(F.col("_i") == 1, F.struct("size", owner))).alias("p1"),
        F.max(F.when(F.col("_i") == 2, F.struct("size", owner))).alias("p2"),
    )


def two_parent_matches(
    amplicons: DataFrame, folds: Sequence[float], scope: Sequence[str] = (), min_parent: int = 1
) -> DataFrame:
    """``(scope.., amplicon, hit_0, ..)``: whether two parents cover the sequence, per fold.

    A parent is ``fold`` times as abundant as the sequence. Amplicons without any hit are left
    out. Ends carry a number for their amplicon and are made anew where they are read, not stored; an end that
    nothing else shares, and one without a parent abundant enough, goes no further.
    """
    scope = list(scope)
    base = amplicons.select(*scope, "amplicon", "sequence", "size").dropna(subset=[*scope, "amplicon"])
    named = number_rows(base.select(*scope, "amplicon").distinct(), [F.asc(c) for c in (*scope, "amplicon")], "no")
    named = cut_lineage(named)
    ends = _ends(cut_lineage(base.join(by_sorting(named), [*scope, "amplicon"])), scope)
    shared = two_owners(ends, ["ka", "kb"], "no").where((F.col("p1.size") >= min_parent) & F.col("p2").isNotNull())
    met = lookup_join(ends, shared, ["ka", "kb"], spread=["no", "cut"])
    cols, aggs, hits = {}, [], []
    for i, fold in enumerate(folds):
        need = F.greatest(F.col("size") * F.lit(float(fold)), F.lit(float(min_parent)))

        def enough(parent: str) -> Column:
            other = F.col(f"{parent}.no") != F.col("no")
            return F.coalesce((F.col(f"{parent}.size") >= need) & other, F.lit(False))

        first, second = enough("p1"), enough("p2")
        cols[f"_n{i}"] = first.cast("int") + second.cast("int")
        cols[f"_w{i}"] = F.when(first, F.col("p1.no")).when(second, F.col("p2.no"))
        for side, here in (("L", F.col("cut") > 0), ("R", F.col("cut") < 0)):
            for c in (f"_n{i}", f"_w{i}"):
                aggs.append(F.max(F.when(here, F.col(c))).alias(f"{c}{side}"))
        both = (F.col(f"_n{i}L") > 0) & (F.col(f"_n{i}R") > 0)
        apart = (F.col(f"_n{i}L") > 1) | (F.col(f"_n{i}R") > 1) | (F.col(f"_w{i}L") != F.col(f"_w{i}R"))
        hits.append(F.coalesce(both & apart, F.lit(False)).alias(f"hit_{i}"))
    sides = met.select("no", "cut", *[c.alias(n) for n, c in cols.items()])
    sides = sides.where(" OR ".join(f"_n{i} > 0" for i in range(len(folds))))
    cut = sides.groupBy("no", F.abs("cut").alias("at")).agg(*aggs).select("no", *hits)
    names = [f"hit_{i}" for i in range(len(folds))]
    found = cut.groupBy("no").agg(*[F.bool_or(n).alias(n) for n in names])
    return named.join(by_sorting(found.where(" OR ".join(names))), "no").drop("no")


def call_chimeras(amplicons: DataFrame, fold: float = 2.0) -> DataFrame:
    """Every amplicon with ``chimera``: Y, ``?`` when the parents are more abundant but less
    than ``fold`` times, else N."""
    hits = two_parent_matches(amplicons, [fold, 1.0 + 1e-9])
    joined = amplicons.join(by_sorting(hits), "amplicon", "left")
    return joined.withColumn(
        "chimera", F.when(F.col("hit_0"), "Y").when(F.col("hit_1"), "?").otherwise("N")
    ).drop("hit_0", "hit_1")


def sample_votes(table: DataFrame, fold: float = 1.5, min_parent: int = 2) -> DataFrame:
    """Per sequence: samples that hold it and samples that call it a chimera."""
    rows = table.where("reads > 0").select(
        "sample", F.sha1("sequence").alias("amplicon"), "sequence", F.col("reads").alias("size")
    )
    called = two_parent_matches(rows, [fold], ["sample"], min_parent).withColumnRenamed("hit_0", "_y")
    joined = rows.join(by_sorting(called), ["sample", "amplicon"], "left")
    return joined.groupBy("sequence").agg(
        F.count(F.lit(1)).alias("n_samples"), F.count("_y").alias("n_flagged")
    )


def consensus(n_flagged: Column, n_samples: Column, fraction: float = 0.9, spare: int = 1) -> Column:
    """Chimera by vote: all samples, or at least ``fraction`` of all but ``spare`` of them."""
    return (n_flagged >= n_samples) | ((n_flagged > 0) & (n_flagged >= (n_samples - spare) * fraction))


def remove_bimeras(table: DataFrame, method: str = "consensus") -> DataFrame:
    """Sequence table without two-parent chimeras: by vote over samples, pooled, or unchanged."""
    if method == "none":
        return table
    if method == "consensus":
        votes = sample_votes(table)
        bad = votes.where(consensus(F.col("n_flagged"), F.col("n_samples"))).select("sequence")
    elif method == "pooled":
        pooled = table.groupBy("sequence").agg(F.sum("reads").alias("size")).withColumn(
            "amplicon", F.sha1("sequence")
        )
        called = two_parent_matches(pooled, [2.0], min_parent=8)
        bad = pooled.join(by_sorting(called), "amplicon").select("sequence")
    else:
        raise ValueError(f"unknown chimera method {method!r}")
    return table.join(by_sorting(bad), "sequence", "left_anti")
