"""From search hits to one lineage per feature."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.nulls import UNASSIGNED, is_missing_taxon, taxon_or_label, taxon_or_null
from tidemark.functions.ranks import CLASS_THRESHOLDS, RANKS, cascade, identity_cascade
from tidemark.skew import rank_by_position

CONTAMINANT_FLAG = "is_contaminant_candidate"


def _r(rank: str) -> Column:
    return F.col(f"`{rank}`")


def _with_ranks(df: DataFrame, ranks: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({rank: c for rank, c in ranks.items()})


def attach_lineage(hits: DataFrame, lineage: DataFrame) -> DataFrame:
    """Hits with the ranks of their reference.

    A hit whose reference has no lineage fails the job that reads it, as leaving it out would
    change the consensus; :func:`hits_without_lineage` lists all of them.
    """
    known = lineage.select("sseqid", *[_r(r) for r in RANKS], F.lit(True).alias("_known"))
    error = F.raise_error(F.concat(F.lit("no lineage for reference "), F.coalesce("sseqid", F.lit("null"))))
    joined = hits.join(known, "sseqid", "left")
    return joined.where(F.coalesce("_known", error.cast("boolean"))).drop("_known")


def hits_without_lineage(hits: DataFrame, lineage: DataFrame) -> DataFrame:
    """Reference ids that hits use but no header names, with the number of hits.

    Hits are counted per id first, so a popular reference does not load one join task.
    """
    used = hits.groupBy("sseqid").agg(F.count(F.lit(1)).alias("n_hits"))
    return used.join(lineage.select("sseqid"), "sseqid", "left_anti")


def hit_ranks(hits: DataFrame) -> DataFrame:
    """``blast_rank``: position of a hit within its query, in file order."""
    return rank_by_position(hits, ["qseqid"], "hit_no", "blast_rank")


def filter_identity(
    hits: DataFrame, thresholds: Mapping[str, float] = CLASS_THRESHOLDS
) -> DataFrame:
    """Null the ranks each hit's identity is too low for. Rows are never dropped."""
    return _with_ranks(hits, identity_cascade(F.col("pident"), thresholds))


def best_hits(hits: DataFrame, n: int = 5) -> DataFrame:
    """At most ``n`` hits per query by bit score; the limit is applied before the shuffle."""
    order = Window.partitionBy("qseqid").orderBy(
        F.desc("bitscore"), F.desc("pident"), F.asc("sseqid"), F.asc("hit_no")
    )
    return hits.withColumn("target_no", F.row_number().over(order)).where(F.col("target_no") <= n)


def _score_levels(hits: DataFrame, keys: Sequence[str], ranks: Mapping[str, Column]) -> DataFrame:
    """One row per query and score: everything a consensus needs, in mergeable form.

    Whether a hit is in the band depends on its scores alone, so hits with equal scores can
    be folded map-side. The number of levels of a query is bounded by the score alphabet, not
    by its number of hits, which keeps the windows that follow small for a hot query.
    """
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.min("hit_no").alias("_first_no"),
        F.min_by(F.struct(*[_r(r).alias(r) for r in RANKS]), F.col("hit_no")).alias("_first"),
    ]
    for rank, value in ranks.items():
        aggs += [F.min(value).alias(f"_lo_{rank}"), F.max(value).alias(f"_hi_{rank}")]
    return hits.groupBy("qseqid", *keys).agg(*aggs)


def in_band_levels(
    hits: DataFrame, top_bitscore_pct: float = 10.0, lca_pident_delta: float = 1.0
) -> DataFrame:
    """Score levels of each query with the flag ``_in_band`` and the query's best scores."""
    levels = _score_levels(hits, ["bitscore", "pident"], {r: _r(r) for r in RANKS})
    query = Window.partitionBy("qseqid")
    scored = levels.withColumns(
        {"_best": F.max("bitscore").over(query), "_hits": F.sum("_n").over(query)}
    ).withColumn(
        "_in_score",
        F.coalesce(
            F.col("bitscore") >= F.col("_best") * F.lit(1.0 - top_bitscore_pct / 100.0), F.lit(False)
        ),
    )
    scored = scored.withColumn(
        "_best_pid", F.max(F.when(F.col("_in_score"), F.col("pident"))).over(query)
    )
    near = F.lit(True)
    if lca_pident_delta > 0:
        near = F.col("_best_pid").isNull() | F.coalesce(
            F.col("pident") >= F.col("_best_pid") - F.lit(float(lca_pident_delta)), F.lit(False)
        )
    usable = F.coalesce(F.col("_best") > 0, F.lit(False))
    return scored.withColumn(
        "_in_band", (F.col("_hits") == 1) | (usable & F.col("_in_score") & near)
    )


def resolve_cascade(
    hits: DataFrame, top_bitscore_pct: float = 10.0, lca_pident_delta: float = 1.0
) -> DataFrame:
    """Lowest common ancestor over the hits near the best bit score and identity.

    Agreeing hits keep the best one as it is, nulls included. Disagreeing hits keep the first
    of the band in file order with every disagreeing rank, and all below the first gap, null.
    A query whose best score is missing or not positive yields no row unless it has one hit.
    """
    band = in_band_levels(hits, top_bitscore_pct, lca_pident_delta).where("_in_band")
    row = F.struct(F.col("_first").alias("ranks"), "pident", "bitscore")
    aggs = [
        F.sum("_n").alias("n_band"),
        F.max("pident").alias("_max_pid"),
        F.max("bitscore").alias("_max_bit"),
        F.min_by("_first", "_first_no").alias("_head"),
        F.max_by(row, F.struct("bitscore", -F.col("_first_no"))).alias("_top"),
    ]
    for rank in RANKS:
        aggs += [F.min(f"_lo_{rank}").alias(f"_lo_{rank}"), F.max(f"_hi_{rank}").alias(f"_hi_{rank}")]
    done = band.groupBy("qseqid").agg(*aggs)

    split = {r: F.col(f"_lo_{r}") != F.col(f"_hi_{r}") for r in RANKS}
    clash = F.lit(False)
    for rank in RANKS:
        clash = clash | F.coalesce(split[rank], F.lit(False))
    done = done.withColumn("_clash", clash)
    done = done.withColumns(
        {r: F.when(~F.coalesce(split[r], F.lit(False)), F.col("_head").getField(r)) for r in RANKS}
    )
    done = cascade(done, lambda c: c.isNull(), F.lit(None).cast("string"))
    out = {r: F.when(F.col("_clash"), _r(r)).otherwise(F.col("_top.ranks").getField(r)) for r in RANKS}
    return done.select(
        F.col("qseqid").alias("asv_id"),
        F.when(F.col("_clash"), F.col("_max_pid")).otherwise(F.col("_top.pident")).alias("pident"),
        F.when(F.col("_clash"), F.col("_max_bit")).otherwise(F.col("_top.bitscore")).alias("bitscore"),
        "n_band",
        *[out[r].alias(r) for r in RANKS],
    )


def resolve_collapsed(hits: DataFrame, lca_pid: float = 90.0, lca_diff: float = 1.0) -> DataFrame:
    """Lowest common ancestor over the top-identity window above a hard identity floor.

    A rank takes the one value the window holds, even if its first hit lacks it; only a
    disagreement cascades. With no hit above the floor all ranks are null and ``pident`` is
    the best identity below it.
    """
    for value in (lca_pid, lca_diff):
        if not 0 <= value <= 100:
            raise ValueError(f"identity parameters lie in [0, 100]; got {value}")
    levels = _score_levels(hits, ["pident"], {r: taxon_or_null(_r(r)) for r in RANKS})
    query = Window.partitionBy("qseqid")
    passed = F.coalesce(F.col("pident") >= F.lit(float(lca_pid)), F.lit(False))
    levels = levels.withColumn("_best", F.max(F.when(passed, F.col("pident"))).over(query))
    inside = passed & (F.col("pident") >= F.col("_best") - F.lit(float(lca_diff)))
    aggs = [
        F.max("_best").alias("_best"),
        F.max("pident").alias("_any"),
        F.coalesce(F.sum(F.when(inside, F.col("_n"))), F.lit(0)).alias("n_band"),
    ]
    for rank in RANKS:
        aggs += [
            F.min(F.when(inside, F.col(f"_lo_{rank}"))).alias(f"_lo_{rank}"),
            F.max(F.when(inside, F.col(f"_hi_{rank}"))).alias(f"_hi_{rank}"),
        ]
    done = levels.groupBy("qseqid").agg(*aggs)
    out, broken = [], F.lit(False)
    for rank in RANKS:
        broken = broken | F.coalesce(F.col(f"_lo_{rank}") != F.col(f"_hi_{rank}"), F.lit(False))
        out.append(F.when(~broken, F.col(f"_lo_{rank}")).alias(rank))
    return done.select(
        F.col("qseqid").alias("asv_id"),
        F.coalesce("_best", "_any").alias("pident"),
        "n_band",
        *out,
    )


def flag_contaminants(
    df: DataFrame, contaminants: Iterable[str], parts: bool = False, species: str = "species"
) -> DataFrame:
    """Add the contaminant flag; ``parts`` matches any ``/`` component. Rows stay."""
    names = sorted(set(contaminants))
    value = F.coalesce(F.col(species), F.lit(""))
    if not names:
        flag = F.lit(False)
    elif parts:
        flag = F.arrays_overlap(F.split(value, "/"), F.array(*[F.lit(n) for n in names]))
    else:
        flag = value.isin(*names)
    return df.withColumn(CONTAMINANT_FLAG, flag)


def contaminant_counts(df: DataFrame, contaminants: Iterable[str]) -> DataFrame:
    """Flagged features per matched contaminant, multi-hit cells counted by component."""
    names = sorted(set(contaminants))
    part = df.select(F.explode(F.split(F.coalesce("species", F.lit("")), "/")).alias("species"))
    return part.where(F.col("species").isin(*names)).groupBy("species").agg(
        F.count(F.lit(1)).alias("n_features")
    )


def match_queries(counted: DataFrame, queries: DataFrame) -> DataFrame:
    """Sequences of the count table joined with the query FASTA ids on the sequence."""
    return counted.join(queries, "sequence")


def match_losses(counted: DataFrame, queries: DataFrame) -> DataFrame:
    """One row: shared sequences and how many either side loses, from one outer join."""
    left = counted.select("sequence", F.lit(1).alias("_c"))
    right = queries.select("sequence", F.lit(1).alias("_q"))
    both = left.join(right, "sequence", "full_outer")
    return both.agg(
        F.count(F.when(F.col("_c").isNotNull() & F.col("_q").isNotNull(), 1)).alias("n_shared"),
        F.count(F.when(F.col("_q").isNull(), 1)).alias("n_counts_only"),
        F.count(F.when(F.col("_c").isNull(), 1)).alias("n_fasta_only"),
    )


def fill_unassigned(features: DataFrame, resolved: DataFrame, key: str = "asv_id") -> DataFrame:
    """Every feature with its ranks, ``Unassigned`` where nothing was resolved."""
    joined = features.join(resolved.select(key, "pident", *[_r(r) for r in RANKS]), key, "left")
    return _with_ranks(joined, {r: F.coalesce(_r(r), F.lit(UNASSIGNED)) for r in RANKS})


def feature_number(c: Column | str) -> Column:
    """First number in a feature id, for ordering."""
    value = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(value, r"(\d+)", 1).try_cast("long")


def link_taxonomy(
    features: DataFrame,
    taxonomy: DataFrame,
    cascade_ranks: Sequence[str] = RANKS,
    contaminants: Iterable[str] = (),
    pident_col: str | None = None,
) -> DataFrame:
    """Features joined with a per-sequence taxonomy table of any classifier.

    Accepts the sequence under several names, maps sentinels to ``Unassigned``, cascades over
    ``cascade_ranks`` and flags contaminants by component.
    """
    if "sequence" not in taxonomy.columns:
        alias = [c for c in taxonomy.columns if c.lower() in ("sequence", "seq", "asv", "asv_seq")]
        if not alias:
            raise ValueError(f"no sequence column among {taxonomy.columns}")
        taxonomy = taxonomy.withColumnRenamed(alias[0], "sequence")
    present = [r for r in RANKS if r in taxonomy.columns]
    pident = F.col(pident_col).try_cast("double") if pident_col else F.lit(None).cast("double")
    right = taxonomy.select("sequence", pident.alias("pident"), *[_r(r) for r in present])
    joined = features.join(right, "sequence", "left")
    blank = {r: F.lit(UNASSIGNED) for r in RANKS if r not in present}
    fallen = cascade(_with_ranks(joined, blank), is_missing_taxon, F.lit(UNASSIGNED), cascade_ranks)
    fallen = _with_ranks(fallen, {r: taxon_or_label(_r(r)) for r in RANKS if r not in cascade_ranks})
    return flag_contaminants(fallen, contaminants, parts=True)


def duplicate_sequences(taxonomy: DataFrame) -> DataFrame:
    """Sequences that would fan out a join with the features."""
    return taxonomy.groupBy("sequence").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assign_from_hits(
    features: DataFrame,
    hits: DataFrame,
    lineage: DataFrame,
    algorithm: str = "cascade",
    thresholds: Mapping[str, float] = CLASS_THRESHOLDS,
    contaminants: Iterable[str] = (),
    **params: float,
) -> DataFrame:
    """Hits to the final taxonomy: lineage, thresholds, consensus, fill, flag."""
    described = attach_lineage(hits, lineage)
    if algorithm == "cascade":
        resolved = resolve_cascade(filter_identity(described, thresholds), **params)
    elif algorithm == "collapsed":
        resolved = resolve_collapsed(described, **params)
    else:
        raise ValueError(f"unknown consensus algorithm {algorithm!r}")
    return flag_contaminants(fill_unassigned(features, resolved), contaminants)


def assignment_guards(
    taxonomy: DataFrame,
    resolved: DataFrame,
    genus_threshold: float = CLASS_THRESHOLDS["genus"],
) -> DataFrame:
    """One row of counts to look at: confident but collapsed, below the floor, without hits."""
    no_rank = F.lit(True)
    for rank in RANKS:
        no_rank = no_rank & _r(rank).isNull()
    seen = resolved.agg(
        F.count(
            F.when((F.col("pident") >= genus_threshold) & _r("genus").isNull(), 1)
        ).alias("n_collapsed_below_genus"),
        F.count(F.when(no_rank & F.col("pident").isNotNull(), 1)).alias("n_below_floor"),
    )
    without = taxonomy.select("asv_id").join(resolved.select("asv_id"), "asv_id", "left_anti")
    return seen.withColumn("n_without_hits", without.agg(F.count(F.lit(1))).scalar())


def missing_rank_counts(taxonomy: DataFrame) -> DataFrame:
    """Features without a taxon, per rank."""
    counted = taxonomy.agg(
        *[F.count(F.when(is_missing_taxon(_r(r)), 1)).alias(r) for r in RANKS]
    )
    return counted.unpivot([], [_r(r) for r in RANKS], "rank", "n_missing")
