"""Numbers of the run report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.controls import is_negative_control
from tidemark.functions.nulls import is_assigned
from tidemark.functions.ranks import RANKS, finest_taxon
from tidemark.functions.text import EVENT_LEVELS, line_level
from tidemark.skew import exact_median, rank_by_position


def _r(rank: str) -> Column:
    return F.col(f"`{rank}`")


def feature_metrics(counts: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """Features, samples, reads, exact median abundance and sequence lengths: one row."""
    per_feature = counts.groupBy("asv_id").agg(F.sum("reads").alias("total"))
    median = exact_median(per_feature, F.col("total"))
    row = per_feature.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum("total").alias("total_abundance"),
    ).withColumn("median_abundance", F.lit(median).cast("double")).withColumn("n_samples", counts.agg(F.count_distinct("eventID")).scalar())
    if sequences is None:
        return row
    lengths = sequences.agg(
        F.min(F.length("sequence")).alias("lo"),
        F.max(F.length("sequence")).alias("hi"),
        F.avg(F.length("sequence")).alias("mean"),
    )
    return row.withColumns(
        {
            "min_length": lengths.select("lo").scalar(),
            "max_length": lengths.select("hi").scalar(),
            "mean_length": lengths.select("mean").scalar(),
        }
    )


def richness(counts: DataFrame) -> DataFrame:
    """Features with reads, per sample."""
    return counts.groupBy("eventID").agg(F.count(F.when(F.col("reads") > 0, 1)).alias("richness"))


def assigned_per_rank(taxonomy: DataFrame) -> DataFrame:
    """Features assigned per rank, count and percent: one pass, then unpivoted."""
    counted = taxonomy.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.when(is_assigned(_r(r)), 1)).alias(r) for r in RANKS]
    )
    long = counted.unpivot(["_n"], [_r(r) for r in RANKS], "rank", "n_assigned")
    share = F.coalesce(F.try_divide("n_assigned", "_n") * 100, F.lit(0.0))
    return long.select("rank", "n_assigned", share.alias("pct"))


def biological(counts: DataFrame) -> DataFrame:
    """Counts of non-control samples; all counts when every sample is a control."""
    flagged = counts.withColumn("_control", is_negative_control("eventID"))
    has_bio = counts.agg(F.bool_or(~is_negative_control("eventID"))).scalar()
    return flagged.where(~F.col("_control") | ~has_bio).drop("_control")


def top_species(counts: DataFrame, taxonomy: DataFrame, n: int = 20) -> DataFrame:
    """Species with most reads over biological samples and the samples they occur in."""
    species = taxonomy.where(is_assigned("species")).select("asv_id", "species")
    per_sample = (
        biological(counts)
        .join(species, "asv_id")
        .groupBy("species", "eventID")
        .agg(F.sum("reads").alias("reads"))
    )
    totals = per_sample.groupBy("species").agg(
        F.sum("reads").alias("reads"), F.count(F.when(F.col("reads") > 0, 1)).alias("n_samples")
    )
    return totals.orderBy(F.desc("reads"), "species").limit(n)


def top_genera(taxonomy: DataFrame, n: int = 15) -> DataFrame:
    counted = taxonomy.where(is_assigned("genus")).groupBy("genus").agg(
        F.count(F.lit(1)).alias("n_features")
    )
    return counted.orderBy(F.desc("n_features"), "genus").limit(n)


def chimera_classes(table: DataFrame) -> DataFrame:
    return table.groupBy("chimera").agg(F.count(F.lit(1)).alias("n_otus"))


def distribution(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram of a numeric column with its exact median on every row."""
    value = F.col(column).cast("double")
    edges = df.where(value.isNotNull()).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    median = F.lit(exact_median(df, value)).cast("double")
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    at = F.when(width > 0, F.least(F.floor((value - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        df.where(value.isNotNull())
        .groupBy(at.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"lo": lo + width * F.col("bin"), "median": median})
    )


def control_features(counts: DataFrame, taxonomy: DataFrame, n: int = 15) -> DataFrame:
    """Features with most reads in negative controls: taxon, reads there and in samples."""
    control = is_negative_control("eventID")
    per_feature = counts.groupBy("asv_id").agg(
        F.coalesce(F.sum(F.when(control, F.col("reads"))), F.lit(0)).alias("control_reads"),
        F.coalesce(F.sum(F.when(~control, F.col("reads"))), F.lit(0)).alias("sample_reads"),
    )
    top = per_feature.where("control_reads > 0").orderBy(F.desc("control_reads"), "asv_id").limit(n)
    named = taxonomy.select("asv_id", finest_taxon().alias("taxon"))
    return top.join(named, "asv_id")


def control_reads(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Reads of the given features in each negative control."""
    return counts.where(is_negative_control("eventID") & (F.col("reads") > 0)).join(
        F.broadcast(features.select("asv_id")), "asv_id"
    ).select("asv_id", "eventID", "reads")


def run_totals(tracking: DataFrame, taxonomy: DataFrame, final_step: str, chimera: DataFrame | None = None) -> DataFrame:
    """One row for the head of the report."""
    row = tracking.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count(F.when(is_negative_control("sample"), 1)).alias("n_controls"),
        F.sum("raw").alias("raw_reads"),
        F.sum(final_step).alias("final_reads"),
        F.avg("pct_retained").alias("mean_retention"),
    )
    row = row.withColumn("retained_pct", F.try_divide("final_reads", "raw_reads") * 100)
    tax = taxonomy.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(is_assigned(r), 1)).alias(r) for r in ("species", "genus", "phylum")],
    )
    total = tax.select("n").scalar()
    row = row.withColumn("n_features", total)
    for r in ("species", "genus", "phylum"):
        row = row.withColumn(f"{r}_pct", F.try_divide(tax.select(r).scalar(), total) * 100)
    row = row.withColumn("median_identity", F.lit(exact_median(taxonomy, F.col("pident"))).cast("double"))
    if chimera is not None:
        removed = chimera.agg(F.count(F.when(F.col("chimera") == "Y", 1))).scalar()
        row = row.withColumn("chimeras_removed", removed)
    return row


def dataset_facts(field: DataFrame) -> DataFrame:
    """Centroid, bounds, distinct sites, date span and depth range over non-control samples."""
    bio = field.where(~is_negative_control("eventID"))
    lat, lon = F.col("decimalLatitude").try_cast("double"), F.col("decimalLongitude").try_cast("double")
    date = F.when(~F.col("eventDate").isin("", "NA", "nan"), F.col("eventDate"))
    depth = F.col("depth").try_cast("double")
    return bio.agg(
        F.avg(lat).alias("lat_mean"),
        F.avg(lon).alias("lon_mean"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.count_distinct(
            F.when(lat.isNotNull() & lon.isNotNull(), F.struct(F.round(lat, 4), F.round(lon, 4)))
        ).alias("n_sites"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(depth).alias("depth_min"),
        F.max(depth).alias("depth_max"),
    )


def value_list(field: DataFrame, column: str, n: int) -> DataFrame:
    """First ``n`` distinct values of a metadata column, in order, and how many there are."""
    value = F.col(column).cast("string")
    distinct = field.where(value.isNotNull() & ~value.isin("", "NA", "nan")).select(
        value.alias("value")
    ).distinct()
    total = distinct.agg(F.count(F.lit(1))).scalar()
    return distinct.orderBy("value").limit(n).withColumn("n_values", total)


def excerpt_log(lines: DataFrame, log: str, budget: int = 1500, edge: int = 45) -> DataFrame:
    """Head, tail and earliest events of every long log, with the lines skipped before each row.

    ``lines`` holds ``log``, ``line_no`` (0-based, dense) and ``text``. A log that fits the
    budget is kept whole. Per log the window below holds at most ``budget`` rows.
    """
    sizes = lines.groupBy(log).agg(F.count(F.lit(1)).alias("_n"))
    typed = lines.join(sizes, log).withColumn("level", line_level("text"))
    near = (F.col("line_no") < edge) | (F.col("line_no") >= F.col("_n") - edge)
    events = typed.where((F.col("_n") > budget) & F.col("level").isin(*EVENT_LEVELS))
    events = (
        rank_by_position(events, [log], "line_no", "_k")
        .where(F.col("_k") <= max(0, budget - 2 * edge))
        .select(log, "line_no", "level", "text")
    )
    base = typed.where((F.col("_n") <= budget) | near).select(log, "line_no", "level", "text")
    kept = base.unionByName(events).distinct()
    before = F.lag("line_no").over(Window.partitionBy(log).orderBy("line_no"))
    return kept.withColumn("n_omitted_before", F.coalesce(F.col("line_no") - before - 1, F.lit(0)))


def step_timeline(steps: DataFrame) -> DataFrame:
    """Status and duration of every step of every run."""
    return steps.select("marker", "step", F.lower("status").alias("status"), "duration_seconds")


def monitor_counts(steps: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per-sample counts kept in the run state, one row per sample."""
    per_sample = steps.where("per_sample IS NOT NULL").select(
        "marker", F.explode("per_sample").alias("eventID", "counts")
    )
    return per_sample.select(
        "marker", "eventID", *[F.try_element_at("counts", F.lit(n)).alias(n) for n in names]
    )
