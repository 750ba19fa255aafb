"""Read tracking: how many reads survive each step, per sample and per run.

A count that was not measured is null, never 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DENOISE_STEPS = ("raw", "trimmed", "filtered", "denoised", "merged", "nonchim")
CLUSTER_STEPS = ("raw", "trimmed", "clustered")


def assemble_tracking(
    trim: DataFrame, track: DataFrame | None = None, clustered: DataFrame | None = None
) -> DataFrame:
    """Full outer join of the counts by sample; the denoiser's input fills a missing trim count."""
    if (track is None) == (clustered is None):
        raise ValueError("pass either the denoiser's counts or the clustered counts")
    steps = DENOISE_STEPS if track is not None else CLUSTER_STEPS
    other = track if track is not None else clustered
    df = trim.join(other, "sample", "full_outer")
    if track is not None:
        df = df.withColumn("trimmed", F.coalesce("trimmed", "input"))
    cols = [F.col(s).cast("long").alias(s) for s in steps]
    return df.select("sample", *cols, percent_retained(F.col(steps[-1]), F.col("raw")))


def percent_retained(final: Column, raw: Column) -> Column:
    return F.round(F.try_divide(final, raw) * 100, 2).alias("pct_retained")


def steps_of(df: DataFrame) -> list[str]:
    return [s for s in (*DENOISE_STEPS, "clustered") if s in df.columns]


def trim_loss(trim: DataFrame) -> DataFrame:
    """Run totals over samples with both counts; null loss when nothing was measured."""
    both = trim.where("raw IS NOT NULL AND trimmed IS NOT NULL")
    totals = both.agg(F.sum("raw").alias("raw_total"), F.sum("trimmed").alias("trimmed_total"))
    loss = F.when(
        F.col("raw_total") > 0, (F.lit(1) - F.try_divide("trimmed_total", "raw_total")) * 100
    )
    return totals.withColumn("loss_pct", loss)


def long_steps(tracking: DataFrame) -> DataFrame:
    """One row per sample and step, null where not measured."""
    steps = steps_of(tracking)
    order = F.create_map(*[F.lit(x) for i, s in enumerate(steps) for x in (s, i)])
    long = tracking.unpivot(["sample"], steps, "step", "reads")
    return long.withColumn("step_no", F.element_at(order, F.col("step")))


def step_summary(tracking: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Total reads per step (null if no sample was measured), features, unmeasured samples."""
    per_step = long_steps(tracking).groupBy("step", "step_no").agg(
        F.sum("reads").alias("total_reads"),
        F.count(F.when(F.col("reads").isNull(), 1)).alias("n_unmeasured"),
        F.count("reads").alias("n_measured"),
    )
    if features is None:
        return per_step.withColumn("n_features", F.lit(None).cast("long"))
    return per_step.join(features.select("step", "n_features"), "step", "left")


def unmeasured_samples(tracking: DataFrame) -> DataFrame:
    """Samples without a count at a step that others were measured at."""
    long = long_steps(tracking)
    measured = long.groupBy("step").agg(F.count("reads").alias("_n")).where("_n > 0")
    return long.where("reads IS NULL").join(measured, "step", "left_semi").select("sample", "step")


def step_losses(tracking: DataFrame, threshold: float = 70.0) -> DataFrame:
    """Steps that lose more than ``threshold`` percent of what the step before kept."""
    order = Window.partitionBy("sample").orderBy("step_no")
    long = long_steps(tracking).withColumns(
        {"previous": F.lag("reads").over(order), "previous_step": F.lag("step").over(order)}
    )
    loss = (F.lit(1) - F.try_divide("reads", "previous")) * 100
    return (
        long.where("previous > 0 AND reads IS NOT NULL")
        .withColumn("loss_pct", loss)
        .where(F.col("loss_pct") > threshold)
        .select("sample", "previous_step", "step", "previous", "reads", "loss_pct")
    )


def tracking_warnings(
    tracking: DataFrame, below_retention: float = 30.0, step_loss: float = 70.0
) -> DataFrame:
    """Warning rows ``(sample, kind, step, value)``: absent counts, low retention, step loss."""
    steps = steps_of(tracking)
    absent = (
        long_steps(tracking)
        .where("reads IS NULL")
        .select("sample", F.lit("absent").alias("kind"), "step", F.lit(None).cast("double").alias("value"))
    )
    low = tracking.where(F.col("pct_retained") < below_retention).select(
        "sample", F.lit("low retention"), F.lit(steps[-1]), "pct_retained"
    )
    lost = step_losses(tracking, step_loss).select(
        "sample", F.lit("step loss"), "step", F.col("loss_pct").alias("value")
    )
    return absent.union(low).union(lost)


def tracking_headline(tracking: DataFrame) -> DataFrame:
    """Samples, first and last totals, mean retention: one row."""
    steps = steps_of(tracking)
    return tracking.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("raw").alias("raw_reads_total"),
        F.lit(steps[-1]).alias("final_step"),
        F.sum(steps[-1]).alias("final_reads_total"),
        F.round(F.avg("pct_retained"), 2).alias("mean_retention_pct"),
    )


def per_sample_counts(tracking: DataFrame) -> DataFrame:
    """``(sample, counts)`` with a map from step to count, for the manifest's read columns."""
    steps = steps_of(tracking)
    pairs = [x for s in steps for x in (F.lit(s), F.col(s))]
    return tracking.select("sample", F.create_map(*pairs).alias("counts"))


def funnel(tracking: DataFrame) -> DataFrame:
    """Total per step and its share of the first step."""
    steps = steps_of(tracking)
    totals = tracking.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in steps])
    first = F.when(F.col(steps[0]) != 0, F.col(steps[0])).otherwise(F.lit(1))
    rows = [
        F.struct(F.lit(s).alias("step"), F.col(s).alias("total"), (F.col(s) / first * 100).alias("pct"))
        for s in steps
    ]
    return totals.select(F.inline(F.array(*rows)))


def stage_counts(stages: dict[str, DataFrame], first: Sequence[str] = ("input", "filtered")) -> DataFrame:
    """Reads per sample at each stage of a run; a later stage a sample never reached counts 0.

    ``stages`` maps a step to rows ``(sample, reads)``. This is the one table where a missing
    count is 0: the sample was measured before and lost.
    """
    names = list(stages)
    parts = [
        df.groupBy("sample").agg(F.sum("reads").alias("reads")).withColumn("step", F.lit(name))
        for name, df in stages.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    wide = union.groupBy("sample").pivot("step", names).agg(F.first("reads"))
    return wide.select(
        "sample",
        *[F.col(n) if n in first else F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names],
    )


def feature_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Distinct sequences per stage, one row each."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count_distinct("sequence").alias("n_features")).withColumn("step", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.select("step", "n_features")
