"""Decontamination of counts against negative controls, in long form.

Presence in controls is one row per feature (whole-dataset controls) or per feature and
extraction batch, so samples and controls are never paired with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.controls import (
    NEGATIVE,
    POSITIVE,
    UNCLASSIFIED,
    classify_control,
    is_extraction_negative,
)

MODES = ("flag", "subtract")
CONTROL_FLAG = "in_negative_control"


def last_manifest_rows(manifest: DataFrame) -> DataFrame:
    """One row for each eventID: its last in the manifest's order.

    That is the order of ``row_no``, which scans carry. A manifest without it must not have been
    shuffled, as its rows then go by where they lie.
    """
    fields = ["samp_category", "neg_cont_type", "extraction_ID"]
    place = F.col("row_no") if "row_no" in manifest.columns else F.monotonically_increasing_id()
    ordered = manifest.select("eventID", F.struct(*fields).alias("_m"), place.alias("_row"))
    return ordered.groupBy("eventID").agg(F.max_by("_m", "_row").alias("_m")).select("eventID", "_m.*")


def sample_roles(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Role of every sample of the counts: control (with its batch) or biological.

    The manifest decides; a sample it does not list is classified by name. Of the manifest's
    rows for one sample (it may be in several runs) the last counts, so no read counts twice.
    Only negative controls clean; positive controls are cleaned like samples.
    """
    names = counts.select("eventID").distinct()
    listed = last_manifest_rows(manifest).withColumn("listed", F.lit(True))
    byname = classify_control("eventID")
    joined = names.join(listed, "eventID", "left").withColumn("_c", byname)
    listed_col = F.coalesce(F.col("listed"), F.lit(False))
    category = F.when(listed_col, F.col("samp_category")).otherwise(F.col("_c.samp_category"))
    neg = F.when(listed_col, F.col("neg_cont_type")).otherwise(F.col("_c.neg_cont_type"))
    control = (category == NEGATIVE) & (listed_col | neg.isNotNull())
    batch = F.when(is_extraction_negative(neg) & (F.col("extraction_ID") != ""), F.col("extraction_ID"))
    note = (
        F.when(listed_col & (category == NEGATIVE), F.lit(None).cast("string"))
        .when(listed_col & (category != "sample"), F.lit("control that does not clean"))
        .when(listed_col, F.lit(None).cast("string"))
        .when(control, F.lit("control by name, not in manifest"))
        .when(category == POSITIVE, F.lit("positive control by name, does not clean"))
        .when(F.col("_c.rule") == UNCLASSIFIED, F.lit("not in manifest, control-like name"))
        .otherwise(F.lit("not in manifest, taken as a sample"))
    )
    return joined.select(
        "eventID",
        control.alias("is_control"),
        neg.alias("neg_cont_type"),
        F.col("extraction_ID").alias("extraction_ID"),
        F.when(control, batch).alias("batch"),
        note.alias("note"),
    )


def control_scopes(roles: DataFrame) -> DataFrame:
    """Controls with their reach: an extraction batch, or the whole dataset."""
    return roles.where("is_control").select(
        "eventID",
        F.when(F.col("batch").isNull(), F.lit("all")).otherwise(F.lit("batch")).alias("scope"),
        "batch",
    )


def applicable_controls(roles: DataFrame) -> DataFrame:
    """Per biological sample, the names of the controls that reach it, whole-dataset ones first.

    Names are gathered once for the dataset and once per batch, then attached by key.
    """
    controls = control_scopes(roles)
    whole = controls.where("scope = 'all'").agg(
        F.concat_ws("|", F.sort_array(F.collect_list("eventID"))).alias("names")
    )
    per_batch = (
        controls.where("scope = 'batch'")
        .groupBy("batch")
        .agg(
            F.concat_ws("|", F.sort_array(F.collect_list("eventID"))).alias("_batch_names"),
            F.count(F.lit(1)).alias("_batch_n"),
        )
    )
    n_whole = controls.where("scope = 'all'").agg(F.count(F.lit(1)).alias("n"))
    samples = roles.where(~F.col("is_control")).select(
        "eventID", F.col("extraction_ID").alias("batch")
    )
    joined = samples.join(per_batch, "batch", "left")
    whole_names = F.when(whole.scalar() != "", whole.scalar())
    return joined.select(
        "eventID",
        (n_whole.scalar() + F.coalesce("_batch_n", F.lit(0))).alias("n_controls"),
        F.concat_ws("|", whole_names, F.col("_batch_names")).alias("driving_controls"),
    )


def control_presence(counts: DataFrame, roles: DataFrame) -> DataFrame:
    """Distinct (feature, reach) pairs with reads in a control; ``batch`` null = whole dataset."""
    controls = roles.where("is_control").select("eventID", "batch")
    return (
        counts.where("reads > 0").join(controls, "eventID").select("asv_id", "batch").distinct()
    )


def removed_pairs(counts: DataFrame, roles: DataFrame) -> DataFrame:
    """Biological counts with ``removed``: the feature is in a control that reaches the sample."""
    presence = control_presence(counts, roles)
    whole = presence.where("batch IS NULL").select("asv_id", F.lit(True).alias("_whole"))
    batched = presence.where("batch IS NOT NULL").select("asv_id", "batch", F.lit(True).alias("_b"))
    samples = roles.where(~F.col("is_control")).select(
        "eventID", F.col("extraction_ID").alias("batch")
    )
    bio = counts.join(samples, "eventID")
    return (
        bio.join(whole, "asv_id", "left")
        .join(batched, ["asv_id", "batch"], "left")
        .select(
            "asv_id",
            "eventID",
            "reads",
            ((F.col("reads") > 0) & (F.col("_whole").isNotNull() | F.col("_b").isNotNull())).alias(
                "removed"
            ),
        )
    )


def clean_counts(counts: DataFrame, manifest: DataFrame, mode: str = "flag") -> DataFrame:
    """Counts with the control flag; ``subtract`` zeroes removed pairs. Controls keep theirs."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}; got {mode!r}")
    roles = sample_roles(counts, manifest)
    flagged = control_presence(counts, roles).select("asv_id").distinct()
    marked = removed_pairs(counts, roles)
    if mode == "subtract":
        marked = marked.withColumn("reads", F.when(F.col("removed"), 0).otherwise(F.col("reads")))
    kept = counts.join(roles.where("is_control").select("eventID"), "eventID")
    both = marked.select("asv_id", "eventID", "reads").unionByName(
        kept.select("asv_id", "eventID", "reads")
    )
    return (
        both.join(flagged.withColumn(CONTROL_FLAG, F.lit(True)), "asv_id", "left")
        .withColumn(CONTROL_FLAG, F.coalesce(CONTROL_FLAG, F.lit(False)))
        .withColumn("reads", F.col("reads").cast("long"))
    )


def cleaning_report(counts: DataFrame, manifest: DataFrame, mode: str = "flag") -> DataFrame:
    """Per biological sample: reads before and after, what was removed and by which controls.

    In flag mode the removal columns still say what subtracting would take.
    """
    roles = sample_roles(counts, manifest)
    per_sample = removed_pairs(counts, roles).groupBy("eventID").agg(
        F.sum("reads").alias("reads_before"),
        F.count(F.when(F.col("removed"), 1)).alias("n_otus_removed"),
        F.coalesce(F.sum(F.when(F.col("removed"), F.col("reads"))), F.lit(0)).alias("n_reads_removed"),
    )
    taken = F.col("n_reads_removed") if mode == "subtract" else F.lit(0).cast("long")
    return per_sample.join(applicable_controls(roles), "eventID").select(
        "eventID",
        "reads_before",
        (F.col("reads_before") - taken).alias("reads_after"),
        "n_otus_removed",
        "n_reads_removed",
        "driving_controls",
    )


def cleaning_summary(counts: DataFrame, manifest: DataFrame, mode: str = "flag") -> DataFrame:
    """One row: mode, controls, samples, flagged features and reads actually removed."""
    roles = sample_roles(counts, manifest)
    n = roles.agg(
        F.count(F.when(F.col("is_control"), 1)).alias("n_controls"),
        F.count(F.when(~F.col("is_control"), 1)).alias("n_samples"),
    )
    flagged = control_presence(counts, roles).agg(F.count_distinct("asv_id"))
    removed = removed_pairs(counts, roles).where("removed").agg(F.coalesce(F.sum("reads"), F.lit(0)))
    total = removed.scalar() if mode == "subtract" else F.lit(0).cast("long")
    return n.select(
        F.lit(mode).alias("mode"),
        "n_controls",
        "n_samples",
        flagged.scalar().alias("n_otus_flagged"),
        total.alias("total_reads_removed"),
    )


def unmatched_blank_batches(roles: DataFrame) -> DataFrame:
    """Extraction blanks whose batch holds no biological sample: they clean nothing."""
    blanks = roles.where("is_control AND batch IS NOT NULL").select("eventID", "batch")
    used = (
        roles.where("NOT is_control AND extraction_ID IS NOT NULL")
        .select(F.col("extraction_ID").alias("batch"))
        .distinct()
    )
    return blanks.join(used, "batch", "left_anti")
