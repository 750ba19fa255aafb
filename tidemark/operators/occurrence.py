"""Wide and long count tables, occurrences and Darwin Core records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.controls import UNCLASSIFIED, classify_control, is_control
from tidemark.functions.nulls import label_to_null, taxon_or_null
from tidemark.functions.ranks import RANKS, rank_label, taxon_label
from tidemark.functions.sequences import occurrence_id
from tidemark.functions.text import event_key

# Columns that are never samples, per table kind.
ANNOTATIONS = ("ASV_ID", "asv_id", "pident", "is_contaminant_candidate")
CLEANING_ANNOTATIONS = (
    *RANKS, "sequence", "Sequence", "ASV_ID", "OTU", "OTU_ID", "taxon", "rank", "pident",
    "is_contaminant_candidate",
)
OTU_TABLE_COLUMNS = (
    "OTU", "total", "cloud", "amplicon", "length", "abundance", "chimera", "spread", "sequence",
)
TAXONOMY_COLUMNS = (
    *RANKS, "ASV_ID", "OTU_ID", "pident", "is_contaminant_candidate", "Sequence", "sequence",
)
ABUNDANCE_COLUMNS = (
    "", "otu", "otu_id", "asv", "asv_id", "id", "seed", "amplicon", "sequence", "seq", "total",
    "total_reads", "nb_reads", "nb_reads_total", "size", "length", "chimera", "cluster",
    "n_samples", "spread", "abundance", "identity", "taxonomy", *RANKS, "taxon", "rank",
)

# Taxa that are not the target of a marker, by rank.
NON_TARGET = {
    "teleo": {
        "class": ("Gastropoda", "Holothuroidea", "Deinococci", "Branchiopoda"),
        "order": ("Primates", "Galliformes"),
        "family": ("Hominidae",),
        "genus": ("Gorilla", "Homo", "Pan", "Macaca"),
    }
}

#: Column that holds a wide table's sample cells; its metadata names the samples.
PACKED = "sample_counts"


def _r(rank: str) -> Column:
    return F.col(f"`{rank}`")


def sample_columns(
    df: DataFrame, known: Iterable[str], keep: Iterable[str] = (), any_case: bool = False,
    numeric: bool = True,
) -> list[str]:
    """Per-sample columns of a wide table, from the schema alone: no job runs.

    ``known`` are annotation columns; ``keep`` names win over them; ``any_case`` compares
    lower-cased and stripped names. A packed column stands for its samples.
    """
    deny = {k.lower() for k in known} if any_case else set(known)
    forced = set(keep)

    def is_sample(field: T.StructField) -> bool:
        name = field.name.strip()
        if name in forced:
            return True
        if (name.lower() if any_case else name) in deny:
            return False
        return not numeric or isinstance(field.dataType, T.NumericType)

    names = [n for f in df.schema for n in ([f.name] if f.name != PACKED else f.metadata["samples"])]
    plain = {f.name: f for f in df.schema if f.name != PACKED}
    return [n for n in names if is_sample(plain.get(n, T.StructField(n, T.LongType())))]


def reserved_sample_names(samples: DataFrame, reserved: Sequence[str] = OTU_TABLE_COLUMNS) -> DataFrame:
    """Sample names that would overwrite a column of the OTU table."""
    return samples.select("sample").distinct().where(F.col("sample").isin(*reserved))


def melt_counts(wide: DataFrame, ids: Sequence[str], samples: Sequence[str], zeros: bool = True) -> DataFrame:
    """Wide to long: one row per feature and sample, of sample columns or of a packed column.

    For a caller that keeps no zeros, as :func:`nonzero` does, those that a packed column does not hold need not be
    filled in: without ``zeros`` the cells it holds are melted as they are.
    """
    if not samples:
        raise ValueError("no numeric per-sample column to melt")
    if PACKED in wide.columns:
        names = packed_samples(wide)
        wanted = set(samples)
        listed = sample_positions(wide.sparkSession, [(i, n) for i, n in enumerate(names) if n in wanted], "_at int, eventID string")
        cells = wide.select(*[F.col(f"`{c}`") for c in ids], *_placed(len(names), zeros))
        return cells.join(listed, "_at").select(*[F.col(f"`{c}`") for c in ids], "eventID", "nb_reads")
    typed = wide.select(
        *[F.col(f"`{c}`") for c in ids], *[F.col(f"`{s}`").cast("long").alias(s) for s in samples]
    )
    return typed.unpivot(
        [F.col(f"`{c}`") for c in ids], [F.col(f"`{s}`") for s in samples], "eventID", "nb_reads"
    )


def _placed(size: int, zeros: bool) -> list[Column]:
    """``_at, nb_reads`` of the cells of a packed column, one row each."""
    if zeros:
        return [F.posexplode(zero_filled(size)).alias("_at", "nb_reads")]
    return [F.inline(PACKED).alias("_at", "nb_reads")]


def sample_positions(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Places of the samples, one row per sample."""
    return spark.createDataFrame(list(rows), schema)


def spread_counts(
    long: DataFrame, ids: Sequence[str], samples: Sequence[object], value: str = "nb_reads",
    column: str = "eventID", labels: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide with an explicit sample list, whose cells are one packed column.

    It holds ``(at, n)`` of a row's cells that are not zero, by place in the list; all others are zero.
    So a row costs what it counts, however many samples there are. ``labels`` name the
    samples where ``column`` holds another key; a sample that is listed twice has two equal cells.
    """
    key = long.schema[column].dataType
    places = T.StructType([T.StructField(column, key), T.StructField("_at", T.IntegerType())])
    listed = sample_positions(long.sparkSession, [(s, i) for i, s in enumerate(samples)], places)
    summed = long.groupBy(*ids, column).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("_n"))
    cell = F.when(F.col("_at").isNotNull() & (F.col("_n") != 0), F.struct(F.col("_at").alias("at"), F.col("_n").alias("n")))
    wide = summed.join(listed, column, "left").groupBy(*ids).agg(F.sort_array(F.collect_list(cell)).alias(PACKED))
    return wide.withMetadata(PACKED, {"samples": [str(s) for s in (samples if labels is None else labels)]})


def packed_samples(wide: DataFrame) -> list[str]:
    """Samples of a packed column, in the order of its places."""
    return wide.schema[PACKED].metadata["samples"]


def _gap(i: Column) -> Column:
    """Zeros before the ``i``-th cell of a packed column."""
    before = F.when(i > 0, F.get(PACKED, i - 1)["at"]).otherwise(F.lit(-1))
    return F.get(PACKED, i)["at"] - before - 1


def _rest(size: int) -> Column:
    """Zeros behind the last cell of a packed column."""
    return F.lit(size - 1) - F.coalesce(F.get(PACKED, F.size(PACKED) - 1)["at"], F.lit(-1))


def zero_filled(size: int) -> Column:
    """The cells of a packed column as one array, zeros included; of a null column all are zero."""
    zero = F.lit(0).cast("long")
    pieces = F.transform(PACKED, lambda c, i: F.concat(F.array_repeat(zero, _gap(i)), F.array(c["n"])))
    return F.concat(F.coalesce(F.flatten(pieces), F.array().cast("array<bigint>")), F.array_repeat(zero, _rest(size)))


def cells_as_text(size: int, sep: str = ",") -> Column:
    """The cells of a packed column as text, each behind a separator, zeros included as in :func:`zero_filled`."""
    zero = F.lit(f"{sep}0")
    pieces = F.transform(PACKED, lambda c, i: F.concat(F.repeat(zero, _gap(i)), F.lit(sep), c["n"].cast("string")))
    return F.concat(F.coalesce(F.array_join(pieces, ""), F.lit("")), F.repeat(zero, _rest(size)))


def nonzero(long: DataFrame, value: str = "nb_reads") -> DataFrame:
    return long.where(F.col(value) > 0)


def standard_schema(wide: DataFrame) -> DataFrame:
    """Search or classifier table to the standard columns, ``Unassigned`` back to null."""
    df = wide.drop("X")
    if "Sequence" in df.columns and "sequence" not in df.columns:
        df = df.withColumnRenamed("Sequence", "sequence")
    lacking = [c for c in (*RANKS, "sequence") if c not in df.columns]
    if lacking:
        raise ValueError(f"taxonomy table lacks the columns {lacking}")
    return df.withColumns({r: label_to_null(_r(r)) for r in RANKS})


# Columns of the ecotag table and parts of names that mark its metadata.
ECOTAG_NAMES = {
    "order_name": "order", "family_name": "family", "genus_name": "genus", "species_name": "species",
}
ECOTAG_DROP = ("id", "definition", "count", "scientific_name")
ECOTAG_DROP_PARTS = ("best_identity", "best_match", "match_count", "species_list", "taxid")


def ecotag_schema(table: DataFrame) -> DataFrame:
    """Ecotag table to the standard columns.

    A rank column next to its ``*_name`` column holds a numeric taxid and is dropped, as is one
    without a name column; coarse ranks ecotag lacks are null; sentinels become null.
    """
    df = table.drop("X")
    named = [src for src in ECOTAG_NAMES if src in df.columns]
    if not named:
        raise ValueError(f"no rank-name column among {df.columns}")
    df = df.drop(*ECOTAG_NAMES.values())
    df = df.withColumnsRenamed({src: ECOTAG_NAMES[src] for src in named})
    extra = [c for c in df.columns if any(p in c for p in ECOTAG_DROP_PARTS)]
    df = df.drop(*ECOTAG_DROP, *extra)
    blank = {r: F.lit(None).cast("string") for r in RANKS if r not in df.columns}
    df = df.withColumns({**blank, **{ECOTAG_NAMES[s]: taxon_or_null(_r(ECOTAG_NAMES[s])) for s in named}})
    if "sequence" not in df.columns:
        raise ValueError("ecotag table has no sequence column")
    return df


def label_taxa(df: DataFrame) -> DataFrame:
    """Add ``rank`` and ``taxon``; a multi-hit species is blanked where it is not the rank."""
    return df.withColumns(
        {
            "rank": rank_label(_r("species"), _r("genus"), _r("family")),
            "taxon": taxon_label(_r),
            "species": F.when(~_r("species").contains("/"), _r("species")),
        }
    )


def to_occurrences(counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Positive counts joined with the taxonomy of their feature, rank and taxon labelled."""
    flag = ["is_contaminant_candidate"] if "is_contaminant_candidate" in taxonomy.columns else []
    described = label_taxa(
        taxonomy.withColumns({r: label_to_null(_r(r)) for r in RANKS})
    ).select("asv_id", *[_r(r) for r in RANKS], "taxon", "rank", "sequence", *flag)
    positive = counts.where("reads > 0").select("asv_id", "eventID", F.col("reads").alias("nb_reads"))
    return positive.join(described, "asv_id").select(
        *[_r(r) for r in RANKS], "taxon", "rank", "sequence", "nb_reads", "eventID", *flag
    )


def occurrences_from_wide(wide: DataFrame, method: str = "blast") -> DataFrame:
    """A wide method table straight to occurrences."""
    if method in ("blast", "dada2_rdp", "decipher"):
        df = standard_schema(wide)
    elif method == "ecotag":
        df = ecotag_schema(wide)
    else:
        raise ValueError(f"unknown method {method!r}")
    samples = sample_columns(df, (*RANKS, "sequence", *ANNOTATIONS))
    flag = [c for c in ("is_contaminant_candidate",) if c in df.columns]
    long = nonzero(melt_counts(df, [*RANKS, "sequence", *flag], samples))
    return label_taxa(long).select(
        *[_r(r) for r in RANKS], "taxon", "rank", "sequence", "nb_reads", "eventID", *flag
    )


def drop_non_target(occurrences: DataFrame, marker: str) -> DataFrame:
    """Remove taxa on the marker's deny-list. The key is case-sensitive; null never matches."""
    return occurrences.where(~non_target(marker))


def non_target(marker: str) -> Column:
    listed = F.lit(False)
    for rank, taxa in NON_TARGET.get(marker, {}).items():
        listed = listed | F.coalesce(_r(rank).isin(*taxa), F.lit(False))
    return listed


def drop_controls(occurrences: DataFrame) -> DataFrame:
    """Remove negative and positive control samples; a control-like name stays."""
    return occurrences.where(~is_control("eventID"))


def control_like_samples(occurrences: DataFrame) -> DataFrame:
    """Samples kept although their name looks like a control."""
    names = occurrences.select("eventID").distinct()
    return names.where(classify_control("eventID")["rule"] == UNCLASSIFIED)


def drop_reasons(occurrences: DataFrame, marker: str) -> DataFrame:
    """Every row with the reason it is filtered for, null where it stays."""
    reason = (
        F.when(is_control("eventID"), F.lit("negative/positive control"))
        .when(non_target(marker), F.lit(f"non-target taxon ({marker})"))
    )
    return occurrences.withColumn("drop_reason", reason)


def dropped_report(occurrences: DataFrame, marker: str) -> DataFrame:
    """Rows the control and non-target filters remove, with the reason."""
    keep = ["eventID", *RANKS, "taxon", "nb_reads", "drop_reason"]
    return drop_reasons(occurrences, marker).where("drop_reason IS NOT NULL").select(
        *[_r(c) for c in keep]
    )


def collapse_replicates(occurrences: DataFrame) -> DataFrame:
    """Strip the two-digit replicate suffix and sum reads per taxonomy, sequence and sample."""
    keys = [c for c in (*RANKS, "taxon", "rank", "sequence", "is_contaminant_candidate")
            if c in occurrences.columns]
    stripped = occurrences.withColumn("eventID", F.regexp_replace("eventID", r"_\d{2}$", ""))
    return stripped.groupBy(*[_r(k) for k in keys], "eventID").agg(F.sum("nb_reads").alias("nb_reads"))


def add_sample_totals(occurrences: DataFrame) -> DataFrame:
    """``nb_reads_total`` per eventID: summed map-side first, then joined back."""
    totals = occurrences.groupBy("eventID").agg(F.sum("nb_reads").alias("nb_reads_total"))
    return occurrences.join(totals, "eventID")


def rank_distribution(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy("rank").agg(F.count(F.lit(1)).alias("n_records"))


def export_statistics(occurrences: DataFrame) -> DataFrame:
    return occurrences.agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("eventID").alias("n_event_ids")
    )


def join_sample_metadata(occurrences: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join on the separator-free key; a matched row takes the metadata spelling."""
    right = metadata.withColumn("_key", event_key("eventID")).withColumnRenamed("eventID", "_canon")
    left = occurrences.withColumn("_key", event_key("eventID"))
    joined = left.join(right, "_key", "left")
    return joined.withColumn("metadata_matched", F.col("_canon").isNotNull()).withColumn(
        "eventID", F.coalesce("_canon", "eventID")
    ).drop("_key", "_canon")


def duplicate_event_keys(metadata: DataFrame) -> DataFrame:
    """Keys that more than one metadata row maps to; they would multiply reads."""
    keyed = metadata.select(event_key("eventID").alias("event_key")).where("event_key <> ''")
    return keyed.groupBy("event_key").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def metadata_match_rate(joined: DataFrame) -> DataFrame:
    return joined.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("metadata_matched"), 1)).alias("n_matched"),
        F.round(F.try_divide(F.count(F.when(F.col("metadata_matched"), 1)), F.count(F.lit(1))), 6).alias("match_rate"),
    )
