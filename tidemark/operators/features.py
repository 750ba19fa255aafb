"""Feature tables: dereplication, the OTU table and its derived forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.sequences import amplicon_id
from tidemark.skew import number_rows


def dereplicate_samples(reads: DataFrame, min_size: int = 1) -> DataFrame:
    """Identical sequences of a sample: ``(sample, amplicon, sequence, size)``."""
    counted = reads.groupBy("sample", "sequence").agg(F.count(F.lit(1)).alias("size"))
    return counted.where(F.col("size") >= min_size).withColumn("amplicon", amplicon_id("sequence"))


def combine_samples(*samples: DataFrame) -> DataFrame:
    """All samples' amplicons in one table."""
    out = samples[0]
    for df in samples[1:]:
        out = out.unionByName(df)
    return out


def dereplicate_all(amplicons: DataFrame) -> DataFrame:
    """Sizes added up over samples: ``(amplicon, sequence, size)``."""
    summed = amplicons.groupBy("sequence").agg(F.sum("size").alias("size"))
    return summed.withColumn("amplicon", amplicon_id("sequence"))


def by_abundance(amplicons: DataFrame) -> DataFrame:
    """Largest first, ties by id."""
    return amplicons.orderBy(F.desc("size"), "amplicon")


def number_seeds(stats: DataFrame) -> DataFrame:
    """OTU numbers: by mass, then seed, both descending, before any seed is dropped."""
    return number_rows(stats, [F.desc("mass"), F.desc("seed")], "OTU")


def describe_seeds(stats: DataFrame, representatives: DataFrame, chimera: DataFrame | None) -> DataFrame:
    """Numbered seeds with their sequence and chimera status (``NA`` when unscored).

    A seed without a representative keeps its number and is left out;
    :func:`seeds_without_representative` lists it.
    """
    df = number_seeds(stats).join(representatives.where("sequence <> ''"), "seed")
    if chimera is None:
        return df.withColumn("chimera", F.lit("NA"))
    return df.join(chimera, "seed", "left").withColumn("chimera", F.coalesce("chimera", F.lit("NA")))


def seeds_without_representative(stats: DataFrame, representatives: DataFrame) -> DataFrame:
    return stats.select("seed").join(representatives.where("sequence <> ''"), "seed", "left_anti")


def seed_sample_sizes(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Reads of a cluster per sample: membership joined on the amplicon, then summed."""
    joined = sizes.join(members, "amplicon")
    return joined.groupBy("seed", "sample").agg(F.sum("size").alias("reads"))


def otu_table(
    stats: DataFrame, members: DataFrame, representatives: DataFrame, sizes: DataFrame,
    chimera: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Features and counts of the clustering, in long form.

    Features: OTU, total, cloud, amplicon, length, abundance, chimera, spread, sequence.
    Counts: OTU, sample, reads, only where reads were seen.
    """
    per_sample = seed_sample_sizes(members, sizes)
    spread = per_sample.groupBy("seed").agg(F.count(F.when(F.col("reads") > 0, 1)).alias("spread"))
    described = describe_seeds(stats, representatives, chimera)
    features = described.join(spread, "seed", "left").select(
        "OTU",
        F.col("mass").alias("total"),
        "cloud",
        F.col("seed").alias("amplicon"),
        F.length("sequence").cast("long").alias("length"),
        F.col("seed_abundance").alias("abundance"),
        "chimera",
        F.coalesce("spread", F.lit(0)).alias("spread"),
        "sequence",
    )
    numbers = described.select("seed", "OTU")
    counts = per_sample.where("reads > 0").join(numbers, "seed").select("OTU", "sample", "reads")
    return features, counts


def without_chimeras(features: DataFrame) -> DataFrame:
    """Drop definite chimeras only; borderline and unscored features stay."""
    known = features.withColumn("chimera", F.coalesce("chimera", F.lit("NA")))
    return known.where("chimera <> 'Y'")


def sequence_table(merged: DataFrame) -> DataFrame:
    """Reads per sample and sequence, over any number of runs or libraries."""
    return merged.groupBy("sample", "sequence").agg(F.sum("reads").alias("reads"))
