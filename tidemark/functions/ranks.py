"""Taxonomic ranks: order, cascades and labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.nulls import UNASSIGNED, is_assigned

RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")

# Default identity thresholds of the class entry point and of the configuration.
CLASS_THRESHOLDS = {"class": 70.0, "order": 80.0, "family": 86.5, "genus": 96.0, "species": 98.0}
CONFIG_THRESHOLDS = {"class": 70.0, "order": 80.0, "family": 90.0, "genus": 96.0, "species": 99.0}


def cascade(
    df: DataFrame,
    missing: Callable[[Column], Column],
    filler: Column,
    ranks: Sequence[str] = RANKS,
) -> DataFrame:
    """From the first missing rank of ``df`` on, every rank of ``ranks`` is ``filler``.

    The number of usable ranks is computed once per row and compared per rank, so the plan
    grows linearly with the ranks.
    """
    depth = F.lit(len(ranks))
    for i in reversed(range(len(ranks))):
        depth = F.when(missing(F.col(f"`{ranks[i]}`")), F.lit(i)).otherwise(depth)
    cut = {
        r: F.when(F.col("_depth") > i, F.col(f"`{r}`")).otherwise(filler)
        for i, r in enumerate(ranks)
    }
    return df.withColumn("_depth", depth).withColumns(cut).drop("_depth")


def identity_cascade(
    pident: Column, thresholds: Mapping[str, float] = CLASS_THRESHOLDS
) -> dict[str, Column]:
    """Ranks of a hit, null from the first rank whose identity threshold is not reached.

    A null identity nulls nothing; kingdom and phylum always pass.
    """
    out = {rank: F.col(f"`{rank}`") for rank in RANKS}
    needed = 0.0
    for rank in RANKS[2:]:
        if rank in thresholds:
            needed = max(needed, float(thresholds[rank]))
            low = F.coalesce(pident < F.lit(needed), F.lit(False))
            out[rank] = F.when(~low, F.col(f"`{rank}`"))
    return out


def rank_label(species: Column, genus: Column, family: Column) -> Column:
    """``species``, ``genus``, ``family`` or ``higher``; a ``/`` species is not a species."""
    return (
        F.when(species.isNotNull() & ~species.contains("/"), F.lit("species"))
        .when(genus.isNotNull(), F.lit("genus"))
        .when(family.isNotNull(), F.lit("family"))
        .otherwise(F.lit("higher"))
    )


def taxon_label(col: Callable[[str], Column] = F.col) -> Column:
    """Taxon name at the rank :func:`rank_label` gives: a true species, else the finest rank above."""
    species = col("species")
    return F.when(species.isNotNull() & ~species.contains("/"), species).otherwise(
        F.coalesce(*[col(r) for r in reversed(RANKS[:-1])])
    )


def finest_taxon(label: str = UNASSIGNED) -> Column:
    """The finest assigned rank of a row, else ``label``."""
    return F.coalesce(
        *[F.when(is_assigned(F.col(f"`{r}`")), F.col(f"`{r}`")) for r in reversed(RANKS)],
        F.lit(label),
    )
