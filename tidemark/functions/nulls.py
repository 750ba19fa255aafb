"""The five vocabularies of "missing", one function each."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import strip

UNASSIGNED = "Unassigned"

# Taxon sentinels, compared after strip and lower case.
TAXON_SENTINELS = ("", "na", "nan", "none", "unassigned")

# Metadata tokens that mean "no value", compared after strip and lower case.
METADATA_TOKENS = (
    "",
    "na",
    "n/a",
    "nan",
    "none",
    "null",
    "#n/a",
    "not applicable",
    "not applicable: control sample",
    "not applicable: sample group",
    "not collected",
    "not collected: not available",
    "not provided",
    "missing",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing_taxon(c: Column | str) -> Column:
    """True for null and for every taxon sentinel."""
    return F.lower(strip(F.coalesce(_col(c), F.lit("")))).isin(*TAXON_SENTINELS)


def is_assigned(c: Column | str) -> Column:
    return ~is_missing_taxon(c)


def taxon_or_label(c: Column | str, label: str = UNASSIGNED) -> Column:
    """The taxon, or ``label`` where it is missing."""
    return F.when(is_missing_taxon(c), F.lit(label)).otherwise(_col(c))


def taxon_or_null(c: Column | str) -> Column:
    return F.when(is_assigned(c), _col(c))


def label_to_null(c: Column | str, label: str = UNASSIGNED) -> Column:
    """The written label back to null, exact case only."""
    return F.when(_col(c) != F.lit(label), _col(c))


def reference_rank(c: Column | str) -> Column:
    """A rank of a reference header, null where it holds a sentinel."""
    return taxon_or_null(c)


def metadata_cell(c: Column | str) -> Column:
    """Stripped metadata cell, null where it holds a missing-value token."""
    stripped = strip(_col(c).cast("string"))
    return F.when(~F.lower(stripped).isin(*METADATA_TOKENS), stripped)
