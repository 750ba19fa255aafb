"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, jaccard_join, language, line_dedup, packing
from tidemark.llm.common import bound_batches, free_names, stored, table
from tidemark.llm.queries import BYTE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; the classifier learns from their own labelled rows.

    Only ``und`` goes: the score falls as languages are added, so no fixed score tells junk apart.
    Without a usable label nothing can be recognised, and no document stays.
    """
    bound_batches(spark)
    lang, score = free_names(docs, "found_lang", "found_score")
    found = language.predict(docs, language.fit(docs), out=(lang, score))
    return found.where(F.col(lang) != language.UNKNOWN).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document with a smaller id holds."""
    bound_batches(spark)
    return line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Documents without words and rows without doc_id are in no group and stay.
    """
    bound_batches(spark)
    return jaccard_join.drop_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of `benchmark`."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences of 2048 tokens."""
    bound_batches(spark)
    return packing.pack(packing.cut_pieces(docs, BYTE_BPE, "leading", end_id=0))


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can neither train the classifier nor tokenize; the tests have a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
