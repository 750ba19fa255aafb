"""Queries: controls, decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.controls import (
    classify_control,
    is_control,
    is_extraction_negative,
    is_negative_control,
)
from tidemark.operators import cleaning as cl
from tidemark.plans.registry import query
from tidemark.plans.views import VIEWS, ctes, view

# Names with every control spelling, from customer.
VIEWS["names"] = """
SELECT c_custkey AS name_no, CASE c_custkey % 18
  WHEN 0 THEN concat('Blank-ext-', CAST(c_custkey AS STRING))
  WHEN 1 THEN concat(' blank_PCR ', CAST(c_custkey AS STRING))
  WHEN 2 THEN 'PCR_NC' WHEN 3 THEN concat('EXT-NC ', CAST(c_custkey AS STRING))
  WHEN 4 THEN concat('CPCR', CAST(c_custkey AS STRING))
  WHEN 5 THEN concat('cneg01_', CAST(c_custkey AS STRING)) WHEN 6 THEN 'CEXT-2' WHEN 7 THEN 'CMET3'
  WHEN 8 THEN concat('MOCK', CAST(c_custkey AS STRING)) WHEN 9 THEN 'pos_c1' WHEN 10 THEN 'Water'
  WHEN 11 THEN 'water_001' WHEN 12 THEN 'blank7' WHEN 13 THEN concat('site-ctrl-', CAST(c_custkey AS STRING))
  WHEN 14 THEN 'PCR_NCx' WHEN 15 THEN NULL WHEN 16 THEN 'lake water'
  ELSE concat('DAR-2025-', CAST(c_custkey AS STRING)) END AS name
FROM {customer}"""

CLASSIFY = """ctl AS (SELECT *, CASE
  WHEN regexp_matches(nm, '^blank[\\s_-]*ext', 'i') THEN 'blank-ext'
  WHEN regexp_matches(nm, '^blank[\\s_-]*pcr', 'i') THEN 'blank-pcr'
  WHEN regexp_matches(nm, '^pcr[\\s_-]*nc\\b', 'i') THEN 'pcr-nc'
  WHEN regexp_matches(nm, '^ext[\\s_-]*nc\\b', 'i') THEN 'ext-nc'
  WHEN regexp_matches(nm, '^cpcr', 'i') THEN 'cpcr' WHEN regexp_matches(nm, '^cneg', 'i') THEN 'cneg'
  WHEN regexp_matches(nm, '^cext', 'i') THEN 'cext' WHEN regexp_matches(nm, '^cmet', 'i') THEN 'cmet'
  WHEN regexp_matches(nm, '^(cpos|pos[\\s_-]*c|mock)', 'i') THEN 'positive'
  WHEN regexp_matches(nm, '^water\\b', 'i') THEN 'water' WHEN regexp_matches(nm, '^blank', 'i') THEN 'blank-bare'
  WHEN regexp_matches(nm, '(blank|neg|ctrl|control|\\bnc\\b|_nc|nc_|water)', 'i')
    THEN 'unclassified-control-like'
  ELSE 'sample' END AS rule FROM (SELECT *, trim(coalesce(name, '')) AS nm FROM names)),
typed AS (SELECT *, CASE WHEN rule = 'positive' THEN 'positive control'
  WHEN rule IN ('sample', 'unclassified-control-like') THEN 'sample' ELSE 'negative control' END
  AS samp_category, CASE rule WHEN 'blank-ext' THEN 'extraction negative' WHEN 'ext-nc' THEN
  'extraction negative' WHEN 'cext' THEN 'extraction negative' WHEN 'blank-pcr' THEN 'PCR negative'
  WHEN 'pcr-nc' THEN 'PCR negative' WHEN 'cpcr' THEN 'PCR negative' WHEN 'cneg' THEN 'PCR negative'
  WHEN 'cmet' THEN 'process negative' WHEN 'water' THEN 'other: water control' WHEN 'blank-bare' THEN
  'other: unspecified blank' END AS neg_cont_type, CASE WHEN rule = 'positive' THEN
  'other: positive/mock control' END AS pos_cont_type FROM ctl)"""


@query(
    "p1_classify_control",
    ctes("names")
    + ",\n"
    + CLASSIFY
    + """ SELECT name_no, name, rule, samp_category, neg_cont_type, pos_cont_type, rule IN
    ('cmet', 'positive', 'water', 'blank-bare', 'unclassified-control-like') AS needs_check
    FROM typed""",
)
def _(spark, sf):
    df = view(spark, sf, "names").withColumn("c", classify_control("name"))
    return df.select(
        "name_no",
        "name",
        "c.rule",
        "c.samp_category",
        "c.neg_cont_type",
        "c.pos_cont_type",
        F.col("c.warn_reason").isNotNull().alias("needs_check"),
    )


@query(
    "p2_negative_control",
    ctes("names") + ",\n" + CLASSIFY
    + " SELECT name_no, neg_cont_type IS NOT NULL AS negative, samp_category <> 'sample' AS control FROM typed",
)
def _(spark, sf):
    return view(spark, sf, "names").select(
        "name_no", is_negative_control("name").alias("negative"), is_control("name").alias("control")
    )


@query(
    "p3_extraction_negative",
    ctes("names") + ",\n" + CLASSIFY
    + """ SELECT name_no, coalesce(contains(lower(neg_cont_type), 'extraction'), FALSE) AS extraction
    FROM typed""",
)
def _(spark, sf):
    neg = classify_control("name")["neg_cont_type"]
    return view(spark, sf, "names").select("name_no", is_extraction_negative(neg).alias("extraction"))


def counts(spark, sf):
    ids = view(spark, sf, "samples").select("sample_no", "eventID")
    return view(spark, sf, "counts").join(ids, "sample_no").select("asv_id", "eventID", "reads")


def manifest(spark, sf):
    """Manifest of the samples; a few samples are missing from it."""
    c = classify_control("eventID")
    return view(spark, sf, "samples").where("sample_no % 50 <> 21 AND sample_no % 50 <> 13").select(
        "eventID",
        c["samp_category"].alias("samp_category"),
        c["neg_cont_type"].alias("neg_cont_type"),
        "extraction_ID",
    )


ROLES = ctes("samples", "counts") + """,
named AS (SELECT c.asv_id, s.eventID, c.reads FROM counts c JOIN samples s USING (sample_no)),
roles AS (SELECT eventID, eventID LIKE 'Blank-%' AS is_control,
  CASE WHEN eventID LIKE 'Blank-PCR%' THEN 'PCR negative' WHEN eventID LIKE 'Blank-ext%' THEN
  'extraction negative' END AS neg_cont_type,
  CASE WHEN sample_no % 50 IN (21, 13) THEN NULL ELSE extraction_ID END AS extraction_ID,
  CASE WHEN eventID LIKE 'Blank-ext%' AND sample_no % 50 NOT IN (21, 13) THEN extraction_ID END AS batch,
  CASE WHEN sample_no % 50 NOT IN (21, 13) THEN CASE WHEN eventID LIKE 'CPOS%' THEN
  'control that does not clean' END WHEN eventID LIKE 'Blank-%' THEN 'control by name, not in manifest'
  WHEN eventID LIKE 'CPOS%' THEN 'positive control by name, does not clean'
  ELSE 'not in manifest, taken as a sample' END AS note FROM samples
  WHERE sample_no IN (SELECT sample_no FROM counts)),
pres AS (SELECT DISTINCT asv_id, batch FROM named JOIN roles USING (eventID)
  WHERE is_control AND reads > 0),
pairs AS (SELECT n.asv_id, n.eventID, n.reads, (n.reads > 0 AND (n.asv_id IN (SELECT asv_id FROM
  pres WHERE batch IS NULL) OR EXISTS (SELECT 1 FROM pres p WHERE p.asv_id = n.asv_id AND
  p.batch = r.extraction_ID))) AS removed FROM named n JOIN roles r USING (eventID)
  WHERE NOT r.is_control),
whole AS (SELECT string_agg(eventID, '|' ORDER BY eventID) AS w, count(*) AS nw FROM roles WHERE
  is_control AND batch IS NULL),
per_batch AS (SELECT batch, string_agg(eventID, '|' ORDER BY eventID) AS b, count(*) AS nb FROM roles
  WHERE is_control AND batch IS NOT NULL GROUP BY batch),
applic AS (SELECT r.eventID, CAST(nw + coalesce(nb, 0) AS BIGINT) AS n_controls,
  concat_ws('|', w, b) AS driving_controls FROM roles r CROSS JOIN whole
  LEFT JOIN per_batch p ON p.batch = r.extraction_ID WHERE NOT is_control)"""


@query("a7_sample_roles", ROLES + " SELECT * FROM roles")
def _(spark, sf):
    return cl.sample_roles(counts(spark, sf), manifest(spark, sf))


@query("j10_applicable_controls", ROLES + " SELECT * FROM applic")
def _(spark, sf):
    return cl.applicable_controls(cl.sample_roles(counts(spark, sf), manifest(spark, sf)))


@query("j11_control_positive_pairs", ROLES + " SELECT asv_id, eventID, reads FROM pairs WHERE removed")
def _(spark, sf):
    c = counts(spark, sf)
    pairs = cl.removed_pairs(c, cl.sample_roles(c, manifest(spark, sf)))
    return pairs.where("removed").select("asv_id", "eventID", "reads")


def _clean_sql(mode: str) -> str:
    value = "CASE WHEN removed THEN 0 ELSE reads END" if mode == "subtract" else "reads"
    return ROLES + f""" SELECT asv_id, eventID, CAST(reads AS BIGINT) AS reads,
    asv_id IN (SELECT asv_id FROM pres) AS in_negative_control FROM (
    SELECT asv_id, eventID, {value} AS reads FROM pairs UNION ALL
    SELECT asv_id, eventID, reads FROM named JOIN roles USING (eventID) WHERE is_control)"""


@query("a7_clean_subtract", _clean_sql("subtract"))
def _(spark, sf):
    return cl.clean_counts(counts(spark, sf), manifest(spark, sf), "subtract")


@query("a7_clean_flag", _clean_sql("flag"))
def _(spark, sf):
    return cl.clean_counts(counts(spark, sf), manifest(spark, sf), "flag")


def _report_sql(mode: str) -> str:
    taken = "coalesce(sum(CASE WHEN removed THEN reads END), 0)" if mode == "subtract" else "0"
    return ROLES + f""" SELECT eventID, CAST(sum(reads) AS BIGINT) AS reads_before,
    CAST(sum(reads) - {taken} AS BIGINT) AS reads_after,
    count(CASE WHEN removed THEN 1 END) AS n_otus_removed,
    CAST(coalesce(sum(CASE WHEN removed THEN reads END), 0) AS BIGINT) AS n_reads_removed,
    any_value(driving_controls) AS driving_controls FROM pairs JOIN applic USING (eventID)
    GROUP BY eventID"""


@query("a8_cleaning_report", _report_sql("subtract"))
def _(spark, sf):
    return cl.cleaning_report(counts(spark, sf), manifest(spark, sf), "subtract")


@query("a8_cleaning_report_flag", _report_sql("flag"))
def _(spark, sf):
    return cl.cleaning_report(counts(spark, sf), manifest(spark, sf), "flag")


@query(
    "a9_cleaning_summary",
    ROLES
    + """ SELECT 'subtract' AS mode, (SELECT count(*) FROM roles WHERE is_control) AS n_controls,
    (SELECT count(*) FROM roles WHERE NOT is_control) AS n_samples,
    (SELECT count(DISTINCT asv_id) FROM pres) AS n_otus_flagged,
    CAST((SELECT coalesce(sum(reads), 0) FROM pairs WHERE removed) AS BIGINT) AS total_reads_removed""",
)
def _(spark, sf):
    return cl.cleaning_summary(counts(spark, sf), manifest(spark, sf), "subtract")


@query(
    "j16_blank_batches_without_samples",
    ROLES
    + """ SELECT batch, eventID FROM roles WHERE is_control AND batch IS NOT NULL AND batch NOT IN
    (SELECT extraction_ID FROM roles WHERE NOT is_control AND extraction_ID IS NOT NULL
     AND extraction_ID <> 'EXP1')""",
)
def _(spark, sf):
    roles = cl.sample_roles(counts(spark, sf), manifest(spark, sf))
    unsampled = F.when(F.col("is_control") | (F.col("extraction_ID") != "EXP1"), F.col("extraction_ID"))
    return cl.unmatched_blank_batches(roles.withColumn("extraction_ID", unsampled))
