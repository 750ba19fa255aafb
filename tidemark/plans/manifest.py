"""Queries: manifest validation and migration, tags, libraries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.controls import classify_control
from tidemark.functions.nulls import METADATA_TOKENS, metadata_cell
from tidemark.operators import manifest as mf
from tidemark.operators.dates import normalise_dates
from tidemark.plans.registry import query
from tidemark.plans.views import VIEWS, ctes, view

_TOK = "(" + ", ".join(f"'{t}'" for t in METADATA_TOKENS) + ")"


def cell(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN {_TOK} THEN trim({c}) END"


# Lab cells with missing tokens, units and bad numbers, from orders.
VIEWS["cells"] = """
SELECT o_orderkey AS cell_no, CASE o_orderkey % 14 WHEN 0 THEN ' NA ' WHEN 1 THEN '17 L' WHEN 2 THEN '-56239'
  WHEN 3 THEN 'Not Applicable: control sample' WHEN 4 THEN CAST(o_custkey AS STRING) WHEN 5 THEN '46.33N'
  WHEN 6 THEN 'deep' WHEN 7 THEN '' WHEN 8 THEN '-840.5' WHEN 9 THEN 'Infinity' WHEN 10 THEN 'n/a'
  WHEN 11 THEN concat(' ', CAST(o_orderkey % 100 AS STRING), '.25 ') WHEN 12 THEN 'missing'
  END AS raw FROM {orders}"""


@query("p4_metadata_cell", ctes("cells") + f" SELECT cell_no, {cell('raw')} AS value FROM cells")
def _(spark, sf):
    return view(spark, sf, "cells").select("cell_no", metadata_cell("raw").alias("value"))


_NUM = ctes("cells") + f""", v AS (SELECT cell_no, {cell('raw')} AS v FROM cells),
n AS (SELECT *, try_cast(v AS DOUBLE) AS d, regexp_extract(v, '^(-?[0-9]+(\\.[0-9]+)?)\\s*\\S.*$', 1) AS lead FROM v),
t AS (SELECT *, CASE WHEN d IS NOT NULL THEN v WHEN lead <> '' THEN lead END AS txt FROM n),
x AS (SELECT *, try_cast(txt AS DOUBLE) AS f FROM t)
SELECT cell_no, CASE WHEN txt IS NOT NULL AND isfinite(f) AND f BETWEEN -90 AND 90 THEN txt END AS value,
CASE WHEN v IS NULL THEN NULL WHEN txt IS NULL THEN 'not a number' WHEN NOT isfinite(f) THEN 'not finite'
  WHEN f NOT BETWEEN -90 AND 90 THEN 'out of range' WHEN d IS NULL THEN 'unit stripped' END AS reason FROM x"""


@query("v6_clean_number", _NUM)
def _(spark, sf):
    df = view(spark, sf, "cells").withColumn("n", mf.clean_number("decimalLatitude", "raw"))
    return df.select("cell_no", "n.value", "n.reason")


_Y, _M, _D = ("substring(CAST(o_orderdate AS STRING), %s)" % p for p in ("1, 4", "6, 2", "9, 2"))
# One column of dates per file, each file with its own habit, from orders.
VIEWS["dates"] = f"""
SELECT o_orderkey AS row_no, concat('f', CAST(o_orderkey % 9 AS STRING)) AS file, CASE o_orderkey % 9
  WHEN 0 THEN concat({_D}, '.', {_M}, '.', {_Y}) WHEN 1 THEN concat({_M}, '/', {_D}, '/', {_Y})
  WHEN 2 THEN concat({_Y}, '.', {_M}, '.', {_D}, ' 00:00:00')
  WHEN 3 THEN CASE WHEN o_custkey % 2 = 0 THEN concat({_Y}, '.', {_M}, '.', {_D}) ELSE concat({_D}, '.', {_M}, '.', {_Y}) END
  WHEN 4 THEN concat(lpad(CAST(o_custkey % 12 + 1 AS STRING), 2, '0'), '.', {_M}, '.', {_Y})
  WHEN 5 THEN CASE WHEN o_custkey % 2 = 0 THEN concat({_M}, '.', {_D}, '.', {_Y}) ELSE concat({_D}, '.', {_M}, '.', {_Y}) END
  WHEN 6 THEN CASE o_custkey % 6 WHEN 0 THEN concat({_Y}, '-', {_M}, '-', {_D}) WHEN 1 THEN {_Y} WHEN 2 THEN
    concat({_M}, '.', {_Y}) WHEN 3 THEN concat({_Y}, '/', {_M}) WHEN 4 THEN 'NA' ELSE concat({_Y}, '-', {_M}) END
  WHEN 7 THEN CASE o_custkey % 5 WHEN 0 THEN concat({_D}, '.', {_M}, '.98') WHEN 1 THEN concat('13.', {_Y}) WHEN 2
    THEN 'spring' WHEN 3 THEN concat({_Y}, '.', {_D}) ELSE concat({_Y}, '.', {_D}, '.', {_M}) END
  ELSE NULL END AS token FROM {{orders}}"""

_DATES = ctes("dates") + f""",
tk AS (SELECT DISTINCT file, {cell('token')} AS token FROM dates),
sh AS (SELECT *, trim(regexp_replace(token, '[ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?\\s*$', '')) AS c FROM tk
  WHERE token IS NOT NULL),
sp AS (SELECT *, CASE WHEN regexp_matches(c, '^\\d{{4}}(-\\d{{2}}){{0,2}}$') THEN 'plain' WHEN regexp_matches(c,
  '^\\d{{1,4}}[./]\\d{{1,2}}[./]\\d{{1,4}}$') THEN 'three' WHEN regexp_matches(c, '^\\d{{1,4}}[./]\\d{{1,4}}$') THEN 'two'
  ELSE 'other' END AS shape, string_split_regex(c, '[./]') AS p FROM sh),
yr AS (SELECT *, CASE WHEN shape = 'three' AND length(p[1]) = 4 THEN 1 WHEN shape = 'three' AND length(p[3]) = 4 THEN 3
  WHEN shape = 'two' AND length(p[1]) = 4 THEN 1 WHEN shape = 'two' AND length(p[2]) = 4 THEN 2 END AS ya FROM sp),
ab AS (SELECT *, CASE WHEN shape = 'three' AND ya IS NOT NULL THEN CAST(CASE WHEN ya = 1 THEN p[2] ELSE p[1] END AS INT)
  END AS a, CASE WHEN shape = 'three' AND ya IS NOT NULL THEN CAST(CASE WHEN ya = 1 THEN p[3] ELSE p[2] END AS INT) END AS b
  FROM yr),
ev AS (SELECT file, coalesce(bool_or(a > 12), FALSE) AS df, coalesce(bool_or(b > 12), FALSE) AS mf,
  count(DISTINCT CASE WHEN shape = 'three' THEN ya END) AS places FROM ab GROUP BY file),
z AS (SELECT ab.*, df, mf, places, CASE WHEN df THEN a ELSE b END AS d, CASE WHEN df THEN b ELSE a END AS m,
  CASE WHEN shape = 'two' THEN CAST(CASE WHEN ya = 1 THEN p[2] ELSE p[1] END AS INT) END AS m2 FROM ab JOIN ev USING (file)),
er AS (SELECT *, CASE WHEN shape = 'other' OR (shape IN ('two', 'three') AND ya IS NULL) THEN 'unrecognised date'
  WHEN shape = 'two' AND m2 NOT BETWEEN 1 AND 12 THEN 'month out of range'
  WHEN shape = 'three' AND places > 1 THEN 'file mixes year-first and year-last dates'
  WHEN shape = 'three' AND df AND mf THEN 'contradictory day and month order'
  WHEN shape = 'three' AND NOT df AND NOT mf THEN 'ambiguous day and month order'
  WHEN shape = 'three' AND (m NOT BETWEEN 1 AND 12 OR d NOT BETWEEN 1 AND 31) THEN 'month or day out of range' END AS error
  FROM z)
SELECT file, token, error, CASE WHEN error IS NOT NULL THEN NULL WHEN shape = 'plain' THEN c WHEN shape = 'two' THEN
  concat(CASE WHEN ya = 1 THEN p[1] ELSE p[2] END, '-', lpad(CAST(m2 AS VARCHAR), 2, '0')) ELSE concat(CASE WHEN ya = 1
  THEN p[1] ELSE p[3] END, '-', lpad(CAST(m AS VARCHAR), 2, '0'), '-', lpad(CAST(d AS VARCHAR), 2, '0')) END AS iso FROM er"""


@query("v7_normalise_dates", _DATES)
def _(spark, sf):
    return normalise_dates(view(spark, sf, "dates"), "token", "file")


# Manifest rows as text with every kind of fault, from supplier.
VIEWS["manifest_text"] = f"""
SELECT CASE WHEN sample_no % 23 = 5 THEN '' ELSE eventID END AS eventID,
  CASE sample_no % 16 WHEN 3 THEN '2025-13' WHEN 4 THEN '2025-02-30' WHEN 5 THEN '2025.03.04' WHEN 6 THEN '2025'
    WHEN 7 THEN '2025-00-10' WHEN 8 THEN '2025-01-32' WHEN 9 THEN 'NA' ELSE '2025-08-19' END AS eventDate,
  CASE sample_no % 15 WHEN 2 THEN '95.5' WHEN 3 THEN 'north' ELSE CAST(decimalLatitude AS STRING) END AS decimalLatitude,
  CASE sample_no % 18 WHEN 2 THEN '-56239' ELSE CAST(decimalLatitude * 2 AS STRING) END AS decimalLongitude,
  CASE sample_no % 20 WHEN 2 THEN '-1' WHEN 3 THEN 'inf' ELSE '15.5' END AS samp_size,
  CASE WHEN sample_no % 27 = 8 THEN ' ' ELSE concat('run', CAST(sample_no % 3 AS STRING)) END AS seq_run_id,
  CASE WHEN sample_no % 10 < 2 THEN 'negative control' WHEN sample_no % 25 = 7 THEN 'positive control'
    WHEN sample_no % 29 = 3 THEN 'banana' WHEN sample_no % 31 = 4 THEN 'Other: pool' ELSE 'sample' END AS samp_category,
  CASE WHEN sample_no % 20 = 0 THEN 'PCR negative' WHEN sample_no % 20 = 1 THEN 'other: tube' WHEN sample_no % 20 = 10
    THEN 'not provided' WHEN sample_no % 20 = 11 THEN 'pcr negative' END AS neg_cont_type,
  CASE WHEN sample_no % 50 = 7 THEN 'mock' END AS pos_cont_type, extraction_ID,
  CASE sample_no % 12 WHEN 4 THEN '-5' WHEN 5 THEN 'many' ELSE '1200' END AS reads_raw
FROM ({VIEWS['samples']}) s"""

_F = {c: cell(c) for c in ("eventID", "eventDate", "decimalLatitude", "decimalLongitude", "samp_size", "seq_run_id",
      "samp_category", "neg_cont_type", "pos_cont_type", "extraction_ID", "reads_raw")}
_VALID = ctes("manifest_text") + f""",
m AS (SELECT {', '.join(f'{v} AS {k}' for k, v in _F.items())} FROM manifest_text),
k AS (SELECT *, regexp_matches(eventDate, '^\\d{{4}}(-\\d{{2}}(-\\d{{2}})?)?$') AS ds,
  try_cast(nullif(regexp_extract(eventDate, '^\\d{{4}}-(\\d{{2}})', 1), '') AS INT) AS mo,
  try_cast(nullif(regexp_extract(eventDate, '^\\d{{4}}-\\d{{2}}-(\\d{{2}})$', 1), '') AS INT) AS dy,
  try_cast(decimalLatitude AS DOUBLE) AS la, try_cast(decimalLongitude AS DOUBLE) AS lo,
  try_cast(samp_size AS DOUBLE) AS sz, try_cast(reads_raw AS BIGINT) AS rr FROM m),
valid AS (SELECT eventID, seq_run_id, samp_category, eventDate, extraction_ID, neg_cont_type, concat_ws('; ',
  CASE WHEN eventID IS NULL THEN 'eventID: required' END, CASE WHEN seq_run_id IS NULL THEN 'seq_run_id: required' END,
  CASE WHEN samp_category NOT IN ('sample', 'negative control', 'positive control', 'PCR standard') AND NOT
    starts_with(lower(samp_category), 'other:') THEN 'samp_category: not in vocabulary' END,
  CASE WHEN neg_cont_type NOT IN ('site negative', 'field negative', 'process negative', 'extraction negative',
    'PCR negative') AND NOT starts_with(lower(neg_cont_type), 'other:') THEN 'neg_cont_type: not in vocabulary' END,
  CASE WHEN samp_category = 'negative control' AND neg_cont_type IS NULL THEN
    'neg_cont_type: required for a negative control' END,
  CASE WHEN samp_category = 'positive control' AND pos_cont_type IS NULL THEN
    'pos_cont_type: required for a positive control' END,
  CASE WHEN NOT ds THEN 'eventDate: not ISO' END,
  CASE WHEN ds AND mo NOT BETWEEN 1 AND 12 THEN 'eventDate: month out of range' END,
  CASE WHEN ds AND dy NOT BETWEEN 1 AND 31 THEN 'eventDate: day out of range' END,
  CASE WHEN ds AND mo BETWEEN 1 AND 12 AND dy BETWEEN 1 AND 31 AND try_cast(eventDate AS DATE) IS NULL THEN
    'eventDate: not a calendar date' END,
  CASE WHEN decimalLatitude IS NOT NULL AND (la IS NULL OR NOT isfinite(la)) THEN 'decimalLatitude: not a finite number' END,
  CASE WHEN isfinite(la) AND la < -90 THEN 'decimalLatitude: below -90' END,
  CASE WHEN isfinite(la) AND la > 90 THEN 'decimalLatitude: above 90' END,
  CASE WHEN isfinite(lo) AND lo < -180 THEN 'decimalLongitude: below -180' END,
  CASE WHEN isfinite(lo) AND lo > 180 THEN 'decimalLongitude: above 180' END,
  CASE WHEN samp_size IS NOT NULL AND (sz IS NULL OR NOT isfinite(sz)) THEN 'samp_size: not a finite number' END,
  CASE WHEN isfinite(sz) AND sz < 0 THEN 'samp_size: below 0' END,
  CASE WHEN reads_raw IS NOT NULL AND (rr IS NULL OR rr < 0) THEN 'reads_raw: not a count' END) AS errors FROM k)"""


def validated(spark, sf):
    return mf.validate_manifest(view(spark, sf, "manifest_text"))


@query("v1_validate_manifest", _VALID + " SELECT eventID, seq_run_id, samp_category, errors FROM valid")
def _(spark, sf):
    df = validated(spark, sf)
    return df.select("eventID", "seq_run_id", "samp_category", F.array_join("errors", "; ").alias("errors"))


@query(
    "a28_duplicate_keys",
    """SELECT concat('S', c_nationkey) AS eventID, c_mktsegment AS seq_run_id, count(*) AS n_rows FROM customer
    GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("eventID"),
        F.col("c_mktsegment").alias("seq_run_id"),
    )
    return mf.duplicate_keys(df)


@query(
    "a29_completeness",
    _VALID
    + """ SELECT count(*) AS n_rows, count(CASE WHEN samp_category <> 'sample' THEN 1 END) AS n_controls,
    count(CASE WHEN samp_category = 'sample' THEN 1 END) AS n_biological, count(CASE WHEN samp_category = 'sample' AND
    eventDate IS NULL THEN 1 END) AS n_without_date FROM valid""",
)
def _(spark, sf):
    return mf.completeness(validated(spark, sf))


@query(
    "a29_run_ids",
    "SELECT c_mktsegment AS seq_run_id, min(c_custkey) AS first_seen FROM customer GROUP BY 1",
)
def _(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet")
    rows = df.select(F.col("c_mktsegment").alias("seq_run_id"), F.col("c_custkey").alias("row_no"))
    return mf.run_ids(rows)


@query(
    "j12_manifest_vs_counts",
    ctes("samples", "counts")
    + """, n AS (SELECT DISTINCT eventID FROM samples JOIN counts USING (sample_no) WHERE sample_no % 9 <> 2), m AS (SELECT
    eventID FROM samples WHERE sample_no % 7 <> 3) SELECT eventID, 'orphan sample' AS kind FROM n WHERE eventID NOT IN
    (SELECT eventID FROM m) UNION ALL SELECT eventID, 'extra manifest row' FROM m WHERE eventID NOT IN (SELECT eventID
    FROM n)""",
)
def _(spark, sf):
    samples = view(spark, sf, "samples")
    used = view(spark, sf, "counts").join(samples, "sample_no").where("sample_no % 9 <> 2")
    return mf.eventid_orphans(used.select("eventID"), samples.where("sample_no % 7 <> 3"))


@query(
    "j16_orphan_batches",
    """WITH m AS (SELECT concat('EXP', CAST(s_nationkey AS VARCHAR)) AS extraction_ID, s_suppkey % 10 = 1 AS blank,
    s_suppkey % 10 > 1 AND s_suppkey % 25 <> 7 AS smp FROM supplier), g AS (SELECT
    extraction_ID, bool_or(blank) AS b, bool_or(smp) AS s FROM m GROUP BY 1) SELECT extraction_ID, CASE WHEN b THEN
    'blank without sample' ELSE 'sample without blank' END AS kind FROM g WHERE b <> s""",
)
def _(spark, sf):
    base = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.col("s_suppkey").alias("sample_no"),
        F.concat(F.lit("EXP"), F.col("s_nationkey").cast("string")).alias("batch"),
    )
    c = classify_control("eventID")
    df = view(spark, sf, "samples").join(base, "sample_no").select(
        F.col("batch").alias("extraction_ID"),
        c["samp_category"].alias("samp_category"),
        c["neg_cont_type"].alias("neg_cont_type"),
    )
    return mf.orphan_batches(df)


# Field and lab sheets to migrate: dates of one order, units, tokens, runs from three sources.
VIEWS["field_text"] = f"""
SELECT CASE WHEN sample_no % 40 = 9 THEN 'NA' ELSE eventID END AS eventID, concat({_D}, '.', {_M}, '.', {_Y}) AS eventDate,
  CASE WHEN sample_no % 9 = 4 THEN '-999' ELSE CAST(CAST(round(decimalLatitude) AS INT) AS STRING) END AS decimalLatitude,
  CASE WHEN sample_no % 6 = 1 THEN concat(CAST(sample_no % 40 AS STRING), ' L') WHEN sample_no % 6 = 2 THEN 'n/a'
    ELSE CAST(sample_no % 40 AS STRING) END AS samp_size,
  CASE WHEN sample_no % 8 = 3 THEN 'LIBX' WHEN sample_no % 8 = 4 THEN 'not collected' END AS seq_run_id,
  CASE WHEN sample_no % 5 = 2 THEN 'AAAA' END AS mid_forward, extraction_ID
FROM ({VIEWS['samples']}) s JOIN {{orders}} ON o_orderkey = sample_no"""
VIEWS["lab_text"] = f"""
SELECT eventID, CASE WHEN sample_no % 5 = 1 THEN 'NA' ELSE concat('LIB', CAST(sample_no % 4 AS STRING)) END AS library,
  substring(translate(md5(eventID), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 8) AS tag_demltiplex,
  sample_no AS row_no FROM ({VIEWS['samples']}) s WHERE sample_no % 3 <> 1"""

_MIG = ctes("field_text", "lab_text") + f""",
f AS (SELECT {', '.join(f'{cell(c)} AS {c}' for c in ('eventID', 'eventDate', 'decimalLatitude', 'samp_size', 'seq_run_id',
  'mid_forward', 'extraction_ID'))} FROM field_text),
l AS (SELECT eventID, {cell('library')} AS lr, tag_demltiplex AS lt FROM lab_text),
j AS (SELECT f.*, l.lr, l.lt FROM f LEFT JOIN l USING (eventID) WHERE f.eventID IS NOT NULL),
migrated AS (SELECT eventID, concat(substring(eventDate, 7, 4), '-', substring(eventDate, 4, 2), '-', substring(eventDate,
  1, 2)) AS eventDate, CASE WHEN decimalLatitude <> '-999' THEN CAST(decimalLatitude AS DOUBLE) END AS decimalLatitude,
  CAST(replace(samp_size, ' L', '') AS DOUBLE) AS samp_size, coalesce(seq_run_id, lr, 'river_teleo') AS seq_run_id,
  CASE WHEN seq_run_id IS NULL AND lr IS NOT NULL THEN coalesce(mid_forward, lt) ELSE mid_forward END AS mid_forward,
  CASE WHEN seq_run_id IS NOT NULL THEN 'row' WHEN lr IS NOT NULL THEN 'lab' ELSE 'default' END AS run_source,
  CASE WHEN eventID LIKE 'Blank%' THEN 'negative control' WHEN eventID LIKE 'CPOS%' THEN 'positive control' ELSE 'sample'
  END AS samp_category, 'teleo' AS target_gene, extraction_ID FROM j)"""


def migrated(spark, sf):
    lab = mf.demux_index(view(spark, sf, "lab_text"))
    return mf.migrate(view(spark, sf, "field_text"), lab, marker="teleo", dataset="river")


_MCOLS = ("eventID", "eventDate", "decimalLatitude", "samp_size", "seq_run_id", "mid_forward", "run_source",
          "samp_category", "target_gene", "extraction_ID")


@query("a30_migrate_manifest", _MIG + f" SELECT {', '.join(_MCOLS)}, 0 AS n_errors FROM migrated")
def _(spark, sf):
    return migrated(spark, sf).select(*_MCOLS, F.size("errors").alias("n_errors"))


@query("j13_run_precedence", _MIG + " SELECT eventID, seq_run_id, mid_forward, run_source FROM migrated")
def _(spark, sf):
    cells = view(spark, sf, "field_text")
    cells = cells.select(*[metadata_cell(c).alias(c) for c in cells.columns]).where("eventID IS NOT NULL")
    lab = mf.demux_index(view(spark, sf, "lab_text"))
    df = mf.attach_runs(cells, lab, "river_teleo")
    return df.select("eventID", "seq_run_id", "mid_forward", "run_source")


@query(
    "s16_demux_sheet",
    ctes("lab_text") + f" SELECT eventID, {cell('library')} AS lab_run, tag_demltiplex AS lab_forward FROM lab_text",
)
def _(spark, sf):
    return mf.demux_index(view(spark, sf, "lab_text")).select("eventID", "lab_run", "lab_forward")


VIEWS["tags"] = f"""
SELECT eventID, CASE sample_no % 11 WHEN 3 THEN ' acgtrykm ' WHEN 4 THEN 'ACGU' WHEN 5 THEN '' WHEN 6 THEN NULL
  ELSE substring(translate(md5(eventID), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 8) END AS tag_demultiplex,
  concat('LIB', CAST(sample_no % 4 AS STRING)) AS library FROM ({VIEWS['samples']}) s"""
_RC = "lower(translate(reverse(upper(trim(tag_demultiplex))), 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN'))"


@query(
    "v8_tag_adapters",
    ctes("tags")
    + f""", t AS (SELECT *, coalesce(regexp_matches(upper(trim(tag_demultiplex)), '^[ACGTRYSWKMBDHVN]+$'), FALSE) AS ok
    FROM tags) SELECT library, eventID AS sample_name, CASE WHEN ok THEN concat(upper(trim(tag_demultiplex)),
    ';min_overlap=8...', {_RC}, ';min_overlap=8') END AS tag_formatted, CASE WHEN NOT ok THEN 'not a DNA sequence' END AS
    error FROM t""",
)
def _(spark, sf):
    return mf.tag_adapters(view(spark, sf, "tags"), "library")




@query(
    "j17_library_map",
    "SELECT DISTINCT concat('S', user_id) AS sample, concat('lib', user_id % 4) AS library FROM events",
)
def _(spark, sf):
    files = spark.read.parquet(f"{sf}/events.parquet").select(
        F.concat(
            F.lit("/raw/lib"), (F.col("user_id") % 4).cast("string"), F.lit("/run/S"), F.col("user_id").cast("string"),
            F.when(F.col("event_id") % 2 == 0, "_R1.fastq.gz").otherwise(".R2_001.fastq"),
        ).alias("path")
    )
    return mf.usable_library_map(mf.libraries_from_paths(files, "/raw"))


@query(
    "j17_samples_in_two_libraries",
    """SELECT concat('S', user_id) AS sample, count(DISTINCT event_type) AS n_libraries FROM events
    GROUP BY user_id HAVING count(DISTINCT event_type) > 1""",
)
def _(spark, sf):
    files = spark.read.parquet(f"{sf}/events.parquet").select(
        F.concat(F.lit("/raw/"), "event_type", F.lit("/S"), F.col("user_id").cast("string"), F.lit("_R1.fastq")).alias("path")
    )
    return mf.ambiguous_samples(mf.libraries_from_paths(files, "/raw"))
