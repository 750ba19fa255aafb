"""Queries: numbers of the run report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.ranks import RANKS
from tidemark.functions.text import line_level
from tidemark.operators import summary as sm
from tidemark.plans.cleaning import counts
from tidemark.plans.occurrence import _more
from tidemark.plans.registry import query
from tidemark.plans.taxonomy import LINKED, linked, q
from tidemark.plans.tracking import TRACKING, tracking
from tidemark.plans.views import VIEWS, ctes, view

NAMED = ctes("samples", "counts") + """,
named AS (SELECT c.asv_id, s.eventID, c.reads, s.eventID LIKE 'Blank-%' AS ctrl FROM counts c JOIN samples s
  USING (sample_no))"""
TAXED = LINKED + ",\n" + NAMED[len("WITH ") :].replace("samples AS", "samples AS", 1)

# Chimera status per feature, from part.
VIEWS["calls"] = """SELECT concat('OTU_', CAST(p_partkey + 1 AS STRING)) AS asv_id, CASE WHEN p_partkey % 9 = 0
  THEN 'Y' WHEN p_partkey % 14 = 1 THEN '?' WHEN p_partkey % 22 = 3 THEN NULL ELSE 'N' END AS chimera,
  32 + p_size AS length FROM {part}"""


def calls(spark, sf):
    return view(spark, sf, "calls").withColumn("chimera", F.coalesce("chimera", F.lit("NA")))


@query(
    "p11_chimera_filter",
    ctes("calls") + " SELECT asv_id, coalesce(chimera, 'NA') AS chimera FROM calls WHERE coalesce(chimera, 'NA') <> 'Y'",
)
def _(spark, sf):
    from tidemark.operators.features import without_chimeras

    return without_chimeras(view(spark, sf, "calls")).select("asv_id", "chimera")


@query(
    "a17_feature_metrics",
    NAMED
    + """ SELECT (SELECT count(DISTINCT asv_id) FROM named) AS n_features, (SELECT CAST(sum(reads) AS BIGINT) FROM
    named) AS total_abundance, (SELECT median(t) FROM (SELECT sum(reads) AS t FROM named GROUP BY asv_id)) AS
    median_abundance, (SELECT count(DISTINCT eventID) FROM named) AS n_samples, (SELECT min(length) FROM c2) AS
    min_length, (SELECT max(length) FROM c2) AS max_length, (SELECT avg(length) FROM c2) AS mean_length FROM
    (SELECT 1)""".replace("c2", "(SELECT length(concat(p_name, p_brand)) AS length FROM part) z"),
)
def _(spark, sf):
    seqs = spark.read.parquet(f"{sf}/part.parquet").select(F.concat("p_name", "p_brand").alias("sequence"))
    return sm.feature_metrics(counts(spark, sf), seqs)


@query(
    "a18_richness",
    NAMED + " SELECT eventID, count(CASE WHEN reads > 0 THEN 1 END) AS richness FROM named GROUP BY eventID",
)
def _(spark, sf):
    return sm.richness(counts(spark, sf))


@query(
    "a19_assigned_per_rank",
    LINKED
    + " UNION ALL ".join(
        f""" SELECT '{r}' AS rank, count(CASE WHEN {q(r)} <> 'Unassigned' THEN 1 END) AS n_assigned,
        round(count(CASE WHEN {q(r)} <> 'Unassigned' THEN 1 END) / count(*) * 100, 6) AS pct FROM linked"""
        for r in RANKS
    ),
)
def _(spark, sf):
    return sm.assigned_per_rank(linked(spark, sf)).withColumn("pct", F.round("pct", 6))


@query(
    "a20_top_species",
    TAXED
    + """ SELECT species, CAST(sum(r) AS BIGINT) AS reads, count(CASE WHEN r > 0 THEN 1 END) AS n_samples FROM (SELECT
    species, eventID, sum(reads) AS r FROM named JOIN linked USING (asv_id) WHERE NOT ctrl AND species <>
    'Unassigned' GROUP BY ALL) GROUP BY species ORDER BY reads DESC, species LIMIT 20""",
)
def _(spark, sf):
    return sm.top_species(counts(spark, sf), linked(spark, sf))


@query(
    "a21_top_genera",
    LINKED
    + """ SELECT genus, count(*) AS n_features FROM linked WHERE genus <> 'Unassigned' GROUP BY genus ORDER BY
    n_features DESC, genus LIMIT 15""",
)
def _(spark, sf):
    return sm.top_genera(linked(spark, sf))


@query(
    "a22_chimera_classes",
    ctes("calls") + " SELECT coalesce(chimera, 'NA') AS chimera, count(*) AS n_otus FROM calls GROUP BY 1",
)
def _(spark, sf):
    return sm.chimera_classes(calls(spark, sf))


def _hist_sql(cte: str, table: str, col: str, bins: int) -> str:
    return cte + f""", e AS (SELECT min({col})::DOUBLE AS lo, max({col})::DOUBLE AS hi, median({col})::DOUBLE AS mid FROM
    {table}) SELECT CAST(least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins} - 1) AS INT) AS bin, count(*) AS n,
    round(any_value(lo) + any_value((hi - lo) / {bins}) * least(floor(({col} - lo) / ((hi - lo) / {bins})),
    {bins} - 1), 6) AS lo, any_value(mid) AS median FROM {table}, e WHERE {col} IS NOT NULL GROUP BY 1,
    least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins} - 1)"""


@query("a23_length_distribution", _hist_sql(ctes("calls"), "calls", "length", 30))
def _(spark, sf):
    return sm.distribution(calls(spark, sf), "length", 30).withColumn("lo", F.round("lo", 6))


@query("a23_identity_distribution", _hist_sql(LINKED, "linked", "pident", 20))
def _(spark, sf):
    return sm.distribution(linked(spark, sf), "pident", 20).withColumn("lo", F.round("lo", 6))


_TOPCTRL = TAXED + """,
topc AS (SELECT asv_id, CAST(coalesce(sum(CASE WHEN ctrl THEN reads END), 0) AS BIGINT) AS control_reads,
  CAST(coalesce(sum(CASE WHEN NOT ctrl THEN reads END), 0) AS BIGINT) AS sample_reads FROM named GROUP BY asv_id
  HAVING control_reads > 0 ORDER BY control_reads DESC, asv_id LIMIT 15)"""


@query(
    "a24_control_features",
    _TOPCTRL
    + """ SELECT asv_id, control_reads, sample_reads, coalesce(nullif(species, 'Unassigned'), nullif(genus,
    'Unassigned'), nullif(family, 'Unassigned'), nullif("order", 'Unassigned'), nullif("class", 'Unassigned'),
    nullif(phylum, 'Unassigned'), nullif(kingdom, 'Unassigned'), 'Unassigned') AS taxon FROM topc JOIN linked
    USING (asv_id)""",
)
def _(spark, sf):
    return sm.control_features(counts(spark, sf), linked(spark, sf))


@query(
    "a24_reads_per_control",
    _TOPCTRL + " SELECT asv_id, eventID, reads FROM named JOIN topc USING (asv_id) WHERE ctrl AND reads > 0",
)
def _(spark, sf):
    c = counts(spark, sf)
    return sm.control_reads(c, sm.control_features(c, linked(spark, sf)))


@query(
    "a25_run_totals",
    LINKED
    + ",\n"
    + TRACKING[len("WITH ") :]
    + _more("calls")
    + """ SELECT count(*) AS n_samples, count(CASE WHEN sample LIKE 'Blank-%' THEN 1 END) AS n_controls,
    CAST(sum(raw) AS BIGINT) AS raw_reads, CAST(sum(nonchim) AS BIGINT) AS final_reads, round(avg(pct_retained), 6)
    AS mean_retention, round(sum(nonchim) / sum(raw) * 100, 6) AS retained_pct, (SELECT count(*) FROM linked) AS
    n_features, (SELECT round(count(CASE WHEN species <> 'Unassigned' THEN 1 END) / count(*) * 100, 6) FROM linked)
    AS species_pct, (SELECT round(count(CASE WHEN genus <> 'Unassigned' THEN 1 END) / count(*) * 100, 6) FROM
    linked) AS genus_pct, (SELECT round(count(CASE WHEN phylum <> 'Unassigned' THEN 1 END) / count(*) * 100, 6)
    FROM linked) AS phylum_pct, (SELECT median(pident) FROM linked) AS median_identity, (SELECT count(*) FROM calls
    WHERE chimera = 'Y') AS chimeras_removed FROM tracking""",
)
def _(spark, sf):
    df = sm.run_totals(tracking(spark, sf), linked(spark, sf), "nonchim", calls(spark, sf))
    pcts = ("mean_retention", "retained_pct", "species_pct", "genus_pct", "phylum_pct")
    return df.withColumns({c: F.round(c, 6) for c in pcts})


# Field sheet with blank and NA cells, from supplier.
VIEWS["field_sheet"] = f"""
SELECT eventID, CAST(decimalLatitude AS STRING) AS decimalLatitude,
  CASE WHEN sample_no % 8 = 3 THEN 'NA' ELSE CAST(decimalLatitude * 2 AS STRING) END AS decimalLongitude,
  CASE sample_no % 12 WHEN 2 THEN 'NA' WHEN 3 THEN '' ELSE concat('2025-0', CAST(1 + sample_no % 9 AS STRING), '-1',
    CAST(sample_no % 10 AS STRING)) END AS eventDate,
  CASE WHEN sample_no % 5 = 0 THEN 'deep' ELSE CAST(sample_no % 7 AS STRING) END AS depth,
  CASE WHEN sample_no % 6 = 5 THEN 'nan' ELSE concat('site', CAST(sample_no % 11 AS STRING)) END AS site_names
FROM ({VIEWS['samples']}) s"""


@query(
    "a26_dataset_facts",
    ctes("field_sheet")
    + """, b AS (SELECT *, try_cast(decimalLatitude AS DOUBLE) AS lat, try_cast(decimalLongitude AS DOUBLE) AS lon,
    try_cast(depth AS DOUBLE) AS dep, CASE WHEN eventDate NOT IN ('', 'NA', 'nan') THEN eventDate END AS d FROM
    field_sheet WHERE eventID NOT LIKE 'Blank-%') SELECT round(avg(lat), 6) AS lat_mean, round(avg(lon), 6) AS lon_mean,
    min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max, count(DISTINCT CASE WHEN lat IS
    NOT NULL AND lon IS NOT NULL THEN concat(round(lat, 4), '/', round(lon, 4)) END) AS n_sites, min(d) AS first_date,
    max(d) AS last_date, min(dep) AS depth_min, max(dep) AS depth_max FROM b""",
)
def _(spark, sf):
    df = sm.dataset_facts(view(spark, sf, "field_sheet"))
    return df.withColumns({c: F.round(c, 6) for c in ("lat_mean", "lon_mean")})


@query(
    "a26_site_names",
    ctes("field_sheet")
    + """, v AS (SELECT DISTINCT site_names AS value FROM field_sheet WHERE site_names NOT IN ('', 'NA', 'nan'))
    SELECT value, (SELECT count(*) FROM v) AS n_values FROM v ORDER BY value LIMIT 6""",
)
def _(spark, sf):
    return sm.value_list(view(spark, sf, "field_sheet"), "site_names", 6)


# Run-log lines, from conversations: one log per 40 conversations, numbered from 0.
VIEWS["log_lines"] = """
SELECT CAST(floor(conv_id / 40) AS BIGINT) AS log_no,
  row_number() OVER (PARTITION BY CAST(floor(conv_id / 40) AS BIGINT) ORDER BY conv_id, turn) - 1 AS line_no,
  CASE (conv_id * 7 + turn) % 8 WHEN 0 THEN concat('2025-01-01 | WARNING | step:', CAST(turn AS STRING), ' | ', role)
    WHEN 1 THEN concat('2025-01-01 | info | step:1 | ', role) WHEN 2 THEN concat('[FAIL] ', role)
    WHEN 3 THEN concat('[warn] ', role) WHEN 4 THEN concat('Traceback of ', role)
    WHEN 5 THEN concat('2025-01-01 | note | a | b | exception ', role)
    ELSE concat('plain line ', role) END AS text
FROM {conversations}"""

_LEVEL = """CASE WHEN upper(trim(string_split(text, ' | ')[2])) IN ('DEBUG', 'INFO', 'WARNING', 'ERROR', 'CRITICAL')
  THEN upper(trim(string_split(text, ' | ')[2])) WHEN regexp_matches(upper(text),
  '\\[ERROR\\]|\\[FAIL\\]|TRACEBACK|EXCEPTION') THEN 'ERROR' WHEN regexp_matches(upper(text), '\\[WARN\\]|WARNING')
  THEN 'WARNING' END"""


@query("v9_line_level", ctes("log_lines") + f" SELECT log_no, line_no, {_LEVEL} AS level FROM log_lines")
def _(spark, sf):
    return view(spark, sf, "log_lines").select("log_no", "line_no", line_level("text").alias("level"))


@query(
    "w9_log_excerpt",
    ctes("log_lines")
    + f""", l AS (SELECT *, {_LEVEL} AS level, count(*) OVER (PARTITION BY log_no) AS n FROM log_lines),
    e AS (SELECT *, CASE WHEN level IN ('WARNING', 'ERROR', 'CRITICAL') THEN row_number() OVER (PARTITION BY log_no,
    coalesce(level, '') IN ('WARNING', 'ERROR', 'CRITICAL') ORDER BY line_no) END AS k FROM l),
    kept AS (SELECT * FROM e WHERE n <= 40 OR line_no < 10 OR line_no >= n - 10 OR k <= 20)
    SELECT log_no, line_no, level, text, coalesce(line_no - lag(line_no) OVER (PARTITION BY log_no ORDER BY line_no)
    - 1, 0) AS n_omitted_before FROM kept""",
)
def _(spark, sf):
    return sm.excerpt_log(view(spark, sf, "log_lines"), "log_no", budget=40, edge=10)
