"""Queries: occurrences and Darwin Core records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.nulls import label_to_null
from tidemark.functions.ranks import RANKS
from tidemark.functions.sequences import occurrence_id
from tidemark.functions.text import event_date_text, event_key
from tidemark.operators import darwincore as dw
from tidemark.operators import occurrence as oc
from tidemark.plans.cleaning import counts
from tidemark.plans.registry import query
from tidemark.plans.taxonomy import ALL_RANKS, LINKED, linked, named, q
from tidemark.plans.views import VIEWS, ctes, view

MARKER = "teleo"
PROJECT = {
    "marker": "teleo",
    "recordedby": "Field team",
    "identificationRemarks": "consensus of hits",
    "identificationReferences": "reference set 1",
    "seqmet": "paired amplicon reads",
    "otu_seq_comp_appr": "single linkage",
    "otu_db": "set A",
    "chimera_check": "de novo",
}

# Sample metadata with dashed, dotted and underscored ids; every 17th sample is missing.
VIEWS["sample_meta"] = f"""
SELECT CASE sample_no % 3 WHEN 0 THEN replace(eventID, '-', '.') WHEN 1 THEN replace(eventID, '-', '_')
  ELSE eventID END AS eventID,
  replace(substring(CAST(o_orderdate AS STRING), 1, 10), '-', '.') AS eventDate,
  CASE sample_no % 6 WHEN 0 THEN 'water' WHEN 1 THEN 'Marine' WHEN 2 THEN 'soil' WHEN 3 THEN 'river'
    WHEN 4 THEN 'SEDIMENT' END AS env_medium,
  decimalLatitude, decimalLatitude * 2 AS decimalLongitude, CAST(sample_no % 9 AS DOUBLE) AS depth,
  '0.45' AS size_frac, concat(CAST(sample_no % 30 AS STRING), ' L') AS samp_size
FROM ({VIEWS['samples']}) s JOIN {{orders}} o ON o.o_orderkey = s.sample_no WHERE sample_no % 17 <> 5"""

# Two name authorities, from nation.
VIEWS["authority1"] = """
SELECT concat('C', CAST(n_nationkey AS STRING)) AS name, concat('C', CAST(n_nationkey AS STRING)) AS class_,
  concat('PH', CAST(n_nationkey % 2 AS STRING)) AS phylum, 'Animalia' AS kingdom FROM {nation}
WHERE n_nationkey <> 2
UNION ALL SELECT concat('O', CAST(n_nationkey AS STRING)), concat('K', CAST(n_nationkey AS STRING)),
  CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE 'PHX' END, 'Animalia' FROM {nation} WHERE n_nationkey < 4"""
VIEWS["authority2"] = """
SELECT concat(pre, CAST(n_nationkey AS STRING)) AS name, concat('W', CAST(n_nationkey AS STRING)) AS class_,
  concat('WP', CAST(n_nationkey AS STRING)) AS phylum, 'Metazoa' AS kingdom
FROM {nation} CROSS JOIN (SELECT 'C' AS pre UNION ALL SELECT 'S') p"""

_N = {r: f"nullif({q(r)}, 'Unassigned')" for r in RANKS}
_RANK = f"""CASE WHEN {_N['species']} IS NOT NULL AND NOT contains({_N['species']}, '/') THEN 'species'
  WHEN {_N['genus']} IS NOT NULL THEN 'genus' WHEN {_N['family']} IS NOT NULL THEN 'family'
  ELSE 'higher' END"""
LABELLED = LINKED + f""",
lab1 AS (SELECT asv_id, sequence, is_contaminant_candidate, {', '.join(f'{_N[r]} AS {q(r)}' for r in RANKS)},
  {_RANK} AS rank FROM linked),
lab AS (SELECT asv_id, sequence, is_contaminant_candidate, kingdom, phylum, "class", "order", family, genus,
  CASE WHEN rank = 'species' OR NOT contains(species, '/') THEN species END AS species, rank,
  CASE rank WHEN 'species' THEN species WHEN 'genus' THEN genus WHEN 'family' THEN family
    ELSE coalesce("order", "class", phylum, kingdom) END AS taxon FROM lab1)"""


def _more(*names: str) -> str:
    base = ctes(*names)
    return ",\n" + base[len("WITH ") :]


OCC = LABELLED + _more("samples", "counts") + f""",
occ AS (SELECT {ALL_RANKS}, taxon, rank, sequence, reads AS nb_reads, eventID, is_contaminant_candidate
  FROM counts JOIN samples USING (sample_no) JOIN lab USING (asv_id) WHERE reads > 0)"""
CONTROL = "(eventID LIKE 'Blank-%' OR eventID LIKE 'CPOS%')"
NONTARGET = """coalesce("class" IN ('Gastropoda','Holothuroidea','Deinococci','Branchiopoda'), FALSE)
  OR coalesce("order" IN ('Primates','Galliformes'), FALSE) OR coalesce(family = 'Hominidae', FALSE)
  OR coalesce(genus IN ('Gorilla','Homo','Pan','Macaca'), FALSE)"""
KEPT = OCC + f""",
kept AS (SELECT *, CAST(sum(nb_reads) OVER (PARTITION BY eventID) AS BIGINT) AS nb_reads_total FROM occ
  WHERE NOT {CONTROL} AND NOT ({NONTARGET}))"""


def occurrences(spark, sf):
    return oc.to_occurrences(counts(spark, sf), linked(spark, sf))


@query(
    "p12_rank_label",
    LABELLED + " SELECT asv_id, rank, species FROM lab",
)
def _(spark, sf):
    df = linked(spark, sf).withColumns({r: label_to_null(f"`{r}`") for r in RANKS})
    return oc.label_taxa(df).select("asv_id", "rank", "species")


@query("p13_taxon_label", LABELLED + " SELECT asv_id, rank, taxon FROM lab")
def _(spark, sf):
    df = linked(spark, sf).withColumns({r: label_to_null(f"`{r}`") for r in RANKS})
    return oc.label_taxa(df).select("asv_id", "rank", "taxon")


@query("u3_p16_occurrences", OCC + " SELECT * FROM occ")
def _(spark, sf):
    return occurrences(spark, sf)


@query("p17_non_target_filter", OCC + f" SELECT * FROM occ WHERE NOT ({NONTARGET})")
def _(spark, sf):
    return oc.drop_non_target(occurrences(spark, sf), MARKER)


@query("p18_control_removal", OCC + f" SELECT * FROM occ WHERE NOT {CONTROL}")
def _(spark, sf):
    return oc.drop_controls(occurrences(spark, sf))


@query(
    "p18_control_like_samples",
    ctes("names") + """ SELECT DISTINCT name AS eventID FROM names WHERE name LIKE 'site-ctrl-%'
    OR name = 'PCR_NCx' OR name = 'water_001' OR name = 'lake water'""",
)
def _(spark, sf):
    return oc.control_like_samples(view(spark, sf, "names").withColumnRenamed("name", "eventID"))


@query(
    "a11_dropped_report",
    OCC
    + f""" SELECT eventID, {ALL_RANKS}, taxon, nb_reads, CASE WHEN {CONTROL} THEN
    'negative/positive control' ELSE 'non-target taxon (teleo)' END AS drop_reason FROM occ
    WHERE {CONTROL} OR ({NONTARGET})""",
)
def _(spark, sf):
    return oc.dropped_report(occurrences(spark, sf), MARKER)


@query("w6_total_reads_per_event", KEPT + " SELECT eventID, sequence, nb_reads, nb_reads_total FROM kept")
def _(spark, sf):
    df = oc.drop_non_target(oc.drop_controls(occurrences(spark, sf)), MARKER)
    return oc.add_sample_totals(df).select("eventID", "sequence", "nb_reads", "nb_reads_total")


VIEWS["replicates"] = f"""
SELECT asv_id, concat(eventID, CASE WHEN sample_no % 4 = 1 THEN '_01' WHEN sample_no % 4 = 2 THEN '_1' ELSE '' END)
  AS eventID, reads FROM ({VIEWS['counts']}) c JOIN ({VIEWS['samples']}) s USING (sample_no)
UNION ALL
SELECT asv_id, concat(eventID, '_02') AS eventID, reads * 2 AS reads FROM ({VIEWS['counts']}) c
JOIN ({VIEWS['samples']}) s USING (sample_no) WHERE sample_no % 4 <> 3"""


@query(
    "a10_collapse_replicates",
    LABELLED
    + _more("replicates")
    + f""" SELECT {ALL_RANKS}, taxon, rank, sequence, is_contaminant_candidate,
    regexp_replace(eventID, '_[0-9][0-9]$', '') AS eventID, CAST(sum(reads) AS BIGINT) AS nb_reads
    FROM replicates JOIN lab USING (asv_id) GROUP BY ALL""",
)
def _(spark, sf):
    occ = oc.to_occurrences(view(spark, sf, "replicates"), linked(spark, sf))
    return oc.collapse_replicates(occ)


@query(
    "a32_export_statistics",
    OCC + " SELECT count(*) AS n_records, count(DISTINCT eventID) AS n_event_ids FROM occ",
)
def _(spark, sf):
    return oc.export_statistics(occurrences(spark, sf))


@query("a32_rank_distribution", OCC + " SELECT rank, count(*) AS n_records FROM occ GROUP BY rank")
def _(spark, sf):
    return oc.rank_distribution(occurrences(spark, sf))


_KEY = "upper(regexp_replace(regexp_replace(trim({c}), '[._-]+', '-', 'g'), '^-+|-+$', '', 'g'))"


@query(
    "p22_event_key",
    ctes("names") + f" SELECT name_no, coalesce({_KEY.format(c='name')}, '') AS event_key FROM names",
)
def _(spark, sf):
    return view(spark, sf, "names").select("name_no", event_key("name").alias("event_key"))


@query(
    "p21_event_date",
    """SELECT o_orderkey, coalesce(strftime(try_cast(CASE o_orderkey % 4 WHEN 0 THEN
    CAST(o_orderdate AS VARCHAR) WHEN 1 THEN substring(CAST(o_orderdate AS VARCHAR), 1, 10) WHEN 2
    THEN 'not a date' END AS TIMESTAMP), '%Y.%m.%d'), '') AS eventDate FROM orders""",
)
def _(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    text = F.col("o_orderdate").cast("string")
    value = (
        F.when(F.col("o_orderkey") % 4 == 0, text)
        .when(F.col("o_orderkey") % 4 == 1, F.substring(text, 1, 10))
        .when(F.col("o_orderkey") % 4 == 2, F.lit("not a date"))
    )
    return df.select("o_orderkey", event_date_text(value).alias("eventDate"))


@query(
    "p23_occurrence_id",
    ctes("counts", "samples", "features")
    + """ SELECT concat('teleo:', eventID, ':', CASE WHEN otu % 50 = 0 THEN 'NOSEQ' ELSE
    substring(sha256(upper(sequence)), 1, 8) END) AS occurrenceID, reads FROM counts
    JOIN samples USING (sample_no) JOIN features USING (asv_id)""",
)
def _(spark, sf):
    features = view(spark, sf, "features").select(
        "asv_id", F.when(F.col("otu") % 50 != 0, F.lower("sequence")).alias("sequence")
    )
    df = counts(spark, sf).join(features, "asv_id")
    return df.select(occurrence_id("teleo", "eventID", "sequence").alias("occurrenceID"), "reads")


_ENVO = """CASE WHEN env_medium IS NULL THEN '' ELSE CASE lower(env_medium) WHEN 'water' THEN
  'liquid water [ENVO_00002006]' WHEN 'river' THEN 'liquid water [ENVO_00002006]' WHEN 'soil' THEN
  'soil [ENVO:00001998]' WHEN 'marine' THEN 'sea water [ENVO_00002149]' WHEN 'sediment' THEN
  'sediment [ENVO_00002007]' END END"""


@query("p19_envo_term", ctes("sample_meta") + f" SELECT eventID, {_ENVO} AS env_medium FROM sample_meta")
def _(spark, sf):
    return view(spark, sf, "sample_meta").select("eventID", dw.envo_term("env_medium").alias("env_medium"))


_TYPES = ("FW", " ma", "SE", "so", "SU", "AI", "BL", "HN", "DW", "zz", "")
VIEWS["field_rows"] = f"""
SELECT concat('DAR', CAST(s_suppkey AS STRING)) AS sample_id,
  concat('MS-', CAST(s_suppkey AS STRING)) AS material_sample_id, o_orderdate AS event_date,
  CASE s_suppkey % 12 {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TYPES))} END AS sample_type_code,
  CAST(s_suppkey % 9 AS DOUBLE) AS sample_depth, 0.45 AS sample_size_frac,
  CAST(s_nationkey AS DOUBLE) AS sample_size, concat('SITE', CAST(s_nationkey % 5 AS STRING)) AS monitoring_id,
  concat('MIS', CAST(s_suppkey % 3 AS STRING)) AS mission_id
FROM {{supplier}} JOIN {{orders}} ON o_orderkey = s_suppkey"""
VIEWS["points"] = """
SELECT concat('MS-', CAST(s_suppkey AS STRING)) AS material_sample_id,
  CASE WHEN s_suppkey % 4 = 1 THEN 'START' ELSE 'COORDINATE' END AS location_type,
  s_acctbal / 200.0 AS lat, s_acctbal / 100.0 AS lon FROM {supplier}
UNION ALL SELECT concat('MS-', CAST(s_suppkey AS STRING)), 'END', 1.0, 2.0 FROM {supplier}"""

_MEDIUM = """CASE upper(trim(sample_type_code)) WHEN 'FW' THEN 'water' WHEN 'MA' THEN 'marine' WHEN 'SE'
  THEN 'sediment' WHEN 'SO' THEN 'soil' WHEN 'SU' THEN 'water' WHEN 'AI' THEN 'Air' WHEN 'BL' THEN 'Blood'
  WHEN 'HN' THEN 'Honey' WHEN 'DW' THEN 'Deadwood' ELSE coalesce(upper(trim(sample_type_code)), '') END"""


@query("p20_medium_of_sample_type", ctes("field_rows") + f" SELECT sample_id, {_MEDIUM} AS env_medium FROM field_rows")
def _(spark, sf):
    return view(spark, sf, "field_rows").select(
        "sample_id", dw.medium_of_sample_type("sample_type_code").alias("env_medium")
    )


@query(
    "j15_sample_points",
    ctes("field_rows", "points")
    + """ SELECT sample_id, material_sample_id, lat, lon FROM field_rows LEFT JOIN (SELECT * FROM points
    WHERE location_type = 'COORDINATE') USING (material_sample_id)""",
)
def _(spark, sf):
    df = dw.sample_points(view(spark, sf, "field_rows"), view(spark, sf, "points"))
    return df.select("sample_id", "material_sample_id", "lat", "lon")


_META = ctes("field_rows", "points") + f""",
s19 AS (SELECT sample_id AS eventID, strftime(event_date, '%Y.%m.%d') AS eventDate, {_MEDIUM} AS env_medium,
  lat AS decimalLatitude, lon AS decimalLongitude, sample_depth AS depth,
  CAST(sample_size_frac AS DOUBLE) AS size_frac, sample_size AS samp_size
  FROM field_rows LEFT JOIN (SELECT * FROM points WHERE location_type = 'COORDINATE') USING
  (material_sample_id) WHERE monitoring_id = 'SITE2' AND mission_id = 'MIS1')"""


@query("s19_field_sample_rows", _META + " SELECT * FROM s19")
def _(spark, sf):
    from tidemark.sources.field_database import select_samples

    rows = select_samples(
        view(spark, sf, "field_rows"), view(spark, sf, "points"), monitoring="SITE2", mission="MIS1"
    )
    df = dw.sample_metadata_from_field_rows(rows)
    return df.withColumn("size_frac", F.col("size_frac").cast("double"))


@query(
    "v2_bad_dates",
    ctes("field_meta_dates") if "field_meta_dates" in VIEWS else
    """SELECT DISTINCT substring(CAST(o_orderdate AS VARCHAR), 1, 10) AS eventDate FROM orders
    WHERE o_orderkey % 3 = 0""",
)
def _(spark, sf):
    text = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    df = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 3 == 0, text)
        .when(F.col("o_orderkey") % 3 == 1, F.replace(text, F.lit("-"), F.lit(".")))
        .alias("eventDate")
    )
    return dw.bad_dates(df)


@query(
    "v3_sample_metadata_violations",
    ctes("field_rows", "points")
    + f""", m AS (SELECT {_MEDIUM} AS env_medium, lat * 3 AS lat, lon * 4 AS lon FROM field_rows LEFT JOIN
    (SELECT * FROM points WHERE location_type = 'COORDINATE') USING (material_sample_id)),
    v AS (SELECT 'unknown env_medium' AS "check", count(*) AS n_rows FROM m WHERE lower(env_medium) NOT IN
    ('water', 'soil', 'river', 'marine', 'sediment') UNION ALL SELECT 'decimalLatitude out of range', count(*)
    FROM m WHERE abs(lat) > 90 UNION ALL SELECT 'decimalLongitude out of range', count(*) FROM m WHERE
    abs(lon) > 180) SELECT * FROM v WHERE n_rows > 0""",
)
def _(spark, sf):
    rows = dw.sample_points(view(spark, sf, "field_rows"), view(spark, sf, "points"))
    meta = dw.sample_metadata_from_field_rows(rows)
    meta = meta.withColumns(
        {"decimalLatitude": F.col("decimalLatitude") * 3, "decimalLongitude": F.col("decimalLongitude") * 4}
    )
    return dw.sample_metadata_violations(meta)


JOINED = KEPT + _more("sample_meta") + f""",
meta AS (SELECT *, {_KEY.format(c='eventID')} AS k, {_ENVO} AS medium FROM sample_meta),
joined AS (SELECT kept.* REPLACE (coalesce(meta.eventID, kept.eventID) AS eventID), meta.eventDate,
  meta.medium AS env_medium, decimalLatitude, decimalLongitude, depth, size_frac, samp_size, k IS NOT NULL
  AS metadata_matched FROM kept LEFT JOIN meta ON k = {_KEY.format(c='kept.eventID')})"""


@query(
    "j7_join_sample_metadata",
    JOINED
    + " SELECT eventID, sequence, nb_reads, eventDate, env_medium, round(decimalLatitude, 6) AS decimalLatitude, metadata_matched FROM joined",
)
def _(spark, sf):
    occ = oc.add_sample_totals(oc.drop_non_target(oc.drop_controls(occurrences(spark, sf)), MARKER))
    meta = view(spark, sf, "sample_meta").withColumn("env_medium", dw.envo_term("env_medium"))
    df = oc.join_sample_metadata(occ, meta)
    return df.select(
        "eventID", "sequence", "nb_reads", "eventDate", "env_medium",
        F.round("decimalLatitude", 6).alias("decimalLatitude"), "metadata_matched",
    )


@query(
    "j7_match_rate",
    JOINED
    + """ SELECT count(*) AS n_rows, count(CASE WHEN metadata_matched THEN 1 END) AS n_matched,
    round(count(CASE WHEN metadata_matched THEN 1 END) / count(*), 6) AS match_rate FROM joined""",
)
def _(spark, sf):
    occ = oc.drop_non_target(oc.drop_controls(occurrences(spark, sf)), MARKER)
    return oc.metadata_match_rate(oc.join_sample_metadata(occ, view(spark, sf, "sample_meta")))


@query(
    "j7_duplicate_event_keys",
    ctes("names")
    + f""", k AS (SELECT coalesce({_KEY.format(c='name')}, '') AS event_key FROM names) SELECT event_key,
    count(*) AS n_rows FROM k WHERE event_key <> '' GROUP BY event_key HAVING count(*) > 1""",
)
def _(spark, sf):
    return oc.duplicate_event_keys(view(spark, sf, "names").withColumnRenamed("name", "eventID"))


@query(
    "j8_marker_primers",
    """WITH m AS (SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'Teleo' WHEN 1 THEN 'MIFISH' WHEN 2 THEN
    'vene' WHEN 3 THEN 'nosuch' ELSE 'teleo' END AS marker FROM nation) SELECT n_nationkey, marker, CASE
    lower(marker) WHEN 'teleo' THEN '12S' WHEN 'mifish' THEN '12S' WHEN 'vene' THEN ' 16S' END AS target_gene,
    CASE lower(marker) WHEN 'teleo' THEN 'ACACCGCCCGTCACTCT' WHEN 'mifish' THEN 'GTCGGTAAAACTCGTGCCAGC' WHEN
    'vene' THEN ' CSCTGTTATCCCYRCGGTA' END AS pcr_primer_forward FROM m""",
)
def _(spark, sf):
    key = F.col("n_nationkey") % 5
    markers = spark.read.parquet(f"{sf}/nation.parquet").select(
        "n_nationkey",
        F.when(key == 0, "Teleo").when(key == 1, "MIFISH").when(key == 2, "vene").when(key == 3, "nosuch")
        .otherwise("teleo").alias("marker"),
    )
    df = dw.marker_primers(markers)
    return df.select("n_nationkey", "marker", "target_gene", "pcr_primer_forward")


@query(
    "j18_project_constants",
    OCC
    + """ SELECT eventID, sequence, nb_reads, p.marker, p.recordedby FROM occ CROSS JOIN (SELECT
    first(n_name ORDER BY n_nationkey) AS recordedby, 'teleo' AS marker FROM nation) p""",
)
def _(spark, sf):
    project = spark.read.parquet(f"{sf}/nation.parquet").agg(
        F.min_by("n_name", "n_nationkey").alias("recordedby"), F.lit("teleo").alias("marker")
    )
    occ = occurrences(spark, sf).select("eventID", "sequence", "nb_reads")
    return dw.attach_project(occ, project)


_ENRICH = OCC + _more("authority1", "authority2") + """,
base AS (SELECT taxon AS scientificName, '' AS kingdom, '' AS phylum, coalesce("class", '') AS cls, nb_reads,
  eventID, sequence FROM occ),
keyed AS (SELECT *, CASE WHEN cls <> '' THEN cls ELSE scientificName END AS nm FROM base),
found AS (SELECT n.nm, CASE WHEN a.name IS NOT NULL THEN a.class_ ELSE b.class_ END AS fc, CASE WHEN a.name IS
  NOT NULL THEN a.phylum ELSE b.phylum END AS fp, CASE WHEN a.name IS NOT NULL THEN a.kingdom ELSE b.kingdom END
  AS fk FROM (SELECT DISTINCT nm FROM keyed) n LEFT JOIN authority1 a ON a.name = n.nm
  LEFT JOIN authority2 b ON b.name = n.nm),
enriched AS (SELECT scientificName, eventID, sequence, nb_reads, CASE WHEN cls = '' THEN coalesce(fc, '')
  ELSE cls END AS "class", coalesce(fp, '') AS phylum, coalesce(fk, '') AS kingdom FROM keyed LEFT JOIN found
  USING (nm))"""


@query("j9_enrich_higher_ranks", _ENRICH + " SELECT * FROM enriched")
def _(spark, sf):
    df = occurrences(spark, sf).select(
        F.col("taxon").alias("scientificName"), "eventID", "sequence", "nb_reads",
        F.coalesce("`class`", F.lit("")).alias("class"), F.lit("").alias("phylum"), F.lit("").alias("kingdom"),
    )
    return dw.enrich_higher_ranks(
        df, named(view(spark, sf, "authority1")), named(view(spark, sf, "authority2"))
    )


def records(spark, sf):
    return dw.darwin_core_records(
        occurrences(spark, sf), view(spark, sf, "sample_meta"), PROJECT, otu_db="set B"
    )


_RECORDS = JOINED + """,
records AS (SELECT taxon AS scientificName, '' AS kingdom, '' AS phylum, "class", "order", family, genus,
  concat('teleo:', eventID, ':', substring(sha256(upper(sequence)), 1, 8)) AS occurrenceID,
  'MaterialSample' AS basisOfRecord, eventID, eventDate, 'Field team' AS recordedBy,
  nb_reads AS organismQuantity, 'DNA sequence reads' AS organismQuantityType,
  nb_reads_total AS sampleSizeValue, 'DNA sequence reads' AS sampleSizeUnit,
  'consensus of hits' AS identificationRemarks, 'reference set 1' AS identificationReferences,
  decimalLatitude, decimalLongitude, 'EPSG:4326' AS geodeticDatum, depth AS maximumDepthInMeters,
  size_frac, samp_size, rank AS TaxonRank, upper(sequence) AS DNA_sequence, '12S' AS target_gene,
  'ACACCGCCCGTCACTCT' AS pcr_primer_forward, 'CTTCCGGTACACTTACCATG' AS pcr_primer_reverse,
  'teleoF' AS pcr_primer_name_forward, 'teleoR' AS pcr_primer_name_reverse,
  'https://doi.org/10.1111/mec.13428' AS pcr_primer_reference, env_medium, 'paired' AS lib_layout,
  'paired amplicon reads' AS seq_meth, 'single linkage' AS otu_seq_comp_appr, 'set B' AS otu_db,
  'de novo' AS chimera_check, is_contaminant_candidate AS contamination_flag FROM joined)"""


@query("p24_darwin_core_records", _RECORDS + " SELECT * FROM records")
def _(spark, sf):
    return records(spark, sf)


@query(
    "v5_required_fields",
    _RECORDS + " SELECT count(*) AS n_records, 'otu_db' AS blank_fields FROM records",
)
def _(spark, sf):
    return dw.blank_required_fields(records(spark, sf).withColumn("otu_db", F.lit("")))


@query(
    "v4_project_metadata",
    """SELECT n_nationkey, concat_ws(',', CASE WHEN n_nationkey % 3 = 0 THEN 'marker' END, CASE WHEN
    n_nationkey % 5 = 0 THEN 'recordedby' END, CASE WHEN n_nationkey % 7 = 0 THEN 'identificationRemarks' END)
    AS blank_fields FROM nation""",
)
def _(spark, sf):
    def unless(n, c):
        return F.when(F.col("n_nationkey") % n != 0, F.col("n_name")).alias(c)

    df = spark.read.parquet(f"{sf}/nation.parquet").select(
        "n_nationkey", unless(3, "marker"), unless(5, "recordedby"), unless(7, "identificationRemarks"),
        F.col("n_name").alias("identificationReferences"),
    )
    blank = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in dw.REQUIRED_PROJECT]
    return df.select("n_nationkey", F.concat_ws(",", *blank).alias("blank_fields"))


@query(
    "u3_spread_and_melt",
    OCC + " SELECT sequence, eventID, CAST(sum(nb_reads) AS BIGINT) AS nb_reads FROM occ GROUP BY ALL",
)
def _(spark, sf):
    rows = occurrences(spark, sf)
    names = [r[0] for r in rows.select("eventID").distinct().orderBy("eventID").collect()]  # the columns of a wide sink
    wide = oc.spread_counts(rows, ["sequence"], names)
    samples = oc.sample_columns(wide, (*RANKS, "sequence"))
    return oc.nonzero(oc.melt_counts(wide, ["sequence"], samples, zeros=False))
