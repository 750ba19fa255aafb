"""Queries: scans and sinks. Each writes files from the tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.ranks import RANKS
from tidemark.operators.manifest import (
    EXPECTED_UNMAPPED,
    FIELD_ALIASES,
    MANIFEST_FIELDS,
    UNMAPPED_PREFIXES,
    load_rows,
)
from tidemark.operators.occurrence import (
    ecotag_schema,
    occurrences_from_wide,
    reserved_sample_names,
    sample_columns,
    standard_schema,
    OTU_TABLE_COLUMNS,
)
from tidemark.plans import manifest as _manifest_views, tracking as _tracking_views  # noqa: F401
from tidemark.plans.registry import query
from tidemark.plans.taxonomy import ALL_RANKS, LINKED, lineage, linked, q, sql_miss
from tidemark.plans.views import VIEWS, ctes, view
from tidemark.session import new_path
from tidemark.sources import clusters, logs, sequences, tables
from tidemark.sources.fastq import read_pairs, write_pairs


def write_lines(spark, df, label, *order):
    """The column ``value`` as a text file below the shared folder."""
    path = new_path(spark, label)
    (df.orderBy(*order) if order else df).select("value").write.text(path)
    return path


_LONGSEQ = "concat(sequence, sequence, sequence)"


@query("s1_s2_fasta_round_trip", ctes("features") + f" SELECT asv_id AS id, {_LONGSEQ} AS sequence FROM features")
def _(spark, sf):
    df = view(spark, sf, "features").select(
        "otu", F.col("asv_id").alias("id"), F.concat("sequence", "sequence", "sequence").alias("sequence")
    )
    path = new_path(spark, "fasta")
    sequences.write_fasta(df, path, order=[F.col("otu")])
    return sequences.read_fasta(spark, path)


@query(
    "s1_fasta_descriptions",
    ctes("features") + """ SELECT asv_id AS id, sequence, concat(asv_id, ' note >', CAST(otu AS VARCHAR)) AS description
    FROM features""",
)
def _(spark, sf):
    df = view(spark, sf, "features").withColumn("note", F.concat(F.lit("note >"), F.col("otu").cast("string")))
    path = new_path(spark, "fasta")
    sequences.write_fasta(df, path, "asv_id", "sequence", "note")
    return sequences.read_fasta(spark, path, description=True)


# Read pairs from events: primer + 64-base insert + reverse primer, 70 bases read from each end.
_DNA2 = "translate(md5(CAST(%s AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
FORWARD_PRIMER, REVERSE_PRIMER = "ACACCGCCCGTCACTCT", "CTTCCGGTACACTTACCATG"
_RCSQL = "translate(reverse({c}), 'ACGT', 'TGCA')"
_AMPLICON = f"""SELECT event_id, user_id, value, concat('{FORWARD_PRIMER}', ins, '{"CATGGTAAGTGTACCGGAAG"}') AS amp FROM (SELECT event_id,
  user_id, value, concat({_DNA2 % 'event_id % 97'}, {_DNA2 % '(event_id % 97 + 1000)'}) AS ins FROM {{events}}) i"""
VIEWS["pairs"] = f"""
SELECT concat('S', CAST(user_id % 12 AS STRING)) AS sample, event_id AS read_no,
  CASE WHEN event_id % 19 = 3 THEN concat('TT', substring(amp, 3, 68)) WHEN event_id % 23 = 5 THEN
    concat('GATTACAGATTACA', substring(amp, 30, 56)) ELSE substring(amp, 1, 70) END AS r1_seq,
  CASE WHEN event_id % 29 = 4 THEN concat(repeat('I', 30), '#', repeat('I', 39)) WHEN event_id % 31 = 6 THEN repeat('/', 70)
    ELSE repeat('I', 70) END AS r1_qual,
  CASE WHEN event_id % 37 = 8 THEN concat(substring({_RCSQL.format(c='amp')}, 1, 60), 'N', substring({_RCSQL.format(c='amp')}, 62, 9))
    ELSE substring({_RCSQL.format(c='amp')}, 1, 70) END AS r2_seq, repeat('I', 70) AS r2_qual
FROM ({_AMPLICON}) a"""


@query("s3_paired_fastq_scan", ctes("pairs") + " SELECT sample, count(*) AS n_pairs, count(DISTINCT r1_seq) AS n_r1, "
       "min(r2_seq) AS first_r2, max(r1_qual) AS last_qual FROM pairs GROUP BY sample")
def _(spark, sf):
    path = new_path(spark, "fastq")
    df = view(spark, sf, "pairs").select("sample", "read_no", "r1_seq", "r1_qual", "r2_seq", "r2_qual")
    write_pairs(df, path).collect()
    back = read_pairs(spark, path).withColumn("sample", F.regexp_replace("sample", r"\.p\d+$", ""))
    return back.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("r1_seq").alias("n_r1"),
        F.min("r2_seq").alias("first_r2"), F.max("r1_qual").alias("last_qual"),
    )


_MATRIX = ctes("features", "counts", "samples") + """,
m AS (SELECT f.otu, f.asv_id, f.sequence, s.eventID AS sample, CAST(coalesce(c.reads, 0) AS BIGINT) AS reads FROM features f
  CROSS JOIN samples s LEFT JOIN counts c ON c.asv_id = f.asv_id AND c.sample_no =
  s.sample_no)"""


def _matrix_file(spark, sf):
    from tidemark.operators.occurrence import spread_counts

    samples = view(spark, sf, "samples").select("sample_no", "eventID").orderBy("eventID", "sample_no").collect()
    features = view(spark, sf, "features").select("otu", "asv_id", "sequence")
    long = view(spark, sf, "counts").select("asv_id", "sample_no", "reads")
    # by the sample's number: event ids may repeat
    packed = spread_counts(long, ["asv_id"], [r[0] for r in samples], "reads", "sample_no", [r[1] for r in samples])
    path = new_path(spark, "matrix")
    tables.write_counts_matrix(features.join(packed, "asv_id", "left"), path, "otu")
    return path


@query("s4_counts_matrix", _MATRIX + " SELECT sequence, sample, reads FROM m")
def _(spark, sf):
    long, _ = tables.read_counts_matrix(spark, _matrix_file(spark, sf))
    return long.select("sequence", "sample", "reads")


@query("w4_number_features", _MATRIX + " SELECT DISTINCT asv_id, sequence FROM m")
def _(spark, sf):
    rows = tables.read_matrix_sequences(spark, _matrix_file(spark, sf))
    return tables.number_features(rows, ("file", "row_no")).select("asv_id", "sequence")


@query("s13_clustered_reads", _MATRIX + " SELECT sample, CAST(sum(reads) AS BIGINT) AS clustered FROM m GROUP BY sample")
def _(spark, sf):
    long, _ = tables.read_counts_matrix(spark, _matrix_file(spark, sf))
    return tables.clustered_reads(long)


@query(
    "s5_search_hits",
    ctes("hits")
    + """ SELECT qseqid, sseqid, pident, bitscore, row_number() OVER (PARTITION BY qseqid ORDER BY hit_no) AS blast_rank
    FROM hits""",
)
def _(spark, sf):
    from tidemark.operators.taxonomy import hit_ranks

    df = view(spark, sf, "hits")
    zero = F.lit("0")
    value = F.concat_ws("\t", "qseqid", "sseqid", F.col("pident").cast("string"), *[zero] * 7, F.lit("1e-30"), F.col("bitscore").cast("string"))
    path = write_lines(spark, df.withColumn("value", value), "hits", "qseqid", "hit_no")
    return hit_ranks(tables.read_hits(spark, path)).select("qseqid", "sseqid", "pident", "bitscore", "blast_rank")


@query(
    "s6_reference_lineages",
    ctes("lineage") + """ SELECT sseqid, 7 AS n_ranks, kingdom, phylum, class_ AS "class", order_ AS "order", family, genus,
    species FROM lineage""",
)
def _(spark, sf):
    df = lineage(spark, sf)
    ranks = F.concat_ws(";", *[F.coalesce(F.col(f"`{r}`"), F.lit("NA")) for r in RANKS])
    rows = df.select(
        F.explode(
            F.array(
                F.concat(F.lit(">"), "sseqid", F.lit("\told;old;old;old;old;old;old")),
                F.concat(F.lit(">"), "sseqid", F.lit("\t"), ranks),
                F.lit("ACGT"),
            )
        ).alias("value"),
        "sseqid",
    )
    path = write_lines(spark, rows, "refs")
    return sequences.read_reference_lineages(spark, path)


@query(
    "s6_incomplete_lineages",
    "SELECT concat('P', p_partkey) AS sseqid, p_size % 7 AS n_ranks FROM part",
)
def _(spark, sf):
    size = F.col("p_size") % 7
    df = spark.read.parquet(f"{sf}/part.parquet").select(
        F.concat(F.lit(">P"), F.col("p_partkey").cast("string"), F.lit("\t"), F.rtrim(F.repeat(F.lit("x;"), size), F.lit(";"))).alias("value")
    )
    return sequences.incomplete_lineages(
        sequences.read_reference_lineages(spark, write_lines(spark, df, "refs"))
    )


# Cluster files from part and lineitem: seeds, members, calls.
VIEWS["stats"] = """
SELECT concat('A', CAST(seed_no AS STRING)) AS seed, CAST(s * 10 AS BIGINT) AS mass, CAST(s AS BIGINT) AS seed_abundance,
  CAST(s % 5 + 1 AS BIGINT) AS cloud FROM (SELECT p_partkey - p_partkey % 4 AS seed_no, max(CASE WHEN p_partkey % 4 = 0 THEN p_size END)
  AS s FROM {part} GROUP BY p_partkey - p_partkey % 4) g WHERE s IS NOT NULL"""
VIEWS["members"] = """
SELECT concat('A', CAST(p_partkey - p_partkey % 4 AS STRING)) AS seed, concat('A', CAST(p_partkey AS STRING)) AS amplicon,
  p_partkey FROM {part}"""
VIEWS["sizes"] = """
SELECT concat('sample', CAST(l_suppkey % 7 AS STRING)) AS sample, concat('A', CAST(part_no AS STRING)) AS amplicon,
  CAST(sum(l_quantity) AS BIGINT) AS size FROM (SELECT *, CASE WHEN l_partkey % 6 = 5 THEN l_partkey - 1 ELSE l_partkey END AS part_no
  FROM {lineitem}) l GROUP BY l_suppkey % 7, part_no"""
VIEWS["reps"] = """
SELECT concat('A', CAST(p_partkey AS STRING)) AS seed, translate(md5(CAST(p_partkey AS STRING)), '0123456789abcdef',
  'ACGTACGTACGTACGT') AS sequence FROM {part} WHERE p_partkey % 4 = 0 AND p_partkey % 36 <> 8"""
VIEWS["chimeras"] = """
SELECT concat('A', CAST(p_partkey AS STRING)) AS seed, CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN '?' ELSE 'N' END AS
  chimera FROM {part} WHERE p_partkey % 4 = 0 AND p_partkey % 20 <> 4"""


@query("s7_cluster_stats", ctes("stats") + " SELECT * FROM stats")
def _(spark, sf):
    df = view(spark, sf, "stats")
    row = F.concat_ws("\t", F.col("cloud").cast("string"), F.col("mass").cast("string"),
                      F.concat("seed", F.lit(";size="), F.col("seed_abundance").cast("string"), F.lit(";")),
                      F.col("seed_abundance").cast("string"), F.lit("0"))
    old = F.concat_ws("\t", F.lit("1"), F.lit("1"), "seed", F.lit("1"))
    rows = df.select(F.explode(F.array(old, row, F.lit("short\tline"))).alias("value"))
    return clusters.read_cluster_stats(spark, write_lines(spark, rows, "stats"))


@query("s8_cluster_members", ctes("members") + " SELECT seed, amplicon FROM members")
def _(spark, sf):
    df = view(spark, sf, "members")
    entry = F.when(F.col("p_partkey") % 3 == 0, F.concat("amplicon", F.lit("_12"))).otherwise(
        F.concat("amplicon", F.lit(";size=3;"))
    )
    lines = df.groupBy("seed").agg(
        F.sort_array(F.collect_list(F.struct("p_partkey", entry.alias("e")))).alias("m")
    ).select(F.concat_ws(" ", F.transform("m", lambda s: s["e"])).alias("value"))
    return clusters.read_cluster_members(spark, write_lines(spark, lines, "members"))


def _chimera_lines(spark, sf):
    df = view(spark, sf, "chimeras")
    long = F.concat_ws("\t", F.lit("0.1"), F.concat("seed", F.lit(";size=9;")), *[F.lit("*")] * 15, "chimera")
    row = F.when(F.col("chimera") == "N", F.concat_ws("\t", F.lit("0"), F.concat("seed", F.lit(";size=2;")))).otherwise(long)
    rows = df.select(F.explode(F.array(row, F.lit(""), F.concat(F.lit("broken-"), "seed"))).alias("value"))
    return write_lines(spark, rows, "chimera")


@query(
    "s9_chimera_calls",
    ctes("chimeras") + " SELECT seed, CASE WHEN chimera = 'N' THEN 'NA' ELSE chimera END AS chimera FROM chimeras",
)
def _(spark, sf):
    return clusters.read_chimera_calls(spark, _chimera_lines(spark, sf))


@query("s9_unreadable_chimera_lines", ctes("chimeras") + " SELECT concat('broken-', seed) AS value FROM chimeras")
def _(spark, sf):
    return clusters.unreadable_chimera_lines(spark, _chimera_lines(spark, sf)).select("value")


@query(
    "s10_sample_amplicons",
    """SELECT concat('sample', l_suppkey % 7) AS sample, concat('A', l_partkey) AS amplicon, CAST(sum(CASE WHEN l_linenumber
    = 3 THEN 1 ELSE l_quantity END) AS BIGINT) AS size FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    head = F.concat(F.lit(">A"), F.col("l_partkey").cast("string"))
    sized = F.concat(head, F.lit(";size="), F.col("l_quantity").cast("long").cast("string"), F.lit(";"))
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.concat(F.lit("/d/sample"), (F.col("l_suppkey") % 7).cast("string"), F.lit(".fasta")).alias("file"),
        F.explode(F.array(F.when(F.col("l_linenumber") == 3, head).otherwise(sized), F.lit("ACGTACGT"))).alias("value"),
    )
    return sequences.parse_sample_amplicons(lines)


@query("s12_step_counts", ctes("track") + " SELECT sample, input, filtered, denoised, merged, nonchim FROM track")
def _(spark, sf):
    path = new_path(spark, "track")
    tables.write_table(view(spark, sf, "track"), path, "csv")
    return tables.read_step_counts(spark, path)


@query(
    "s14_field_sheet",
    ctes("field_text") + " SELECT eventID, eventDate, decimalLatitude, samp_size, extraction_ID FROM field_text",
)
def _(spark, sf):
    df = view(spark, sf, "field_text").select(
        F.col("eventID").alias("﻿EventID"), F.col("eventDate").alias("eventdate "),
        F.col("decimalLatitude").alias("decimalLatitude [deg]"), F.col("samp_size").alias("Volume"),
        F.col("samp_size").alias("samp_size"), F.col("extraction_ID"), F.lit("x").alias("Test"),
        F.lit("y").alias("River  width [m]"),
    )
    path = new_path(spark, "field")
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    back = tables.read_text_table(spark, path)
    outcomes = tables.header_outcomes(back.columns, FIELD_ALIASES, EXPECTED_UNMAPPED, UNMAPPED_PREFIXES)
    named = tables.rename_headers(back, outcomes)
    return named.withColumn("extraction_ID", F.nullif("extraction_ID", F.lit("")))


@query("s15_tag_sheet", ctes("tags") + " SELECT eventID, coalesce(tag_demultiplex, '') AS tag_demultiplex, library FROM tags")
def _(spark, sf):
    path = new_path(spark, "tags")
    df = view(spark, sf, "tags").fillna({"tag_demultiplex": ""})
    df.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_tag_table(spark, path)


VIEWS["good_manifest"] = f"""
SELECT eventID, '2025-08-19' AS eventDate, decimalLatitude, concat('run', CAST(sample_no % 3 AS
  STRING)) AS seq_run_id, CASE WHEN sample_no % 10 < 2 THEN 'negative control' ELSE 'sample' END AS samp_category,
  CASE WHEN sample_no % 10 = 0 THEN 'PCR negative' WHEN sample_no % 10 = 1 THEN 'extraction negative' END AS neg_cont_type,
  extraction_ID FROM ({VIEWS['samples']}) s"""


@query(
    "s17_manifest_round_trip",
    ctes("good_manifest") + " SELECT *, 'metabarcoding' AS assay_type, CAST(NULL AS BIGINT) AS reads_raw FROM good_manifest",
)
def _(spark, sf):
    df = view(spark, sf, "good_manifest")
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST_FIELDS]
    path = new_path(spark, "manifest")
    tables.write_table(df.select(*cols), path, "csv")
    back = load_rows(tables.read_text_table(spark, path))
    return back.select(*df.columns, "assay_type", "reads_raw")


_ECO = ctes("taxa") + ",\n" + "eco AS (SELECT sequence, " + ", ".join(
    f"CASE WHEN {sql_miss(v)} THEN NULL ELSE {v} END AS {q(r)}"
    for r, v in (("order", "order_"), ("family", "family"), ("genus", "genus"), ("species", "species"))
) + " FROM taxa)"


def _ecotag_file(spark, sf):
    df = view(spark, sf, "taxa").select(
        F.col("asv_id").alias("id"), "sequence", F.lit(1).alias("count"), F.lit("d").alias("definition"),
        F.col("order_").alias("order_name"), F.col("otu").alias("order"), F.col("family").alias("family_name"),
        F.col("otu").alias("family"), F.col("genus").alias("genus_name"), F.col("otu").alias("genus"),
        F.col("species").alias("species_name"), F.col("otu").alias("species"), F.lit(7).alias("taxid"),
        F.lit(0.9).alias("best_identity:db"), F.lit("r").alias("species_list:db"),
    )
    path = new_path(spark, "obitab")
    df.write.option("header", True).option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("s20_p15_ecotag_table", _ECO + """ SELECT sequence, CAST(NULL AS VARCHAR) AS kingdom, CAST(NULL AS VARCHAR) AS phylum,
    CAST(NULL AS VARCHAR) AS "class", "order", family, genus, species FROM eco""")
def _(spark, sf):
    return ecotag_schema(tables.read_tsv(spark, _ecotag_file(spark, sf))).select("sequence", *RANKS)


_STD = LINKED + f""",
w AS (SELECT sequence, {', '.join(f"nullif({q(r)}, 'Unassigned') AS {q(r)}" for r in RANKS)}, is_contaminant_candidate,
  CAST(regexp_extract(asv_id, '[0-9]+') AS BIGINT) AS n FROM linked),
lw AS (SELECT *, 'W1' AS eventID, n % 5 AS nb_reads FROM w UNION ALL SELECT *, 'W2', n % 7 FROM w),
pos AS (SELECT * EXCLUDE (n) FROM lw WHERE nb_reads > 0),
lb AS (SELECT *, CASE WHEN species IS NOT NULL AND NOT contains(species, '/') THEN 'species' WHEN genus IS NOT NULL THEN
  'genus' WHEN family IS NOT NULL THEN 'family' ELSE 'higher' END AS rank FROM pos)
SELECT * REPLACE (CASE WHEN NOT contains(species, '/') THEN species END AS species), CASE WHEN species IS NOT NULL AND NOT
  contains(species, '/') THEN species ELSE coalesce(genus, family, "order", "class", phylum, kingdom) END AS taxon FROM lb"""


def _wide_table(df):
    n = F.regexp_extract("asv_id", r"(\d+)", 1).cast("long")
    return df.select(
        F.col("asv_id").alias("ASV_ID"), "pident", *RANKS, "is_contaminant_candidate",
        (n % 5).alias("W1"), (n % 7).alias("W2"), F.col("sequence").alias("Sequence"), F.lit("1").alias("X"),
    )


@query("p14_standard_schema", _STD)
def _(spark, sf):
    return occurrences_from_wide(_wide_table(linked(spark, sf)), "blast")


@query(
    "p14_schema_columns",
    LINKED + f" SELECT asv_id AS \"ASV_ID\", {', '.join(f'nullif({q(r)}, {chr(39)}Unassigned{chr(39)}) AS {q(r)}' for r in RANKS)}, sequence FROM linked",
)
def _(spark, sf):
    return standard_schema(_wide_table(linked(spark, sf))).select("ASV_ID", *RANKS, "sequence")


@query(
    "p9_sample_columns",
    LINKED + """ SELECT 'W1' AS sample, CAST(sum(CAST(regexp_extract(asv_id, '[0-9]+') AS BIGINT) % 5) AS BIGINT) AS reads FROM
    linked UNION ALL SELECT 'W2', CAST(sum(CAST(regexp_extract(asv_id, '[0-9]+') AS BIGINT) % 7) AS BIGINT) FROM linked""",
)
def _(spark, sf):
    wide = _wide_table(linked(spark, sf))
    names = sample_columns(wide, (*RANKS, "ASV_ID", "pident", "is_contaminant_candidate", "Sequence", "sequence"))
    sums = wide.agg(*[F.sum(n).alias(n) for n in names])
    return sums.unpivot([], names, "sample", "reads")


@query(
    "p10_reserved_names",
    "SELECT DISTINCT CASE event_type WHEN 'view' THEN 'total' WHEN 'click' THEN 'length' END AS sample FROM events WHERE event_type "
    "IN ('view', 'click')",
)
def _(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select(
        F.when(F.col("event_type") == "view", "total").when(F.col("event_type") == "click", "length")
        .otherwise(F.concat(F.lit("S"), F.col("user_id").cast("string"))).alias("sample")
    )
    return reserved_sample_names(df, OTU_TABLE_COLUMNS)


# Run state files from orders: one run per customer bucket, steps with metadata.
@query(
    "s21_run_state",
    """SELECT concat('m', c_custkey) AS marker, step, CASE WHEN step = 'trim' THEN 'completed' ELSE 'running' END AS status, CASE
    WHEN step = 'trim' THEN c_acctbal END AS duration_seconds, CASE WHEN step = 'trim' THEN c_custkey * 3 END AS raw_total FROM
    customer CROSS JOIN (SELECT unnest(['trim', 'swarm']) AS step)""",
)
def _(spark, sf):
    return _states(spark, sf).select(
        "marker", "step", "status", "duration_seconds", F.col("read_tracking.raw_reads_total").alias("raw_total")
    )


def _states(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet")

    def step(status, seconds, meta):
        return F.struct(F.lit(status).alias("status"), seconds.alias("duration_seconds"), meta.alias("metadata"))

    per_sample = F.create_map(
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")),
        F.create_map(F.lit("raw"), F.col("c_custkey") * 3, F.lit("trimmed"), F.col("c_custkey") * 2),
    )
    tracked = F.struct(
        F.struct((F.col("c_custkey") * 3).alias("raw_reads_total")).alias("read_tracking"),
        per_sample.alias("read_tracking_per_sample"),
    )
    plain = F.struct(F.struct(F.lit(None).cast("long").alias("raw_reads_total")).alias("read_tracking"),
                     F.lit(None).cast("map<string,map<string,bigint>>").alias("read_tracking_per_sample"))
    steps = F.create_map(
        F.lit("trim"), step("completed", F.col("c_acctbal"), tracked),
        F.lit("swarm"), step("running", F.lit(None).cast("double"), plain),
    )
    rows = df.select(F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("marker"), steps.alias("steps"))
    path = new_path(spark, "state")
    rows.write.json(path)
    return logs.read_run_state(spark, path, multi_line=False)


@query(
    "a31_step_timeline",
    """SELECT concat('m', c_custkey) AS marker, step, CASE WHEN step = 'trim' THEN 'completed' ELSE 'running' END AS status, CASE
    WHEN step = 'trim' THEN c_acctbal END AS duration_seconds FROM customer CROSS JOIN (SELECT unnest(['trim', 'swarm']) AS
    step)""",
)
def _(spark, sf):
    from tidemark.operators.summary import step_timeline

    return step_timeline(_states(spark, sf))


@query(
    "a31_monitor_counts",
    """SELECT concat('m', c_custkey) AS marker, concat('E', c_custkey) AS eventID, c_custkey * 3 AS raw, c_custkey * 2 AS trimmed,
    CAST(NULL AS BIGINT) AS clustered FROM customer""",
)
def _(spark, sf):
    from tidemark.operators.summary import monitor_counts

    return monitor_counts(_states(spark, sf), ("raw", "trimmed", "clustered"))


@query(
    "s18_primer_table",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'euka' ELSE 'euka3' END AS name, CASE WHEN n_nationkey % 2 = 0 THEN
    '18S' ELSE ' 18S' END AS target_gene FROM nation""",
)
def _(spark, sf):
    from tidemark.sources.primers import primer_table

    names = spark.read.parquet(f"{sf}/nation.parquet").select(
        "n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, "euka").otherwise("euka3").alias("name")
    )
    return names.join(F.broadcast(primer_table(spark)), "name").select("n_nationkey", "name", "target_gene")


@query(
    "s22_table_sink",
    ctes("counts") + " SELECT asv_id, sample_no, reads FROM counts",
)
def _(spark, sf):
    path = new_path(spark, "counts")
    tables.write_table(view(spark, sf, "counts"), path, "parquet")
    return spark.read.parquet(path)
