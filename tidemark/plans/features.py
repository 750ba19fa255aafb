"""Queries: feature tables, clustering, chimeras, denoising, classifiers, live tracking."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidemark.functions.ranks import RANKS
from tidemark.operators import chimera as ch
from tidemark.operators import classify as cy
from tidemark.operators import clustering as cu
from tidemark.operators import denoise as dn
from tidemark.operators import features as ft
from tidemark.operators.chimera_score import score_chimeras
from tidemark.operators.search import similarity_search
from tidemark.plans import sources as _source_views, tracking as _tracking_views  # noqa: F401
from tidemark.plans.registry import query
from tidemark.plans.views import VIEWS, ctes, view
from tidemark.session import new_path

DEREP = ctes("reads") + """,
derep AS (SELECT sample, sequence, count(*) AS size, sha1(sequence) AS amplicon FROM reads GROUP BY sample, sequence),
uniq AS (SELECT sequence, CAST(sum(size) AS BIGINT) AS size, sha1(sequence) AS amplicon FROM derep GROUP BY sequence)"""


def derep(spark, sf):
    return ft.dereplicate_samples(view(spark, sf, "reads"))


def uniq(spark, sf):
    return ft.dereplicate_all(derep(spark, sf))


@query("a1_dereplicate_samples", DEREP + " SELECT * FROM derep")
def _(spark, sf):
    return derep(spark, sf)


@query("a2_dereplicate_all", DEREP + " SELECT * FROM uniq")
def _(spark, sf):
    return uniq(spark, sf)


@query("u2_combine_samples", DEREP + " SELECT sample, sum(size)::BIGINT AS size, count(*) AS n FROM derep GROUP BY sample")
def _(spark, sf):
    d = derep(spark, sf)
    both = ft.combine_samples(d.where("sample < 'S5'"), d.where("sample >= 'S5'"))
    return both.groupBy("sample").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))


@query(
    "w7_by_abundance",
    DEREP + " SELECT amplicon, size, row_number() OVER (ORDER BY size DESC, amplicon) AS place FROM uniq",
)
def _(spark, sf):
    from tidemark.skew import number_rows

    return number_rows(uniq(spark, sf).select("amplicon", "size"), [F.desc("size"), F.asc("amplicon")], "place")


OTU = ctes("stats", "members", "reps", "sizes", "chimeras") + """,
numbered AS (SELECT *, row_number() OVER (ORDER BY mass DESC, seed DESC) AS OTU FROM stats),
described AS (SELECT n.*, r.sequence, coalesce(c.chimera, 'NA') AS chimera FROM numbered n JOIN reps r USING (seed) LEFT JOIN
  chimeras c USING (seed)),
per_sample AS (SELECT m.seed, s.sample, CAST(sum(size) AS BIGINT) AS reads FROM sizes s JOIN members m USING (amplicon) GROUP BY
  m.seed, s.sample)"""


def _otu_inputs(spark, sf):
    stats, members, reps, sizes, calls = (
        view(spark, sf, n) for n in ("stats", "members", "reps", "sizes", "chimeras")
    )
    return stats, members.select("seed", "amplicon"), reps, sizes, calls


@query("w3_number_seeds", OTU + " SELECT seed, mass, OTU FROM numbered")
def _(spark, sf):
    return ft.number_seeds(view(spark, sf, "stats").select("seed", "mass"))


@query("j5_describe_seeds", OTU + " SELECT OTU, seed, mass, sequence, chimera FROM described")
def _(spark, sf):
    stats, _, reps, _, calls = _otu_inputs(spark, sf)
    return ft.describe_seeds(stats, reps, calls).select("OTU", "seed", "mass", "sequence", "chimera")


@query("j5_seeds_without_representative", OTU + " SELECT seed FROM stats WHERE seed NOT IN (SELECT seed FROM reps)")
def _(spark, sf):
    stats, _, reps, _, _ = _otu_inputs(spark, sf)
    return ft.seeds_without_representative(stats, reps)


@query("j6_members_with_sizes", OTU + " SELECT * FROM per_sample")
def _(spark, sf):
    _, members, _, sizes, _ = _otu_inputs(spark, sf)
    return ft.seed_sample_sizes(members, sizes)


@query(
    "a3_otu_features",
    OTU
    + """ SELECT OTU, mass AS total, cloud, seed AS amplicon, length(sequence) AS length, seed_abundance AS abundance, chimera,
    (SELECT count(*) FROM per_sample p WHERE p.seed = d.seed AND reads > 0) AS spread, sequence FROM described d""",
)
def _(spark, sf):
    stats, members, reps, sizes, calls = _otu_inputs(spark, sf)
    return ft.otu_table(stats, members, reps, sizes, calls)[0]


@query("a3_otu_counts", OTU + " SELECT OTU, sample, reads FROM per_sample JOIN described USING (seed) WHERE reads > 0")
def _(spark, sf):
    stats, members, reps, sizes, calls = _otu_inputs(spark, sf)
    return ft.otu_table(stats, members, reps, sizes, calls)[1]


# Amplicons with near copies, from part: one or two substitutions, a deletion, a chain.
_S = "translate(md5(concat(p_name, '-', CAST(p_partkey AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT')"
VIEWS["pool"] = f"""
SELECT sequence, CAST(sum(size) AS BIGINT) AS size, sha1(sequence) AS amplicon FROM (
SELECT {_S} AS sequence, p_size + 5 AS size FROM {{part}}
UNION ALL SELECT concat(substring({_S}, 1, 4), 'C', substring({_S}, 6, 27)), p_size % 4 + 1 FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL SELECT concat(substring({_S}, 1, 4), 'CA', substring({_S}, 7, 26)), p_size % 3 + 1 FROM {{part}} WHERE p_partkey % 6 = 0
UNION ALL SELECT concat(substring({_S}, 1, 9), 'G', substring({_S}, 11, 10), 'T', substring({_S}, 22, 11)), 1 FROM {{part}}
  WHERE p_partkey % 4 = 1
UNION ALL SELECT concat(substring({_S}, 1, 19), substring({_S}, 21, 12)), 2 FROM {{part}} WHERE p_partkey % 5 = 2
) u GROUP BY sequence"""


def _near(nodes: str) -> str:
    """One-edit pairs of a node table (rank, sequence, size) by masked and shortened texts."""
    return f"""
pos AS (SELECT rank, sequence, i FROM {nodes}, range(1, 40) r(i) WHERE i <= length(sequence)),
mk AS (SELECT rank, i, concat(substr(sequence, 1, i - 1), '*', substr(sequence, i + 1)) AS k FROM pos),
dl AS (SELECT DISTINCT rank, concat(substr(sequence, 1, i - 1), substr(sequence, i + 1)) AS k FROM pos),
near AS (SELECT x.rank AS a, y.rank AS b FROM mk x JOIN mk y ON x.k = y.k AND x.rank < y.rank UNION SELECT least(d.rank, n.rank),
  greatest(d.rank, n.rank) FROM dl d JOIN {nodes} n ON n.sequence = d.k)"""


CLUSTERED = ctes("pool").replace("WITH ", "WITH RECURSIVE ") + f""",
nodes AS (SELECT *, row_number() OVER (ORDER BY size DESC, amplicon) AS rank FROM pool),{_near('nodes')},
links AS (SELECT a AS src, b AS dst FROM near UNION SELECT b, a FROM near JOIN nodes x ON x.rank = a JOIN nodes y ON y.rank = b
  WHERE x.size = y.size),
reach(root, node) AS (SELECT rank, rank FROM nodes UNION SELECT root, dst FROM reach JOIN links ON src = node),
labels AS (SELECT node AS rank, min(root) AS label FROM reach GROUP BY node),
members AS (SELECT n.*, label FROM nodes n JOIN labels USING (rank))"""


@query("r7_cluster_members", CLUSTERED + " SELECT amplicon, sequence, size, rank, label FROM members")
def _(spark, sf):
    return cu.cluster(view(spark, sf, "pool"))


@query(
    "r7_cluster_statistics",
    CLUSTERED
    + """ SELECT s.amplicon AS seed, m.mass, s.size AS seed_abundance, m.cloud FROM (SELECT label, CAST(sum(size) AS BIGINT) AS mass,
    count(*) AS cloud FROM members GROUP BY label) m JOIN nodes s ON s.rank = m.label""",
)
def _(spark, sf):
    stats, _ = cu.cluster_tables(cu.cluster(view(spark, sf, "pool")))
    return stats.drop("sequence")


@query(
    "r8_graft_light_clusters",
    CLUSTERED
    + """, mass AS (SELECT label, sum(size) AS mass FROM members GROUP BY label),
    lt AS (SELECT m.* FROM members m JOIN mass USING (label) WHERE mass <= 3),
    hv AS (SELECT m.* FROM members m JOIN mass USING (label) WHERE mass > 3),
    best AS (SELECT l.label, first(h.label ORDER BY h.rank, l.rank) AS target FROM lt l JOIN hv h ON
    abs(length(l.sequence) - length(h.sequence)) <= 2 AND levenshtein(l.sequence, h.sequence) <= 2 GROUP BY l.label)
    SELECT amplicon, coalesce(target, label) AS label FROM members LEFT JOIN best USING (label)""",
)
def _(spark, sf):
    return cu.graft_light(cu.cluster(view(spark, sf, "pool")), 3).select("amplicon", "label")


def _near_two(nodes: str) -> str:
    """Pairs of a node table within two edits: they share a text within one edit of both."""
    return f"""
pos AS (SELECT rank, sequence, i FROM {nodes}, range(1, 42) r(i) WHERE i <= length(sequence) + 1),
vr AS MATERIALIZED (SELECT rank, sequence AS k FROM {nodes} UNION SELECT rank, concat(substr(sequence, 1, i - 1), substr(sequence, i + 1))
  FROM pos WHERE i <= length(sequence) UNION SELECT rank, concat(substr(sequence, 1, i - 1), b, substr(sequence, i + x)) FROM pos,
  (VALUES ('A'), ('C'), ('G'), ('T')) t(b), (VALUES (0), (1)) u(x) WHERE i + x <= length(sequence) + 1),
near AS MATERIALIZED (SELECT DISTINCT x.rank AS a, y.rank AS b FROM vr x JOIN vr y ON x.k = y.k AND x.rank < y.rank)"""


CLUSTERED_TWO = CLUSTERED.replace(_near("nodes"), _near_two("nodes"))


@query("r7_cluster_two_edits", CLUSTERED_TWO + " SELECT amplicon, sequence, size, rank, label FROM members")
def _(spark, sf):
    return cu.cluster(view(spark, sf, "pool"), d=2)


# Reference and queries for search and classifiers: 32 bases of the genus, 32 of their own.
VIEWS["refs"] = """
SELECT concat('R', CAST(p_partkey AS STRING)) AS ref_id, concat(translate(md5(concat('g', CAST(g AS STRING))), '0123456789abcdef',
  'ACGTACGTACGTACGT'), translate(md5(CAST(p_partkey AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT')) AS sequence, 'Metazoa' AS
  kingdom, concat('P', CAST(g % 2 AS STRING)) AS phylum, concat('C', CAST(g % 4 AS STRING)) AS class_, concat('O', CAST(g % 8 AS
  STRING)) AS order_, concat('F', CAST(g % 16 AS STRING)) AS family, concat('G', CAST(g AS STRING)) AS genus, concat('S',
  CAST(CAST(floor(p_partkey / 5) AS BIGINT) AS STRING)) AS species FROM (SELECT p_partkey, CAST(floor(p_partkey / 20) AS BIGINT) AS g
  FROM {part}) p"""
VIEWS["asks"] = """
SELECT concat('Q', CAST(c_custkey AS STRING)) AS asv_id, CASE WHEN c_custkey % 3 = 0 THEN translate(reverse(s), 'ACGT', 'TGCA') ELSE
  s END AS sequence FROM (SELECT c_custkey, concat(translate(md5(concat('g', CAST(CAST(floor(c_custkey / 20) AS BIGINT) AS STRING))),
  '0123456789abcdef', 'ACGTACGTACGTACGT'), substring(translate(md5(CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey END
  AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 28)) AS s FROM {customer}) t"""


@query("r9_similarity_search")
def _(spark, sf):
    queries = view(spark, sf, "asks").withColumnRenamed("asv_id", "qseqid")
    refs = view(spark, sf, "refs").select(F.col("ref_id").alias("sseqid"), "sequence")
    return similarity_search(queries, refs, evalue=1e-10)


# Sequences of which some are made of the left of one and the right of another, from customer.
_H = "translate(md5(CAST(%s AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
VIEWS["mosaic"] = f"""
SELECT sequence, CAST(max(size) AS BIGINT) AS size, sha1(sequence) AS amplicon FROM (SELECT CASE WHEN c_custkey % 3 = 1 THEN
  concat(substring({_H % '(c_custkey - 1)'}, 1, 8 + c_custkey % 12), substring({_H % '(c_custkey + 2)'}, 9 + c_custkey % 12, 32))
  ELSE {_H % 'c_custkey'} END AS sequence, CASE WHEN c_custkey % 3 = 1 THEN 10 + c_custkey % 90 ELSE 60 + c_custkey % 50 END AS
  size FROM {{customer}}) m GROUP BY sequence"""


def _two_parents(source: str, scope: str, fold: str, floor: int, name: str) -> str:
    keep = f"{scope}, " if scope else ""
    on = f" AND e.{scope} = p.{scope}" if scope else ""
    two = f"l.{scope} = r.{scope} AND " if scope else ""
    lead = f"l.{scope}, " if scope else ""
    near = f"p.amplicon <> e.amplicon AND p.size >= e.size * {fold} AND p.size >= {floor}"
    own = f"e.{scope}, " if scope else ""

    def longest(pick: str, text: str, order: str) -> str:
        """The longest shared prefix or suffix of each pair, and of these the two best parents."""
        pairs = f"SELECT {own}e.amplicon, p.amplicon AS par, {pick}(e.i) AS i FROM {name}e e JOIN {name}e p ON e.{text} = p.{text}{on} AND {near} GROUP BY ALL"
        return f"(SELECT *, row_number() OVER (PARTITION BY {keep}amplicon ORDER BY i {order}) AS rn FROM ({pairs}) QUALIFY rn <= 2)"

    return f"""
{name}e AS MATERIALIZED (SELECT {keep}amplicon, size, i, substr(sequence, 1, i) AS pre, substr(sequence, i + 1) AS suf FROM {source},
  range(1, 64) g(i) WHERE i < length(sequence)),
{name}l AS MATERIALIZED {longest('max', 'pre', 'DESC')}, {name}r AS MATERIALIZED {longest('min', 'suf', 'ASC')},
{name} AS MATERIALIZED (SELECT DISTINCT {lead}l.amplicon FROM {name}l l JOIN {name}r r ON {two}l.amplicon = r.amplicon AND l.i >= r.i AND
  l.par <> r.par)"""


@query(
    "r10_chimera_calls",
    ctes("mosaic") + "," + _two_parents("mosaic", "", "2", 1, "sure") + "," + _two_parents("mosaic", "", "1.000000001", 1, "maybe")
    + """ SELECT amplicon, sequence, size, CASE WHEN amplicon IN (SELECT amplicon FROM sure) THEN 'Y' WHEN amplicon IN (SELECT
    amplicon FROM maybe) THEN '?' ELSE 'N' END AS chimera FROM mosaic""",
)
def _(spark, sf):
    return ch.call_chimeras(view(spark, sf, "mosaic"))


# Amplicons of 64 bases: parents, and mosaics of two of them with none to three changed bases.
_LONG = "concat(%s, %s)" % (_H % "%s", _H % "concat('x', CAST(%s AS STRING))")
_MIXED = f"""concat(substring({_LONG % ('(k - 1)', '(k - 1)')}, 1, 20 + k % 24), substring({_LONG % ('(k + 2)', '(k + 2)')}, 21 + k % 24, 64))"""
VIEWS["noisy_mosaic"] = f"""
SELECT sequence, CAST(max(size) AS BIGINT) AS size, sha1(sequence) AS amplicon FROM (SELECT CASE WHEN k % 3 <> 1 THEN {_LONG % ('k', 'k')}
  WHEN k % 4 = 0 THEN m WHEN k % 4 = 1 THEN concat(substring(m, 1, 9), translate(substring(m, 10, 1), 'ACGT', 'CAAC'), substring(m, 11))
  WHEN k % 4 = 2 THEN concat(substring(m, 1, 14), 'AA', substring(m, 17, 33), 'C', substring(m, 51)) ELSE concat(substring(m, 1, 2),
  translate(substring(m, 3, 1), 'ACGT', 'GTTG'), substring(m, 4, 27), 'T', substring(m, 32, 25), 'G', substring(m, 58)) END AS sequence,
  CASE WHEN k % 3 = 1 THEN 10 + k % 50 ELSE 60 + k % 50 END AS size FROM (SELECT c_custkey AS k, {_MIXED.replace('k', 'c_custkey')} AS m
  FROM {{customer}}) c) x GROUP BY sequence"""


@query("r10_scored_chimeras")
def _(spark, sf):
    return score_chimeras(view(spark, sf, "noisy_mosaic"))


VIEWS["mosaic_samples"] = f"""
SELECT sample, sequence, size * (1 + CAST(substring(sample, 2, 1) AS INT)) AS reads, sha1(sequence) AS amplicon, size *
  (1 + CAST(substring(sample, 2, 1) AS INT)) AS size FROM ({VIEWS['mosaic']}) m CROSS JOIN (SELECT 'T0' AS sample UNION ALL SELECT
  'T1' UNION ALL SELECT 'T2') s WHERE (size + CAST(substring(sample, 2, 1) AS INT)) % 4 <> 1"""


_VOTES = ctes("mosaic_samples") + "," + _two_parents("mosaic_samples", "sample", "1.5", 2, "flag") + """,
votes AS (SELECT m.sequence, count(*) AS n_samples, count(f.amplicon) AS n_flagged FROM mosaic_samples m LEFT JOIN flag f ON
  f.sample = m.sample AND f.amplicon = m.amplicon GROUP BY m.sequence)"""


@query("r11_bimera_votes", _VOTES + " SELECT * FROM votes")
def _(spark, sf):
    return ch.sample_votes(view(spark, sf, "mosaic_samples").select("sample", "sequence", "reads"))


@query(
    "r11_remove_bimeras",
    _VOTES
    + """ SELECT sample, sequence, reads FROM mosaic_samples JOIN votes USING (sequence) WHERE NOT (n_flagged >= n_samples OR
    (n_flagged > 0 AND n_flagged >= (n_samples - 1) * 0.9))""",
)
def _(spark, sf):
    return ch.remove_bimeras(view(spark, sf, "mosaic_samples").select("sample", "sequence", "reads"))


DENOISED = ctes("pool").replace("WITH ", "WITH RECURSIVE ") + f""",
nodes AS (SELECT *, row_number() OVER (ORDER BY size DESC, sequence) AS rank FROM pool),{_near('nodes')},
up AS (SELECT b AS child, min(a) AS parent FROM near JOIN nodes x ON x.rank = a JOIN nodes y ON y.rank = b WHERE y.size <= x.size *
  0.125 GROUP BY b),
walk(node, root) AS (SELECT rank, rank FROM nodes UNION SELECT node, parent FROM walk JOIN up ON child = root),
done AS (SELECT n.sequence, n.size, v.sequence AS variant FROM nodes n JOIN (SELECT node, min(root) AS root FROM walk GROUP BY node) w
  ON w.node = n.rank JOIN nodes v ON v.rank = w.root)"""


@query("r12_denoise", DENOISED + " SELECT * FROM done")
def _(spark, sf):
    return dn.denoise(view(spark, sf, "pool").select("sequence", "size"))


@query(
    "r12_variant_table",
    DENOISED + " SELECT variant AS sequence, CAST(sum(size) AS BIGINT) AS reads, length(variant) AS n FROM done GROUP BY variant",
)
def _(spark, sf):
    done = dn.denoise(view(spark, sf, "pool").select("sequence", "size")).withColumn("n", F.length("variant"))
    return dn.variant_table(done, ["n"])


@query(
    "r12_denoise_three_edits",
    ctes("pool").replace("WITH ", "WITH RECURSIVE ")
    + """, nodes AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY size DESC, sequence) AS rank FROM pool), near AS MATERIALIZED
    (SELECT x.rank AS a, y.rank AS b, x.size AS sa, y.size AS sb, levenshtein(x.sequence, y.sequence) AS d FROM nodes x JOIN nodes y ON
    x.size >= 4 * y.size AND abs(length(x.sequence) - length(y.sequence)) <= 3), up AS (SELECT b AS child, min(a) AS parent FROM near
    WHERE d <= 3 AND sb <= sa * pow(2, -(d + 1)) GROUP BY b), walk(node, root) AS (SELECT rank, rank FROM nodes UNION SELECT node, parent
    FROM walk JOIN up ON child = root) SELECT n.sequence, n.size, v.sequence AS variant FROM nodes n JOIN (SELECT node, min(root) AS root
    FROM walk GROUP BY node) w ON w.node = n.rank JOIN nodes v ON v.rank = w.root""",
)
def _(spark, sf):
    return dn.denoise(view(spark, sf, "pool").select("sequence", "size"), alpha=1.0, max_distance=3)


@query("r13_sequence_table", ctes("reads") + " SELECT sample, sequence, CAST(sum(read_no % 5 + 1) AS BIGINT) AS reads FROM reads GROUP BY ALL")
def _(spark, sf):
    return ft.sequence_table(view(spark, sf, "reads").withColumn("reads", F.col("read_no") % 5 + 1))


# Sequences and their shorter forms over samples, from part.
VIEWS["ragged"] = f"""
SELECT concat('S', CAST(k % 3 AS STRING)) AS sample, substring({_S}, 1 + k % 4, 28 + (k * 7 + p_partkey) % 5) AS sequence,
  CAST(sum(p_size + k) AS BIGINT) AS reads FROM {{part}} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 4) g GROUP BY 1, 2"""


@query(
    "r13_collapse_contained",
    ctes("ragged").replace("WITH ", "WITH RECURSIVE ")
    + """, nodes AS (SELECT sequence, sum(reads) AS size, row_number() OVER (ORDER BY sum(reads) DESC, sequence) AS rank FROM ragged
    GROUP BY sequence), win AS (SELECT rank, substr(sequence, i, n) AS w FROM nodes, range(1, 40) a(i), range(20, 40) b(n) WHERE n <
    length(sequence) AND i + n - 1 <= length(sequence)), links AS (SELECT DISTINCT least(w.rank, n.rank) AS src, greatest(w.rank,
    n.rank) AS dst FROM win w JOIN nodes n ON n.sequence = w.w), before AS (SELECT rank, coalesce(list(src) FILTER (src IS NOT NULL),
    []) AS lower, rank IN (SELECT src FROM links) AS asked FROM nodes LEFT JOIN links ON dst = rank GROUP BY rank), walk(rank, kept,
    root) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(0 AS BIGINT) UNION ALL SELECT b.rank, CASE WHEN asked AND
    list_min(list_intersect(lower, kept)) IS NULL THEN list_append(kept, b.rank) ELSE kept END, coalesce(list_min(list_intersect(lower,
    kept)), b.rank) FROM walk JOIN before b ON b.rank = walk.rank + 1), m AS (SELECT n.sequence, k.sequence AS kept FROM walk JOIN
    nodes n ON n.rank = walk.rank JOIN nodes k ON k.rank = walk.root) SELECT sample, kept AS sequence,
    CAST(sum(reads) AS BIGINT) AS reads FROM ragged JOIN m USING (sequence) GROUP BY ALL""",
)
def _(spark, sf):
    return dn.collapse_contained(view(spark, sf, "ragged"))


@query(
    "r13_collapse_overlapping",
    ctes("ragged").replace("WITH ", "WITH RECURSIVE ")
    + """, nodes AS (SELECT sequence, sum(reads) AS size, row_number() OVER (ORDER BY sum(reads) DESC, sequence) AS rank FROM ragged
    GROUP BY sequence), win AS (SELECT rank, substr(sequence, i, n) AS w FROM nodes, range(1, 40) a(i), range(20, 40) b(n) WHERE n <
    length(sequence) AND i + n - 1 <= length(sequence)), links AS (SELECT DISTINCT least(w.rank, n.rank) AS src, greatest(w.rank,
    n.rank) AS dst FROM win w JOIN nodes n ON n.sequence = w.w UNION SELECT least(a.rank, b.rank), greatest(a.rank, b.rank) FROM (SELECT rank, right(sequence,
    n) AS w FROM nodes, range(20, 40) g(n) WHERE n < length(sequence)) a JOIN (SELECT rank, left(sequence, n) AS w FROM nodes,
    range(20, 40) g(n) WHERE n < length(sequence)) b ON a.w = b.w AND a.rank <> b.rank), before AS (SELECT rank, coalesce(list(src) FILTER (src IS NOT NULL),
    []) AS lower, rank IN (SELECT src FROM links) AS asked FROM nodes LEFT JOIN links ON dst = rank GROUP BY rank), walk(rank, kept,
    root) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(0 AS BIGINT) UNION ALL SELECT b.rank, CASE WHEN asked AND
    list_min(list_intersect(lower, kept)) IS NULL THEN list_append(kept, b.rank) ELSE kept END, coalesce(list_min(list_intersect(lower,
    kept)), b.rank) FROM walk JOIN before b ON b.rank = walk.rank + 1), m AS (SELECT n.sequence, k.sequence AS kept FROM walk JOIN
    nodes n ON n.rank = walk.rank JOIN nodes k ON k.rank = walk.root) SELECT sample, kept AS sequence,
    CAST(sum(reads) AS BIGINT) AS reads FROM ragged JOIN m USING (sequence) GROUP BY ALL""",
)
def _(spark, sf):
    return dn.collapse_overlapping(view(spark, sf, "ragged"))


def refs(spark, sf):
    return view(spark, sf, "refs").withColumnsRenamed({"class_": "class", "order_": "order"})


def word_assignments(spark, sf):
    weights, genera = cy.train(refs(spark, sf))
    return cy.assign_by_words(view(spark, sf, "asks"), weights, genera)


@query(
    "r15_word_classifier",
    ctes("refs", "asks")
    + """, qs AS (SELECT asv_id, FALSE AS minus, sequence FROM asks UNION ALL SELECT asv_id, TRUE, translate(reverse(sequence), 'ACGT',
    'TGCA') FROM asks), qw AS (SELECT DISTINCT asv_id, minus, substr(sequence, i, 8) AS w FROM qs, range(1, 80) r(i) WHERE i + 7 <=
    length(sequence)), rw AS (SELECT DISTINCT ref_id, genus, substr(sequence, i, 8) AS w FROM refs, range(1, 80) r(i) WHERE i + 7 <=
    length(sequence)), wg AS (SELECT w, genus, count(*) AS m FROM rw GROUP BY w, genus), p AS (SELECT w, (sum(m) + 0.5) / ((SELECT
    count(*) FROM refs) + 1) AS p FROM wg GROUP BY w), g AS (SELECT genus, -ln(count(*) + 1) AS base FROM refs GROUP BY genus), nw AS
    (SELECT asv_id, minus, count(*) AS n FROM qw GROUP BY asv_id, minus), sc AS (SELECT asv_id, minus, wg.genus, sum(ln((m + p) / p)) +
    any_value(n) * any_value(base) AS score FROM qw JOIN wg USING (w) JOIN p USING (w) JOIN nw USING (asv_id, minus) JOIN g USING
    (genus) GROUP BY asv_id, minus, wg.genus) SELECT asv_id, first(genus ORDER BY score DESC, genus DESC) AS genus, round(max(score),
    4) AS score, first(minus ORDER BY score DESC, minus) AS minus FROM sc GROUP BY asv_id""",
)
def _(spark, sf):
    df = word_assignments(spark, sf)
    return df.select("asv_id", "genus", F.round("score", 4).alias("score"), "minus")


@query("r15_bootstrap_support")
def _(spark, sf):
    return word_assignments(spark, sf).withColumn("score", F.round("score", 4))


@query(
    "r16_exact_species",
    ctes("refs")
    + """, t AS (SELECT DISTINCT substr(sequence, 3, 30) AS sequence, CASE WHEN CAST(substr(ref_id, 2) AS INT) % 9 = 0 THEN 'G0' ELSE
    genus END AS genus FROM refs UNION SELECT DISTINCT substr(sequence, 5, 50), genus FROM refs) SELECT t.sequence, t.genus,
    string_agg(DISTINCT r.species, '/' ORDER BY r.species) AS species FROM t LEFT JOIN refs r ON r.genus = t.genus AND
    contains(r.sequence, t.sequence) GROUP BY t.sequence, t.genus""",
)
def _(spark, sf):
    r = refs(spark, sf)
    n = F.substring("ref_id", 2, 20).cast("int")
    short = r.select(F.substring("sequence", 3, 30).alias("sequence"), F.when(n % 9 == 0, "G0").otherwise(F.col("genus")).alias("genus"))
    long = r.select(F.substring("sequence", 5, 50).alias("sequence"), "genus")
    taxa = short.unionByName(long).distinct()
    return cy.exact_species(taxa, r)


# Classifier output with supports, from part.
VIEWS["boots"] = """
SELECT concat('ASV', CAST(p_partkey AS STRING)) AS asv_id, 'Metazoa' AS kingdom, concat('P', CAST(p_partkey % 2 AS STRING)) AS phylum,
  CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE concat('C', CAST(p_partkey % 4 AS STRING)) END AS class_, concat('O', CAST(p_partkey % 8
  AS STRING)) AS order_, concat('F', CAST(p_partkey % 16 AS STRING)) AS family, concat('G', CAST(p_partkey % 32 AS STRING)) AS genus,
  CASE WHEN p_partkey % 5 = 0 THEN concat('S', CAST(p_partkey % 64 AS STRING)) END AS species, 100 AS boot_kingdom, 60 + p_size AS
  boot_phylum, 55 + p_size AS boot_class, 50 + p_size AS boot_order, 45 + p_size AS boot_family, 40 + p_size AS boot_genus FROM {part}"""
_B = ("kingdom", "phylum", "class_", "order_", "family", "genus")


def _mask_sql() -> str:
    def ok(i: int) -> str:
        return " AND ".join(f"({c} IS NOT NULL AND (species IS NOT NULL OR boot_{c.rstrip('_')} >= 80))" for c in _B[: i + 1])

    cols = [f'CASE WHEN {ok(i)} THEN {c} END AS "{c.rstrip("_")}"' for i, c in enumerate(_B)]
    least = ", ".join(f"CASE WHEN {ok(i)} THEN boot_{c.rstrip('_')} END" for i, c in enumerate(_B))
    return f""" SELECT asv_id, {', '.join(cols)}, CASE WHEN {ok(5)} THEN species END AS species, CAST(least({least}) AS DOUBLE) AS
    bootstrap_min FROM boots"""


@query("r17_mask_bootstrap", ctes("boots") + _mask_sql())
def _(spark, sf):
    df = view(spark, sf, "boots").withColumnsRenamed({"class_": "class", "order_": "order"})
    return cy.mask_bootstrap(df).select("asv_id", *RANKS, "bootstrap_min")


@query(
    "r18_flatten_ranks",
    ctes("boots")
    + """ SELECT asv_id AS sequence, kingdom, NULL AS phylum, NULL AS "class", CASE WHEN boot_order > 70 THEN order_ END AS "order",
    family, CAST(NULL AS VARCHAR) AS genus, species, 100.0::DOUBLE AS confidence_kingdom, NULL::DOUBLE AS confidence_phylum,
    NULL::DOUBLE AS confidence_class, CASE WHEN boot_order > 70 THEN boot_order::DOUBLE END AS confidence_order, boot_family::DOUBLE AS
    confidence_family, NULL::DOUBLE AS confidence_genus, CASE WHEN species IS NOT NULL THEN 1.5::DOUBLE END AS confidence_species FROM
    boots""",
)
def _(spark, sf):
    def entry(rank, taxon, confidence):
        return F.struct(F.lit(rank).alias("rank"), taxon.alias("taxon"), confidence.cast("double").alias("confidence"))

    df = view(spark, sf, "boots")
    items = F.array_compact(
        F.array(
            entry("Root", F.lit("Root"), F.lit(100)),
            entry("Kingdom", F.col("kingdom"), F.lit(100)),
            F.when(F.col("boot_order") > 70, entry("ORDER", F.col("order_"), F.col("boot_order"))),
            entry("family", F.lit("old"), F.lit(1)),
            entry("Family", F.col("family"), F.col("boot_family")),
            F.when(F.col("species").isNotNull(), entry("species", F.col("species"), F.lit(1.5))),
        )
    )
    return cy.flatten_ranks(df.select(F.col("asv_id").alias("sequence"), items.alias("assignments")))


def _write_named(lines, folder):
    """Log lines as one text file in a folder of each log's name."""
    one = lines.select(F.element_at(F.split("file", "/"), -1).alias("log"), "line_no", "value")
    one.repartition("log").sortWithinPartitions("log", "line_no").select("log", "value").write.partitionBy("log").text(folder)


@query(
    "x1_live_tracking",
    ctes("trim")
    + """ SELECT sample, 'raw' AS step, raw AS reads FROM trim WHERE raw IS NOT NULL UNION ALL SELECT sample, 'trimmed', trimmed FROM trim WHERE trimmed IS NOT NULL""",
)
def _(spark, sf):
    from tidemark.streaming import live_tracking as live

    folder = new_path(spark, "logs")
    _write_named(view(spark, sf, "trim_lines"), folder)
    # log folders have the logs' names; Spark wrote them, so nothing more will come
    named = F.regexp_extract(F.url_decode("file"), "/log=([^/]+)/", 1)
    stream = live.watch_trim_logs(spark, folder, named, quiet_seconds=0)
    out = new_path(spark, "live-counts")
    live.start(stream, out, new_path(spark, "stream")).awaitTermination()
    return live.read_counts(spark, out)
