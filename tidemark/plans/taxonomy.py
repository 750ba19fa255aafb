"""Queries: search hits, consensus, taxonomy linking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.nulls import is_missing_taxon, taxon_or_label
from tidemark.functions.ranks import RANKS, cascade
from tidemark.operators import taxonomy as tx
from tidemark.plans.registry import query
from tidemark.plans.views import ctes, view

CONTAMINANTS = ("S3", "S11", "S20")
_IN = "('S3','S11','S20')"
_MISS = "('', 'na', 'nan', 'none', 'unassigned')"


def q(rank: str) -> str:
    return f'"{rank}"'


SQL_RANKS = [q(r) for r in RANKS]
ALL_RANKS = ", ".join(SQL_RANKS)


def sql_miss(c: str) -> str:
    return f"lower(trim(coalesce({c}, ''))) IN {_MISS}"


def named(df: DataFrame) -> DataFrame:
    """View columns ``class_`` and ``order_`` under their rank names."""
    return df.withColumnsRenamed({"class_": "class", "order_": "order"})


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    return named(view(spark, sf, "lineage"))


def taxa(spark: SparkSession, sf: str) -> DataFrame:
    return named(view(spark, sf, "taxa"))


def described(spark: SparkSession, sf: str) -> DataFrame:
    return tx.attach_lineage(view(spark, sf, "hits"), lineage(spark, sf))


LINEAGE = ctes("hits", "lineage") + """,
lin AS (SELECT sseqid, kingdom, phylum, class_ AS "class", order_ AS "order", family, genus,
  species FROM lineage),
described AS (SELECT h.*, kingdom, phylum, "class", "order", family, genus, species
  FROM hits h JOIN lin USING (sseqid))"""

FILTERED = LINEAGE + """,
filtered AS (SELECT qseqid, sseqid, pident, bitscore, hit_no, kingdom, phylum,
  CASE WHEN pident < 70 THEN NULL ELSE "class" END AS "class",
  CASE WHEN pident < 80 THEN NULL ELSE "order" END AS "order",
  CASE WHEN pident < 86.5 THEN NULL ELSE family END AS family,
  CASE WHEN pident < 96 THEN NULL ELSE genus END AS genus,
  CASE WHEN pident < 98 THEN NULL ELSE species END AS species FROM described)"""

BAND = FILTERED + """,
b1 AS (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS best,
  count(*) OVER (PARTITION BY qseqid) AS n FROM filtered),
b2 AS (SELECT *, max(CASE WHEN bitscore >= best * CAST(0.9 AS DOUBLE) THEN pident END)
  OVER (PARTITION BY qseqid) AS bp FROM b1),
b3 AS (SELECT *, (n = 1 OR (best > 0 AND bitscore >= best * CAST(0.9 AS DOUBLE)
  AND pident >= bp - 1)) AS in_band FROM b2)"""


def _cascade_sql() -> str:
    """Consensus of the band: agreement per rank, then first row or best row."""
    agg, merged, out = [], [], []
    for r in RANKS:
        agg.append(
            f'count(DISTINCT {q(r)}) AS "n_{r}", first({q(r)} ORDER BY hit_no) AS "h_{r}", '
            f'first({q(r)} ORDER BY bitscore DESC, hit_no) AS "t_{r}"'
        )
        merged.append(f'CASE WHEN "n_{r}" > 1 THEN NULL ELSE "h_{r}" END AS "m_{r}"')
    clash = " OR ".join(f'"n_{r}" > 1' for r in RANKS)
    for i, r in enumerate(RANKS):
        gap = " OR ".join(f'"m_{p}" IS NULL' for p in RANKS[:i]) or "FALSE"
        out.append(
            f'CASE WHEN NOT clash THEN "t_{r}" WHEN {gap} THEN NULL ELSE "m_{r}" END AS {q(r)}'
        )
    return BAND + f""",
c1 AS (SELECT qseqid, count(*) AS n_band, max(pident) AS mp, max(bitscore) AS mb,
  first(pident ORDER BY bitscore DESC, hit_no) AS tp,
  first(bitscore ORDER BY bitscore DESC, hit_no) AS tb, {', '.join(agg)}
  FROM b3 WHERE in_band GROUP BY qseqid),
c2 AS (SELECT *, ({clash}) AS clash, {', '.join(merged)} FROM c1),
resolved AS (SELECT qseqid AS asv_id, CASE WHEN clash THEN mp ELSE tp END AS pident,
  CASE WHEN clash THEN mb ELSE tb END AS bitscore, n_band, {', '.join(out)} FROM c2)"""


RESOLVED = _cascade_sql()


def _collapsed_sql() -> str:
    agg, out = [], []
    for r in RANKS:
        v = f"CASE WHEN inw AND NOT ({sql_miss(q(r))}) THEN {q(r)} END"
        agg.append(f'min({v}) AS "lo_{r}", max({v}) AS "hi_{r}"')
    for i, r in enumerate(RANKS):
        bad = " OR ".join(f'coalesce("lo_{p}" <> "hi_{p}", FALSE)' for p in RANKS[: i + 1])
        out.append(f'CASE WHEN {bad} THEN NULL ELSE "lo_{r}" END AS {q(r)}')
    return LINEAGE + f""",
w1 AS (SELECT *, max(CASE WHEN pident >= 90 THEN pident END) OVER (PARTITION BY qseqid) AS best
  FROM described),
w2 AS (SELECT *, coalesce(pident >= 90 AND pident >= best - 1, FALSE) AS inw FROM w1),
w3 AS (SELECT qseqid, coalesce(max(best), max(pident)) AS pident,
  CAST(count(CASE WHEN inw THEN 1 END) AS BIGINT) AS n_band, {', '.join(agg)} FROM w2
  GROUP BY qseqid),
resolved AS (SELECT qseqid AS asv_id, pident, n_band, {', '.join(out)} FROM w3)"""


COLLAPSED = _collapsed_sql()


@query("j1_hits_with_lineage", LINEAGE + f" SELECT qseqid, sseqid, pident, hit_no, {ALL_RANKS} FROM described")
def _(spark, sf):
    return described(spark, sf).select("qseqid", "sseqid", "pident", "hit_no", *RANKS)


@query(
    "j1_hits_without_lineage",
    ctes("hits", "lineage")
    + """ SELECT sseqid, count(*) AS n_hits FROM hits WHERE sseqid NOT IN
    (SELECT sseqid FROM lineage WHERE sseqid <> 'REF3') GROUP BY sseqid""",
)
def _(spark, sf):
    known = view(spark, sf, "lineage").where("sseqid <> 'REF3'")
    return tx.hits_without_lineage(view(spark, sf, "hits"), known)


@query(
    "w1_hit_rank_in_file_order",
    ctes("hits")
    + """ SELECT qseqid, hit_no, row_number() OVER (PARTITION BY qseqid ORDER BY hit_no)
    AS blast_rank FROM hits""",
)
def _(spark, sf):
    return tx.hit_ranks(view(spark, sf, "hits")).select("qseqid", "hit_no", "blast_rank")


@query("p7_identity_cascade", FILTERED + " SELECT * FROM filtered")
def _(spark, sf):
    df = tx.filter_identity(described(spark, sf))
    return df.select("qseqid", "sseqid", "pident", "bitscore", "hit_no", *RANKS)


@query(
    "w2_band_hits",
    BAND
    + """ SELECT qseqid, bitscore, pident, count(*) AS n_hits, min(hit_no) AS first_no, in_band
    FROM b3 GROUP BY qseqid, bitscore, pident, in_band""",
)
def _(spark, sf):
    levels = tx.in_band_levels(tx.filter_identity(described(spark, sf)))
    return levels.select(
        "qseqid",
        "bitscore",
        "pident",
        F.col("_n").alias("n_hits"),
        F.col("_first_no").alias("first_no"),
        F.col("_in_band").alias("in_band"),
    )


@query(
    "w8_best_hits_per_query",
    ctes("hits")
    + """ SELECT qseqid, sseqid, bitscore, pident, hit_no, target_no FROM (SELECT *,
    row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, pident DESC, sseqid, hit_no)
    AS target_no FROM hits) WHERE target_no <= 5""",
)
def _(spark, sf):
    df = tx.best_hits(view(spark, sf, "hits"), 5)
    return df.select("qseqid", "sseqid", "bitscore", "pident", "hit_no", "target_no")


@query("a4_lca_cascade", RESOLVED + " SELECT * FROM resolved")
def _(spark, sf):
    return tx.resolve_cascade(tx.filter_identity(described(spark, sf)))


@query("a5_lca_collapsed", COLLAPSED + " SELECT * FROM resolved")
def _(spark, sf):
    return tx.resolve_collapsed(described(spark, sf))


_FILL = ", ".join(f"coalesce({r}, 'Unassigned') AS {r}" for r in SQL_RANKS)


def _features_cte(sql: str) -> str:
    from tidemark.plans.views import VIEWS

    return sql + f", features AS ({VIEWS['features'].format(part='part')})"


@query(
    "j3_fill_unassigned",
    _features_cte(RESOLVED)
    + f" SELECT asv_id, sequence, pident, {_FILL} FROM features LEFT JOIN resolved USING (asv_id)",
)
def _(spark, sf):
    resolved = tx.resolve_cascade(tx.filter_identity(described(spark, sf)))
    return tx.fill_unassigned(view(spark, sf, "features").select("asv_id", "sequence"), resolved)


@query(
    "a6_assign_from_hits",
    _features_cte(RESOLVED)
    + f""" SELECT asv_id, sequence, pident, {_FILL}, coalesce(species IN {_IN}, FALSE)
    AS is_contaminant_candidate FROM features LEFT JOIN resolved USING (asv_id)""",
)
def _(spark, sf):
    return tx.assign_from_hits(
        view(spark, sf, "features").select("asv_id", "sequence"),
        view(spark, sf, "hits"),
        lineage(spark, sf),
        contaminants=CONTAMINANTS,
    )


@query(
    "a6_assignment_guards",
    _features_cte(COLLAPSED)
    + """ SELECT count(CASE WHEN pident >= 96 AND genus IS NULL THEN 1 END)
    AS n_collapsed_below_genus, count(CASE WHEN kingdom IS NULL AND phylum IS NULL AND "class" IS
    NULL AND "order" IS NULL AND family IS NULL AND genus IS NULL AND species IS NULL AND pident IS
    NOT NULL THEN 1 END) AS n_below_floor,
    (SELECT count(*) FROM features WHERE asv_id NOT IN (SELECT asv_id FROM resolved))
    AS n_without_hits FROM resolved""",
)
def _(spark, sf):
    resolved = tx.resolve_collapsed(described(spark, sf))
    return tx.assignment_guards(view(spark, sf, "features"), resolved)


@query(
    "j2_counts_with_queries",
    ctes("counts", "features")
    + """ SELECT f.sequence, f.asv_id, c.total FROM (SELECT asv_id AS a, CAST(sum(reads) AS BIGINT)
    AS total FROM counts GROUP BY asv_id) c JOIN features f ON f.asv_id = c.a""",
)
def _(spark, sf):
    features = view(spark, sf, "features").select("asv_id", "sequence")
    totals = view(spark, sf, "counts").groupBy("asv_id").agg(F.sum("reads").alias("total"))
    counted = totals.join(features, "asv_id").select("sequence", "total")
    return tx.match_queries(counted, features)


@query(
    "j2_match_losses",
    ctes("features")
    + """ SELECT count(CASE WHEN otu % 10 <> 3 AND otu % 7 <> 2 THEN 1 END) AS n_shared,
    count(CASE WHEN otu % 10 <> 3 AND otu % 7 = 2 THEN 1 END) AS n_counts_only,
    count(CASE WHEN otu % 10 = 3 AND otu % 7 <> 2 THEN 1 END) AS n_fasta_only FROM features""",
)
def _(spark, sf):
    features = view(spark, sf, "features")
    return tx.match_losses(features.where("otu % 10 <> 3"), features.where("otu % 7 <> 2"))


def _link_sql(ranks=RANKS, names=CONTAMINANTS) -> str:
    norm, out = [], []
    for r, v in zip(RANKS, ("kingdom", "phylum", "class_", "order_", "family", "genus", "species")):
        norm.append(f"CASE WHEN {sql_miss('t.' + v)} THEN 'Unassigned' ELSE t.{v} END AS {q(r)}")
    for r in RANKS:
        i = ranks.index(r) if r in ranks else -1
        gap = " OR ".join(f"{q(p)} = 'Unassigned'" for p in ranks[: max(i, 0)]) or "FALSE"
        out.append(f"CASE WHEN {gap} THEN 'Unassigned' ELSE {q(r)} END AS {q(r)}")
    hit = " OR ".join(f"list_contains(string_split(species, '/'), '{n}')" for n in names)
    return ctes("features", "taxa") + f""",
l1 AS (SELECT f.asv_id, f.sequence, t.confidence AS pident, {', '.join(norm)}
  FROM features f LEFT JOIN taxa t USING (sequence)),
l2 AS (SELECT asv_id, sequence, pident, {', '.join(out)} FROM l1),
linked AS (SELECT *, ({hit}) AS is_contaminant_candidate FROM l2)"""


LINKED = _link_sql()


def linked(spark, sf):
    taxonomy = taxa(spark, sf).select("sequence", "confidence", *RANKS)
    features = view(spark, sf, "features").select("asv_id", "sequence")
    return tx.link_taxonomy(
        features, taxonomy, contaminants=CONTAMINANTS, pident_col="confidence"
    )


@query("j4_link_taxonomy", LINKED + " SELECT * FROM linked")
def _(spark, sf):
    return linked(spark, sf)


_ECO = _link_sql(("order", "family", "genus", "species"))


@query("p6_cascade_fine_ranks_only", _ECO + " SELECT * FROM linked")
def _(spark, sf):
    taxonomy = taxa(spark, sf).select("sequence", "confidence", *RANKS)
    return tx.link_taxonomy(
        view(spark, sf, "features").select("asv_id", "sequence"),
        taxonomy,
        cascade_ranks=("order", "family", "genus", "species"),
        contaminants=CONTAMINANTS,
        pident_col="confidence",
    )


@query(
    "j4_duplicate_sequences",
    ctes("reads") + " SELECT sequence, count(*) AS n_rows FROM reads GROUP BY sequence HAVING count(*) > 1",
)
def _(spark, sf):
    return tx.duplicate_sequences(view(spark, sf, "reads"))


_P5 = ", ".join(
    f"({sql_miss(v)}) AS miss_{r}, CASE WHEN {sql_miss(v)} THEN 'Unassigned' ELSE {v} END AS norm_{r}"
    for r, v in (("order", "order_"), ("family", "family"), ("species", "species"))
)


@query("p5_missing_taxon", ctes("taxa") + f" SELECT asv_id, {_P5} FROM taxa")
def _(spark, sf):
    df = taxa(spark, sf)
    cols = []
    for r in ("order", "family", "species"):
        cols += [is_missing_taxon(f"`{r}`").alias(f"miss_{r}"), taxon_or_label(f"`{r}`").alias(f"norm_{r}")]
    return df.select("asv_id", *cols)


_CASC = ", ".join(
    "CASE WHEN {gap} THEN 'Unassigned' ELSE {c} END AS {r}".format(
        gap=" OR ".join(sql_miss(p) for p in ("kingdom", "phylum", "class_", "order_", "family", "genus", "species")[: i + 1]),
        c=c,
        r=q(r),
    )
    for i, (r, c) in enumerate(
        zip(RANKS, ("kingdom", "phylum", "class_", "order_", "family", "genus", "species"))
    )
)


@query("p6_rank_cascade", ctes("taxa") + f" SELECT asv_id, {_CASC} FROM taxa")
def _(spark, sf):
    df = taxa(spark, sf).select("asv_id", *RANKS)
    return cascade(df, is_missing_taxon, F.lit("Unassigned"))


@query(
    "p8_contaminant_exact",
    ctes("taxa") + f" SELECT asv_id, species, coalesce(species IN {_IN}, FALSE) AS is_contaminant_candidate FROM taxa",
)
def _(spark, sf):
    return tx.flag_contaminants(taxa(spark, sf).select("asv_id", "species"), CONTAMINANTS)


@query(
    "p8_contaminant_components",
    ctes("taxa")
    + """ SELECT asv_id, species, coalesce(list_has_any(string_split(species, '/'),
    ['S3','S11','S20']), FALSE) AS is_contaminant_candidate FROM taxa""",
)
def _(spark, sf):
    return tx.flag_contaminants(taxa(spark, sf).select("asv_id", "species"), CONTAMINANTS, parts=True)


@query(
    "p8_contaminant_counts",
    ctes("taxa")
    + f""", parts AS (SELECT unnest(string_split(species, '/')) AS species FROM taxa)
    SELECT species, count(*) AS n_features FROM parts WHERE species IN {_IN} GROUP BY species""",
)
def _(spark, sf):
    return tx.contaminant_counts(taxa(spark, sf), CONTAMINANTS)
