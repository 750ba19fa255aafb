import pytest
from pyspark.sql import functions as F

from tidemark.functions.ranks import RANKS
from tidemark.operators import taxonomy as tx

HIT = "qseqid string, sseqid string, pident double, bitscore double, hit_no long"
PERCH = ("Metazoa", "Chordata", "Actinopteri", "Perciformes", "Percidae", "Perca", "Perca_fluviatilis")
PIKE = ("Metazoa", "Chordata", "Actinopteri", "Perciformes", "Percidae", "Sander", "Sander_lucioperca")
WORM = ("Metazoa", "Annelida", "Clitellata", None, "Naididae", "Tubifex", "Tubifex_tubifex")
HOLEY = ("Metazoa", "Chordata", "Actinopteri", None, "Percidae", "Perca", "Perca_fluviatilis")


def lineage(spark):
    rows = [("perch", *PERCH), ("pike", *PIKE), ("worm", *WORM), ("holey", *HOLEY)]
    return spark.createDataFrame(rows, "sseqid string, " + ", ".join(f"`{r}` string" for r in RANKS))


def resolve(spark, *hits, **params):
    df = spark.createDataFrame([("q", *h, i + 1) for i, h in enumerate(hits)], HIT)
    described = tx.filter_identity(tx.attach_lineage(df, lineage(spark)))
    rows = tx.resolve_cascade(described, **params).collect()
    return rows[0] if rows else None


def ranks(row):
    return tuple(row[r] for r in RANKS)


def test_single_hit_is_kept_even_without_score(spark):
    row = resolve(spark, ("perch", 99.0, -5.0))
    assert ranks(row) == PERCH and row.pident == 99.0


def test_disagreement_stops_at_the_common_rank(spark):
    row = resolve(spark, ("perch", 100.0, 120.0), ("pike", 99.5, 119.0))
    assert ranks(row) == (*PERCH[:5], None, None)
    assert row.pident == 100.0 and row.bitscore == 120.0


def test_far_identity_does_not_collapse(spark):
    row = resolve(spark, ("perch", 100.0, 120.0), ("worm", 98.6, 118.0))
    assert ranks(row) == PERCH
    without_floor = resolve(spark, ("perch", 100.0, 120.0), ("worm", 98.6, 118.0), lca_pident_delta=0)
    assert ranks(without_floor) == ("Metazoa", None, None, None, None, None, None)


def test_null_never_disagrees_and_best_hit_keeps_its_gaps(spark):
    row = resolve(spark, ("perch", 100.0, 119.0), ("holey", 100.0, 120.0))
    assert ranks(row) == HOLEY


def test_no_positive_score_leaves_the_query_out(spark):
    assert resolve(spark, ("perch", 100.0, 0.0), ("pike", 100.0, -1.0)) is None


def test_low_identity_nulls_fine_ranks(spark):
    row = resolve(spark, ("perch", 90.0, 100.0))
    assert ranks(row) == (*PERCH[:5], None, None)


def collapsed(spark, *hits, **params):
    df = spark.createDataFrame([("q", *h, i + 1) for i, h in enumerate(hits)], HIT)
    return tx.resolve_collapsed(tx.attach_lineage(df, lineage(spark)), **params).first()


def test_collapsed_fills_a_rank_from_any_hit(spark):
    row = collapsed(spark, ("holey", 99.0, 1.0), ("perch", 98.5, 1.0))
    assert ranks(row) == PERCH


def test_collapsed_below_the_floor_is_unassigned_with_its_identity(spark):
    row = collapsed(spark, ("perch", 80.0, 1.0), ("pike", 85.0, 1.0))
    assert ranks(row) == (None,) * 7 and row.pident == 85.0


def test_collapsed_rejects_bad_parameters(spark):
    with pytest.raises(ValueError):
        tx.resolve_collapsed(spark.createDataFrame([], HIT), lca_pid=101)


def test_every_feature_survives_and_contaminants_are_flagged(spark):
    features = spark.createDataFrame([("OTU_1", "A"), ("OTU_2", "C")], "asv_id string, sequence string")
    hits = spark.createDataFrame([("OTU_1", "perch", 100.0, 50.0, 1)], HIT)
    out = tx.assign_from_hits(features, hits, lineage(spark), contaminants=["Perca_fluviatilis"])
    rows = {r.asv_id: r for r in out.collect()}
    assert ranks(rows["OTU_2"]) == ("Unassigned",) * 7 and rows["OTU_2"].pident is None
    assert rows["OTU_1"].is_contaminant_candidate and not rows["OTU_2"].is_contaminant_candidate


def test_link_taxonomy_cascades_and_matches_components(spark):
    features = spark.createDataFrame([("OTU_1", "A"), ("OTU_2", "C"), ("OTU_3", "G")], "asv_id string, sequence string")
    rows = [("A", "M", "Ch", " NA ", "Per", "Fam", "Gen", "Sp"), ("C", "M", "Ch", "Ac", "Per", "Fam", "Gen", "X/Bos")]
    taxonomy = spark.createDataFrame(rows, "Seq string, " + ", ".join(f"`{r}` string" for r in RANKS))
    out = {r.asv_id: r for r in tx.link_taxonomy(features, taxonomy, contaminants=["Bos"]).collect()}
    assert ranks(out["OTU_1"]) == ("M", "Ch", *("Unassigned",) * 5)
    assert out["OTU_2"].is_contaminant_candidate and out["OTU_3"].kingdom == "Unassigned"
    with pytest.raises(ValueError):
        tx.link_taxonomy(features, taxonomy.withColumnRenamed("Seq", "other"))


def test_band_agrees_with_plain_python_on_random_hits(spark):
    import random

    rnd = random.Random(7)
    pool = {"perch": PERCH, "pike": PIKE, "worm": WORM, "holey": HOLEY}
    limits = {"class": 70, "order": 80, "family": 86.5, "genus": 96, "species": 98}
    hits = []
    for q in range(150):
        for i in range(rnd.randrange(1, 7)):
            hits.append((f"q{q}", rnd.choice(list(pool)), rnd.choice([100.0, 99.5, 98.2, 97.0, 88.0, 75.0]), float(rnd.choice([0, 90, 99, 100])), i))
    df = tx.filter_identity(tx.attach_lineage(spark.createDataFrame(hits, HIT), lineage(spark)))
    got = {r.asv_id: (ranks(r), r.pident) for r in tx.resolve_cascade(df).collect()}
    want = {}
    for q in {h[0] for h in hits}:
        rows = []
        for _, ref, pid, bit, no in sorted((h for h in hits if h[0] == q), key=lambda h: h[4]):
            tax = [v if r not in limits or pid >= limits[r] else None for r, v in zip(RANKS, pool[ref])]
            rows.append((tax, pid, bit))
        best = max(r[2] for r in rows)
        if len(rows) == 1:
            want[q] = (tuple(rows[0][0]), rows[0][1])
            continue
        if best <= 0:
            continue
        near = [r for r in rows if r[2] >= best * 0.9]
        top = max(r[1] for r in near)
        near = [r for r in near if r[1] >= top - 1]
        clash = [len({r[0][k] for r in near} - {None}) > 1 for k in range(7)]
        if not any(clash):
            chosen = max(near, key=lambda r: r[2])
            want[q] = (tuple(chosen[0]), chosen[1])
            continue
        tax = [None if c else v for c, v in zip(clash, near[0][0])]
        gap = next((k for k in range(7) if tax[k] is None), 7)
        want[q] = (tuple(v if k < gap else None for k, v in enumerate(tax)), top)
    assert got == want


def test_feature_numbers_sort_ids(spark):
    df = spark.createDataFrame([("OTU_10",), ("OTU_9",)], "asv_id string")
    assert [r[0] for r in df.orderBy(tx.feature_number("asv_id")).collect()] == ["OTU_9", "OTU_10"]
    assert df.select(F.max(tx.feature_number("asv_id"))).first()[0] == 10
