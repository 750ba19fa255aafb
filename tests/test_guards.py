"""Inputs that must fail or must not be counted twice, long chains, and greedy collapsing."""

import pytest
from test_tables import PROJECT, counts, manifest, occurrences, sample_meta

from tidemark.operators import cleaning as cl
from tidemark.operators import darwincore as dw
from tidemark.operators import denoise as dn
from tidemark.operators import taxonomy as tx
from tidemark.operators.clustering import propagate_lowest
from tidemark.functions.ranks import RANKS
from tidemark.operators.tags import demultiplex


def failing(df, text):
    with pytest.raises(Exception, match=text):
        df.collect()


def test_a_sample_in_two_runs_counts_once(spark):
    earlier = [("S1", "negative control", "PCR negative", None), ("S2", "sample", None, "E9")]
    twice = spark.createDataFrame(earlier, manifest(spark).schema).coalesce(1).union(manifest(spark).coalesce(1)).coalesce(1)
    once, both = (cl.clean_counts(counts(spark), m, "subtract") for m in (manifest(spark), twice))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(once) == key(both)
    for run in (cl.cleaning_report, cl.cleaning_summary):
        assert key(run(counts(spark), twice, "subtract")) == key(run(counts(spark), manifest(spark), "subtract"))
    assert cl.sample_roles(counts(spark), twice).count() == 5


def test_a_hit_without_lineage_fails(spark):
    ranks = ", ".join(f"`{r}` string" for r in RANKS)
    lineage = spark.createDataFrame([("ref1", *"abcdefg")], f"sseqid string, {ranks}")
    hits = spark.createDataFrame([("q", "ref1"), ("q", "ref2")], "qseqid string, sseqid string")
    failing(tx.attach_lineage(hits, lineage), "ref2")
    assert tx.attach_lineage(hits.where("sseqid = 'ref1'"), lineage).count() == 1
    assert [r["sseqid"] for r in tx.hits_without_lineage(hits, lineage).collect()] == ["ref2"]


def test_records_refuse_bad_metadata(spark):
    meta = sample_meta(spark)
    failing(dw.darwin_core_records(occurrences(spark), meta.union(sample_meta(spark, "dar_2025.1")), PROJECT), "several metadata rows")
    failing(dw.darwin_core_records(occurrences(spark), sample_meta(spark, "other"), PROJECT), "matches no occurrence")
    failing(dw.darwin_core_records(occurrences(spark), sample_meta(spark, medium="lava"), PROJECT), "lava")
    report = dw.match_report(occurrences(spark), meta.union(sample_meta(spark, "dar_2025.1"))).first()
    assert (report.n_matched, report.n_duplicate_keys) == (1, 1)
    assert dw.darwin_core_records(occurrences(spark).limit(0), meta, PROJECT).count() == 0


def test_labels_along_a_long_chain(spark):
    n = 3000
    nodes = spark.range(1, n + 1).toDF("rank")
    edges = spark.range(1, n).selectExpr("id AS src", "id + 1 AS dst")
    labels = propagate_lowest(nodes, edges)
    assert labels.count() == n and [r[0] for r in labels.select("label").distinct().collect()] == [1]


def test_collapse_compares_with_kept_sequences_only(spark):
    b = "ACGTTGCAACGGTTAACCGGTATCGA"
    rows = [("s", "TTT" + b, 100), ("s", b, 50), ("s", b + "GGG", 10), ("t", b, 5)]
    out = dn.collapse_contained(spark.createDataFrame(rows, "sample string, sequence string, reads long"))
    assert {(r["sample"], r["sequence"]): r["reads"] for r in out.collect()} == {
        ("s", "TTT" + b): 150, ("t", "TTT" + b): 5, ("s", b + "GGG"): 10,
    }


def test_a_tag_of_any_length_is_found(spark):
    tag = "ACGTTGCA" * 9
    pairs = spark.createDataFrame(
        [("L", tag + "AAAA", "I" * 76, tag + "CCCC", "I" * 76)], "library string, r1_seq string, r1_qual string, r2_seq string, r2_qual string"
    )
    tags = spark.createDataFrame([("L", "S1", tag)], "library string, sample string, tag string")
    row = demultiplex(pairs, tags).first()
    assert (row["sample"], row["r1_seq"], row["r2_seq"]) == ("S1", "AAAA", "CCCC")
