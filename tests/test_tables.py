"""Cleaning, occurrences, Darwin Core, manifest, dates and tracking on small inputs."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.controls import classify_control
from tidemark.functions.ranks import RANKS
from tidemark.functions.text import event_key
from tidemark.operators import cleaning as cl
from tidemark.operators import darwincore as dw
from tidemark.operators import manifest as mf
from tidemark.operators import occurrence as oc
from tidemark.operators import tracking as tr
from tidemark.operators.dates import normalise_dates, refuse_bad_dates

TAX = ", ".join(f"`{r}` string" for r in RANKS)
FISH = ("Metazoa", "Chordata", "Actinopteri", "Perciformes", "Percidae", "Perca", "Perca_fluviatilis")
HUMAN = ("Metazoa", "Chordata", "Mammalia", "Primates", "Hominidae", "Homo", "Homo_sapiens")
PROJECT = {"marker": "Teleo", "recordedby": "me", "identificationRemarks": "x", "identificationReferences": "y", "otu_db": "db"}


@pytest.mark.parametrize(
    "name, rule, category",
    [
        ("Blank-ext-2run2", "blank-ext", "negative control"),
        (" blank PCR", "blank-pcr", "negative control"),
        ("EXT_NC", "ext-nc", "negative control"),
        ("CNEG01_03", "cneg", "negative control"),
        ("mock1", "positive", "positive control"),
        ("water_001", "unclassified-control-like", "sample"),
        ("DAR-2025-1", "sample", "sample"),
        (None, "sample", "sample"),
    ],
)
def test_control_names(spark, name, rule, category):
    df = spark.createDataFrame([(name,)], "n string").select(classify_control("n").alias("c"))
    assert df.select("c.rule", "c.samp_category").first() == (rule, category)


def counts(spark):
    rows = [("o1", "S1", 10), ("o1", "S2", 5), ("o1", "Bext1", 3), ("o2", "S1", 7), ("o2", "S3", 2), ("o2", "Bpcr1", 1), ("o3", "S1", 4), ("o3", "S3", 9)]
    return spark.createDataFrame(rows, "asv_id string, eventID string, reads long")


def manifest(spark):
    neg = "negative control"
    rows = [("S1", "sample", None, "E1"), ("S2", "sample", None, "E1"), ("S3", "sample", None, "E2"),
            ("Bext1", neg, "extraction negative", "E1"), ("Bpcr1", neg, "PCR negative", None)]
    return spark.createDataFrame(rows, "eventID string, samp_category string, neg_cont_type string, extraction_ID string")


def test_blanks_clean_their_batch_or_everything(spark):
    out = {(r.asv_id, r.eventID): r.reads for r in cl.clean_counts(counts(spark), manifest(spark), "subtract").collect()}
    assert out["o1", "S1"] == out["o1", "S2"] == out["o2", "S1"] == out["o2", "S3"] == 0
    assert out["o3", "S1"] == 4 and out["o1", "Bext1"] == 3
    report = {r.eventID: r for r in cl.cleaning_report(counts(spark), manifest(spark), "flag").collect()}
    assert report["S1"].reads_after == 21 and report["S1"].n_reads_removed == 17
    assert report["S1"].driving_controls == "Bpcr1|Bext1" and report["S3"].driving_controls == "Bpcr1"
    assert cl.cleaning_summary(counts(spark), manifest(spark), "flag").first().total_reads_removed == 0
    with pytest.raises(ValueError):
        cl.clean_counts(counts(spark), manifest(spark), "wipe")


def test_no_controls_clean_nothing(spark):
    only = counts(spark).where("eventID LIKE 'S%'")
    assert not cl.removed_pairs(only, cl.sample_roles(only, manifest(spark))).where("removed").count()
    row = cl.cleaning_report(only, manifest(spark), "subtract").first()
    assert row.driving_controls == "" and row.reads_before == row.reads_after


def occurrences(spark):
    rows = [(*FISH, "Perca_fluviatilis", "species", "acgt", 10, "DAR.2025.1"), (*HUMAN, "Homo_sapiens", "species", "ggtt", 4, "DAR.2025.1"),
            (*FISH, "Perca_fluviatilis", "species", "acgt", 2, "Blank-PCR-1")]
    return spark.createDataFrame(rows, TAX + ", taxon string, rank string, sequence string, nb_reads long, eventID string")


def sample_meta(spark, event="DAR-2025-1", medium="water"):
    return spark.createDataFrame(
        [(event, "2025.08.19", medium, 46.0, 7.0, 1.0, "0.45", "15")],
        "eventID string, eventDate string, env_medium string, decimalLatitude double, decimalLongitude double, depth double, size_frac string, samp_size string",
    )


def test_darwin_core_row(spark):
    out = dw.darwin_core_records(occurrences(spark), sample_meta(spark), PROJECT)
    assert len(out.columns) == 39
    row = out.where("organismQuantity = 10").first()
    assert row.eventID == "DAR-2025-1" and row.DNA_sequence == "ACGT" and row.kingdom == ""
    assert row.env_medium == "liquid water [ENVO_00002006]" and row.target_gene == "12S"
    assert row.occurrenceID.startswith("Teleo:DAR-2025-1:") and len(row.occurrenceID.split(":")[-1]) == 8
    # the marker's case decides the deny-list, so human reads stay under "Teleo" and count
    assert row.sampleSizeValue == 14 and out.count() == 2
    assert dw.darwin_core_records(occurrences(spark), sample_meta(spark), {**PROJECT, "marker": "teleo"}).count() == 1
    dw.check_records(out)
    with pytest.raises(ValueError):
        dw.check_records(dw.darwin_core_records(occurrences(spark), sample_meta(spark), {**PROJECT, "otu_db": ""}))
    with pytest.raises(ValueError):
        dw.check_records(out.limit(0))
    with pytest.raises(ValueError):
        dw.darwin_core_records(occurrences(spark), sample_meta(spark), {**PROJECT, "marker": "nosuch"})


def test_configured_values_win(spark):
    assert dw.prefer_config("A", "B") == ("A", True) and dw.prefer_config(None, "B") == ("B", False)
    out = dw.darwin_core_records(occurrences(spark), sample_meta(spark), PROJECT, otu_db="conf")
    assert out.first().otu_db == "conf"


def test_metadata_checks(spark):
    bad = sample_meta(spark, medium="lava").withColumn("decimalLatitude", F.lit(120.0))
    found = {r["check"]: r.n_rows for r in dw.sample_metadata_violations(bad).collect()}
    assert found == {"unknown env_medium": 1, "decimalLatitude out of range": 1}
    with pytest.raises(ValueError):
        dw.sample_metadata_violations(bad.drop("env_medium"))
    assert dw.project_metadata_violations({**PROJECT, "recordedby": ""}) == ["recordedby"]
    assert oc.duplicate_event_keys(sample_meta(spark).union(sample_meta(spark, "dar_2025.1"))).count() == 1
    assert oc.metadata_match_rate(oc.join_sample_metadata(occurrences(spark), sample_meta(spark))).first().n_matched == 2


def test_event_key(spark):
    df = spark.createDataFrame([(" dar.2023__25- ",), (None,)], "e string")
    assert [r[0] for r in df.select(event_key("e")).collect()] == ["DAR-2023-25", ""]


def test_ranks_of_occurrences(spark):
    rows = [(*FISH[:6], "A/B"), (*FISH[:5], None, None), (*FISH[:3], None, None, None, None)]
    out = [(r["rank"], r["taxon"], r["species"]) for r in oc.label_taxa(spark.createDataFrame(rows, TAX)).collect()]
    assert out == [("genus", "Perca", None), ("family", "Percidae", None), ("higher", "Actinopteri", None)]


def test_wide_table_needs_samples_and_columns(spark):
    wide = spark.createDataFrame([(*FISH, "ACGT", "x")], TAX + ", sequence string, note string")
    with pytest.raises(ValueError):
        oc.occurrences_from_wide(wide)
    with pytest.raises(ValueError):
        oc.standard_schema(wide.drop("genus"))
    with pytest.raises(ValueError):
        oc.ecotag_schema(wide)


def dates(spark, *tokens, **kw):
    df = spark.createDataFrame([("f", t) for t in tokens], "file string, d string")
    return {r.token: r.iso or r.error for r in normalise_dates(df, "d", "file", **kw).collect()}


def test_dates_take_their_order_from_the_file(spark):
    assert dates(spark, "25.03.2024", "04.05.2024") == {"25.03.2024": "2024-03-25", "04.05.2024": "2024-05-04"}
    assert dates(spark, "03/25/2024 10:00", "NA")["03/25/2024 10:00"] == "2024-03-25"
    assert dates(spark, "2024.31.01")["2024.31.01"] == "2024-01-31"
    assert "ambiguous" in dates(spark, "04.05.2024")["04.05.2024"]
    assert dates(spark, "04.05.2024", order="MDY")["04.05.2024"] == "2024-04-05"
    assert "contradictory" in dates(spark, "25.03.2024", "03.25.2024")["25.03.2024"]
    assert "mixes" in dates(spark, "25.03.2024", "2024.03.25")["25.03.2024"]
    assert "unrecognised" in dates(spark, "25.03.24")["25.03.24"]
    assert dates(spark, "2024", "2024-05", "05.2024") == {"2024": "2024", "2024-05": "2024-05", "05.2024": "2024-05"}
    with pytest.raises(ValueError):
        dates(spark, "2024", order="XYZ")
    with pytest.raises(ValueError):
        refuse_bad_dates(normalise_dates(spark.createDataFrame([("f", "spring")], "file string, d string"), "d", "file"))


def errors(spark, **row):
    base = {"eventID": "S1", "seq_run_id": "r", "samp_category": "sample", **row}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))
    return mf.validate_manifest(df).first().errors


@pytest.mark.parametrize(
    "row, part",
    [
        ({"eventDate": "2024-02-30"}, "calendar"),
        ({"eventDate": "2024-13"}, "month"),
        ({"eventDate": "2024.01.01"}, "ISO"),
        ({"samp_category": "negative control"}, "neg_cont_type"),
        ({"samp_category": "positive control"}, "pos_cont_type"),
        ({"samp_category": "thing"}, "vocabulary"),
        ({"decimalLatitude": "91"}, "above"),
        ({"samp_size": "-1"}, "below"),
        ({"reads_raw": "x"}, "count"),
        ({"seq_run_id": "NA"}, "required"),
    ],
)
def test_manifest_faults(spark, row, part):
    assert any(part in e for e in errors(spark, **row))


def test_manifest_accepts(spark):
    assert errors(spark, eventDate="2024-05", maximumDepthInMeters="-840", samp_category="other: pool") == []
    with pytest.raises(ValueError):
        errors(spark, typo="x")
    good = spark.createDataFrame([("S1", "r", "sample")] * 2, "eventID string, seq_run_id string, samp_category string")
    with pytest.raises(ValueError):
        mf.load_rows(good)
    assert mf.load_rows(good.limit(1)).count() == 1


def test_unresolved_tag_columns():
    assert mf.unresolved_tag_columns(["eventID", "library", "tag_demultiplex", "barcode3", "pcr_primer_tag"]) == ["barcode3"]


def test_missing_count_is_null_not_zero(spark):
    trim = spark.createDataFrame([("a", 100, None), ("b", 50, 40)], "sample string, raw long, trimmed long")
    track = spark.createDataFrame([("a", 90, 80, 70, 60, 10)], "sample string, input long, filtered long, denoised long, merged long, nonchim long")
    table = tr.assemble_tracking(trim, track)
    rows = {r["sample"]: r for r in table.collect()}
    assert rows["a"].trimmed == 90 and rows["a"].pct_retained == 10.0
    assert rows["b"].nonchim is None and rows["b"].pct_retained is None
    kinds = {(r["sample"], r.kind) for r in tr.tracking_warnings(table).collect()}
    assert ("b", "absent") in kinds and ("a", "low retention") in kinds and ("a", "step loss") in kinds
    empty = tr.trim_loss(trim.where("sample = 'a'")).first()
    assert empty.loss_pct is None
    with pytest.raises(ValueError):
        tr.assemble_tracking(trim)
