"""File scans on real files."""

import gzip
import os

import pytest

from tidemark.operators.features import otu_table, without_chimeras
from tidemark.sources import clusters, fastq, logs, sequences, tables
from tidemark.streaming import live_tracking as live


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_fasta_joins_wrapped_lines_and_allows_marks_in_headers(spark, tmp_path):
    path = put(tmp_path / "a.fasta", ">s1 first > one\r\nAC GT\r\nTT\n>s2\nGG\n")
    rows = {r.id: r for r in sequences.read_fasta(spark, path, description=True).collect()}
    assert rows["s1"].sequence == "ACGTTT" and rows["s1"].description == "s1 first > one" and rows["s2"].sequence == "GG"
    with pytest.raises(ValueError):
        sequences.require_records(sequences.read_fasta(spark, put(tmp_path / "e.fasta", "")), "the file")


def test_reference_headers(spark, tmp_path):
    text = ">r1\tM;C;A;NA;P;G;S\nACGT\n>r2\tM;C\nA\n>r1\tM;C;A;O;P;G;S2 \nT\n"
    df = sequences.read_reference_lineages(spark, put(tmp_path / "r.fasta", text))
    rows = {r.sseqid: r for r in df.collect()}
    assert rows["r1"].order == "O" and rows["r1"].species == "S2"
    assert [r.sseqid for r in sequences.incomplete_lineages(df).collect()] == ["r2"]


def test_empty_hits_keep_the_schema(spark, tmp_path):
    df = tables.read_hits(spark, put(tmp_path / "h.tsv", ""))
    assert df.count() == 0 and df.columns[-1] == "hit_no" and len(df.columns) == 13


def test_otu_table_counts_are_not_zero(spark, tmp_path):
    stats = clusters.read_cluster_stats(spark, put(tmp_path / "s.stats", "2\t9\tAA;size=7\t7\t0\t1\t1\n1\t4\tBB;size=4\t4\t0\t0\t0\nx\n"))
    members = clusters.read_cluster_members(spark, put(tmp_path / "s.swarm", "AA;size=7; CC;size=2;\nBB_4\n\n"))
    put(tmp_path / "d" / "S1.fasta", ">AA;size=5;\nACGT\n>CC;size=2\nACGA\n>ZZ\nT\n")
    put(tmp_path / "d" / "S2.fasta", ">AA;size=2;\nACGT\n>BB;size=4;\nGGGG\n")
    sizes = sequences.read_sample_amplicons(spark, str(tmp_path / "d"))
    calls = clusters.read_chimera_calls(spark, put(tmp_path / "u", "\t".join(["0", "BB;size=4"] + ["*"] * 15 + ["Y"]) + "\n\nbroken\n"))
    assert clusters.unreadable_chimera_lines(spark, str(tmp_path / "u")).count() == 1
    reps = spark.createDataFrame([("AA", "ACGT"), ("BB", "GGGG")], "seed string, sequence string")
    features, counts = otu_table(stats, members, reps, sizes, calls)
    rows = {r.amplicon: r for r in features.collect()}
    assert rows["AA"].OTU == 1 and rows["AA"].spread == 2 and rows["AA"].chimera == "NA"
    got = {(r.OTU, r["sample"]): r.reads for r in counts.collect()}
    assert got == {(1, "S1"): 7, (1, "S2"): 2, (2, "S2"): 4}
    assert [r.amplicon for r in without_chimeras(features).collect()] == ["AA"]


def test_counts_matrix_keeps_file_order(spark, tmp_path):
    path = put(tmp_path / "m.csv", ",S1,S2\nTTTT,1,x\nAAAA,0,5\n")
    long, samples = tables.read_counts_matrix(spark, path)
    assert samples == ["S1", "S2"]
    assert {r["sample"]: r.clustered for r in tables.clustered_reads(long).collect()} == {"S1": 1, "S2": 5}
    ids = tables.number_features(long.select("row_no", "sequence").distinct())
    assert {r.sequence: r.asv_id for r in ids.collect()} == {"TTTT": "OTU_1", "AAAA": "OTU_2"}


def test_step_counts_may_be_missing(spark, tmp_path):
    assert tables.read_step_counts(spark, str(tmp_path / "none.csv")) is None
    assert tables.read_step_counts(spark, put(tmp_path / "b.csv", "x,y\n1,2\n")) is None
    assert tables.read_step_counts(spark, put(tmp_path / "c.csv", "sample,input\na,5\n")).first().input == 5


@pytest.mark.parametrize("sep", [",", ";"])
def test_tag_table_delimiter(spark, tmp_path, sep):
    path = put(tmp_path / "t.csv", f"eventID{sep}tag{sep}library\nS1{sep}acgt{sep}L\n")
    assert tables.read_tag_table(spark, path).first().asDict() == {"eventID": "S1", "tag": "acgt", "library": "L"}


def test_headers_are_mapped_by_canonical_form(spark, tmp_path):
    path = put(tmp_path / "f.csv", "﻿EventID,Depth [m],depth,odd\nS1,3,4,z\n")
    df = tables.read_text_table(spark, path)
    outcomes = tables.header_outcomes(df.columns, {"eventid": "eventID", "depth": "depth"})
    assert tables.rename_headers(df, outcomes).first().asDict() == {"eventID": "S1", "depth": "3"}
    assert [(raw, what) for raw, what, _ in outcomes[2:]] == [("depth", "collision"), ("odd", "unexpected")]


def fq(path, n, base="A"):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join(f"@r{i}\n{base * 5}\n+\n@IIII\n" for i in range(n))
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)


def test_pairs_are_found_and_read_together(spark, tmp_path):
    fq(tmp_path / "a" / "MR12_R1.fastq.gz", 3)
    fq(tmp_path / "a" / "MR12_R2.fastq.gz", 3, "C")
    fq(tmp_path / "b" / "S2.R1.fastq", 2)
    fq(tmp_path / "b" / "S2.R2.fastq", 2, "G")
    rows = fastq.read_pairs(spark, str(tmp_path)).orderBy("sample", "read_no").collect()
    assert [(r["sample"], r.library, r.r2_seq) for r in rows] == [("MR12", "a", "CCCCC")] * 3 + [("S2", "b", "GGGGG")] * 2
    assert rows[0].r1_qual == "@IIII"
    assert {tuple(r) for r in fastq.library_map(spark, str(tmp_path)).collect()} == {("MR12", "a"), ("S2", "b")}
    fq(tmp_path / "b" / "MR12_R1.fastq.gz", 1)
    with pytest.raises(FileNotFoundError):
        fastq.discover_pairs(str(tmp_path))


def test_trimmed_pairs_skip_orphans(tmp_path):
    for name in ("R1B-site_R1.fastq", "R1B-site_R2.fastq", "lost.R1.fastq"):
        fq(tmp_path / name, 1)
    pairs, skipped = fastq.discover_trimmed_pairs(str(tmp_path))
    assert [p[0] for p in pairs] == ["R1B-site"] and skipped == ["lost"]
    with pytest.raises(FileNotFoundError):
        fastq.discover_pairs(str(tmp_path / "none" if (tmp_path / "none").mkdir() is None else tmp_path))


def test_trim_logs_and_live_tracking(spark, tmp_path):
    folder = tmp_path / "logs"
    put(folder / "S1_trim_pass1.txt", "x\nTotal read pairs processed:   1,000\nTotal read pairs processed: 9\n")
    put(folder / "S1_trim_pass2.txt", "Pairs written (passing filters):  800 (80.0%)\n")
    put(folder / "S2_trim_pass1.txt", "nothing\n")
    rows = {r["sample"]: (r.raw, r.trimmed) for r in logs.read_trim_counts(spark, str(folder)).collect()}
    assert rows == {"S1": (1000, 800), "S2": (None, None)}

    def run():
        stream = live.watch_trim_logs(spark, str(folder))
        live.start(stream, str(tmp_path / "counts"), str(tmp_path / "ckpt")).awaitTermination()
        return sorted(tuple(r) for r in live.read_counts(spark, str(tmp_path / "counts")).collect())

    assert run() == [("S1", "raw", 1000), ("S1", "trimmed", 800)]
    late = put(folder / "S2_trim_pass2.txt", "Pairs written (passing filters): 12 (1%)\n")
    os.utime(late, (0, 0))  # copied in with an old time stamp
    assert run() == [("S1", "raw", 1000), ("S1", "trimmed", 800), ("S2", "trimmed", 12)]
    assert len(run()) == 3


def test_run_state(spark, tmp_path):
    text = '{"marker": "m", "steps": {"trim": {"status": "completed", "duration_seconds": 2.5, "metadata": {"read_tracking": {"n_samples": 2}}}, "swarm": {"status": "running"}}}'
    rows = {r.step: r for r in logs.read_run_state(spark, put(tmp_path / "s.json", text)).collect()}
    assert rows["trim"].duration_seconds == 2.5 and rows["trim"].read_tracking.n_samples == 2
    assert rows["swarm"].duration_seconds is None


def test_every_matrix_file_has_its_own_header(spark, tmp_path):
    put(tmp_path / "m" / "a.csv", "sequence,S1,S2\nACGT,1,2\n")
    put(tmp_path / "m" / "b.csv", '"sequence",S2,"S,3",S1\nGGTT,7,8,x\n')
    long, samples = tables.read_counts_matrix(spark, str(tmp_path / "m"))
    got = {(r["sequence"], r["sample"]): r.reads for r in long.collect()}
    assert got == {("ACGT", "S1"): 1, ("ACGT", "S2"): 2, ("GGTT", "S2"): 7, ("GGTT", "S,3"): 8, ("GGTT", "S1"): None}
    assert sorted(samples) == ["S,3", "S1", "S2"]
