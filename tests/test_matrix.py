"""Wide counts in a packed column, and the matrix files written from them."""

import math

from tidemark.operators import occurrence as oc
from tidemark.plans import catalog
from tidemark.sources import tables


def test_spread_and_melt(spark):
    long = spark.createDataFrame([("a", "s2", 4), ("a", "s2", 1), ("a", "s4", 7), ("b", "s0", 2), ("c", None, 3)], "id string, eventID string, nb_reads long")
    names = ["s0", "s1", "s2", "s3", "s4"]
    wide = oc.spread_counts(long, ["id"], names)
    assert wide.columns == ["id", oc.PACKED] and oc.sample_columns(wide, ("id",)) == names
    got = {(r.id, r.eventID): r.nb_reads for r in oc.melt_counts(wide, ["id"], names).collect()}
    full = {(i, n): 0 for i in "abc" for n in names}
    assert got == full | {("a", "s2"): 5, ("a", "s4"): 7, ("b", "s0"): 2}
    some = oc.melt_counts(wide, ["id"], ["s4", "s1"]).collect()
    assert {(r.id, r.eventID): r.nb_reads for r in some} == {(i, n): 7 * (i + n == "as4") for i in "abc" for n in ("s1", "s4")}


def test_many_samples_have_no_columns(spark):
    """A column per sample made this plan alone take minutes."""
    long = spark.range(40_000).selectExpr("id % 7 AS id", "concat('s', id) AS eventID", "id + 1 AS nb_reads")
    names = [f"s{i}" for i in range(40_000)]
    wide = oc.spread_counts(long, ["id"], names)
    assert len(wide.columns) == 2
    rows = oc.nonzero(oc.melt_counts(wide, ["id"], oc.sample_columns(wide, ("id",)))).collect()
    assert sorted((r.id, r.eventID, r.nb_reads) for r in rows) == sorted((i % 7, f"s{i}", i + 1) for i in range(40_000))


def test_matrix_file(spark, tmp_path):
    rows = [(2, "TT", [(1, 5)]), (1, 'A"C,', [(0, 1), (3, 9)]), (3, None, None), (4, "GG", [])]
    packed = spark.createDataFrame(rows, f"otu int, sequence string, {oc.PACKED} array<struct<at: int, n: bigint>>")
    wide = packed.withMetadata(oc.PACKED, {"samples": ["S1", "S,2", "S1", "S4"]})
    path = str(tmp_path / "m")
    tables.write_counts_matrix(wide, path, "otu")
    long, samples = tables.read_counts_matrix(spark, path)
    got = sorted((r["sequence"], r["sample"], r.reads) for r in long.collect())
    cells = {"TT": (0, 5, 0, 0), 'A"C,': (1, 0, 0, 9), "": (0,) * 4, "GG": (0,) * 4}
    assert got == sorted((s, n, v) for s, row in cells.items() for n, v in zip(["S1", "S,2", "S1", "S4"], row, strict=True))
    assert samples == ["S1", "S,2", "S1", "S4"]
    numbered = tables.number_features(tables.read_matrix_sequences(spark, path), ("file", "row_no")).collect()
    assert {r["sequence"]: r.asv_id for r in numbered} == {'A"C,': "OTU_1", "TT": "OTU_2", "": "OTU_3", "GG": "OTU_4"}


def test_matrix_queries_with_repeated_event_ids(spark, tmp_path):
    """Supplier keys of five digits share event ids: 12342 and 12343 are both DAR-2025-1234."""
    keys = [2, 3, 12342, 12343, 12350]
    spark.createDataFrame([(k, 1.0) for k in keys], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"p{k}") for k in range(4)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    sold = [(0, 2, 3.0), (0, 12342, 4.0), (1, 12343, 5.0), (1, 12343, 6.0), (3, 77, 1.0)]
    spark.createDataFrame(sold, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    cells = sorted((r["sample"], r.reads) for r in catalog()["s4_counts_matrix"].run(spark, str(tmp_path)).collect())
    names = ["DAR-2025-0002", "DAR-2025-0003", "DAR-2025-1234", "DAR-2025-1234", "Blank-PCR-12350"]
    hit = [("DAR-2025-0002", 3), ("DAR-2025-1234", 4), ("DAR-2025-1234", 11)]
    want = [(n, 0) for n in names for _ in range(4)]
    for n, reads in hit:
        want.remove((n, 0))
        want.append((n, reads))
    assert cells == sorted(want) and math.prod((len(names), 4)) == len(cells)
    sums = {r["sample"]: r.clustered for r in catalog()["s13_clustered_reads"].run(spark, str(tmp_path)).collect()}
    assert sums == {"DAR-2025-0002": 3, "DAR-2025-0003": 0, "DAR-2025-1234": 15, "Blank-PCR-12350": 0}
    ids = {r.asv_id for r in catalog()["w4_number_features"].run(spark, str(tmp_path)).collect()}
    assert ids == {f"OTU_{k}" for k in range(1, 5)}


def test_melted_cells_without_zeros(spark):
    """A table of many samples was melted with all its zeros, which were dropped afterwards."""
    names = [f"s{i}" for i in range(500)]
    long = spark.createDataFrame([("a", "s3", 5), ("a", "s499", -2), ("b", "s0", 1), ("c", "s1", 0)], "id string, eventID string, nb_reads long")
    wide = oc.spread_counts(long, ["id"], names)
    some = oc.melt_counts(wide, ["id"], names, zeros=False)
    assert sorted((r.id, r.eventID, r.nb_reads) for r in some.collect()) == [("a", "s3", 5), ("a", "s499", -2), ("b", "s0", 1)]
    full = oc.melt_counts(wide, ["id"], names)
    assert full.count() == 1500
    kept = [sorted(map(tuple, oc.nonzero(df).collect())) for df in (some, full)]
    assert kept[0] == kept[1] == [("a", "s3", 5), ("b", "s0", 1)]


def test_header_is_read_apart_from_the_lines(spark, tmp_path):
    """A filter on the header, which a join adds, was evaluated for every line of the scan."""
    (tmp_path / "m.csv").write_text("sequence,S1,S2\nAC,1,2\nGT,0,3\n")
    rows = tables.read_matrix_sequences(spark, str(tmp_path))
    assert sorted((r.row_no, r.sequence) for r in rows.collect()) == [(1, "AC"), (2, "GT")]
    scans = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "sha2" in x or "to_json" in x]
    assert not scans
