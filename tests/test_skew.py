"""The helpers that keep hot keys from loading one task."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark import skew
from tidemark.operators.darwincore import enrich_higher_ranks


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(1000)))
    rows = skew.number_rows(df, [F.desc("v"), F.asc("id")], "n").collect()
    want = sorted(((r.v, r.id) for r in rows), key=lambda x: (-x[0], x[1]))
    got = [(r.v, r.id) for r in sorted(rows, key=lambda r: r.n)]
    assert got == want and sorted(r.n for r in rows) == list(range(1, 5001))


def test_rank_spans_blocks_of_a_hot_key(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.col("id") * 7).alias("p"),
    )
    out = skew.rank_by_position(df, ["k"], "p", "r", block=100)
    per = {}
    for row in out.collect():
        per.setdefault(row.k, []).append((row.p, row.r))
    for pairs in per.values():
        assert [r for _, r in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_hot_key_is_found_and_salted_join_is_exact(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    rows = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).cast("long").alias("k"), "id"
    )
    table = spark.range(-1, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = skew.hot_keys(rows, ["k"], shares=10)
    assert [r.k for r in hot.collect()] == [-1]
    for how in ("inner", "left"):
        got = skew.lookup_join(rows, table, ["k"], ["id"], how, shares=10, salts=8)
        want = rows.join(table, ["k"], how)
        assert sorted(map(tuple, got.select("k", "id", "v").collect()), key=str) == sorted(
            map(tuple, want.select("k", "id", "v").collect()), key=str
        )


def test_without_hot_keys_the_join_is_plain(spark):
    rows = spark.range(0, 100).withColumnRenamed("id", "k").withColumn("x", F.col("k"))
    assert skew.hot_keys(rows, ["k"]) is None


@pytest.mark.parametrize("values", [[], [None], [3.5], [1, 2], [5, 1, 5, 5], [2] * 50 + [9], [None, 4, 1, 7, 7, 2.25]])
def test_median_equals_the_sorted_middle(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)
    known = [v for v in values if v is not None]
    assert skew.exact_median(df, df.x) == (statistics.median(known) if known else None)


def test_median_over_many_partitions(spark):
    r = random.Random(2)
    values = [r.choice([r.gauss(0, 1), r.randrange(5)]) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in map(float, values)], "x double").repartition(7)
    assert skew.exact_median(df, df.x) == statistics.median(values)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exploded(spark, name, rows=200):
    """A table whose rows Spark's estimate leaves out: its size counts before ``explode``."""
    each = F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    return spark.range(0, 3).select(F.col("id").alias("k"), each.alias(name))


def test_lookups_do_not_broadcast_exploded_tables(spark, monkeypatch):
    rows, table = _exploded(spark, "x"), _exploded(spark, "v", 1)
    for how in ("inner", "left"):
        assert "Broadcast" not in _plan(skew.lookup_join(rows, table, ["k"], ["x"], how))
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    salted = skew.lookup_join(rows, table, ["k"], ["x"], shares=10, salts=4)
    assert "SortMergeJoin [k" in _plan(salted) and salted.count() == 600


def test_grids_do_not_broadcast_exploded_tables(spark, monkeypatch):
    left, right = _exploded(spark, "x"), _exploded(spark, "y")
    assert "Broadcast" not in _plan(skew.grid_join(left, right, ["k"], ["x"], ["y"], F.lit(True)))
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    split = skew.grid_join(left, right, ["k"], ["x"], ["y"], F.col("x") < F.col("y"), shares=10, splits=4)
    assert "SortMergeJoin [k" in _plan(split) and split.count() == 3 * 199 * 100


def test_rows_of_a_frequent_name_go_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    name = F.when(F.col("id") % 3 == 0, F.concat(F.lit("n"), F.col("id"))).otherwise(F.lit("usual"))
    blank = [F.lit("").alias(c) for c in ("class", "phylum", "kingdom")]
    rows = spark.range(0, 3000).select(name.alias("scientificName"), "id", *blank)
    columns = "name string, class string, phylum string, kingdom string"
    first = spark.createDataFrame([("n0", "C0", "P0", "K0"), ("", "x", "x", "x")], columns)
    second = spark.createDataFrame([("n0", "-", "-", "-"), ("usual", "C1", None, "K1")], columns)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = enrich_higher_ranks(rows, first, second).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    known = {"n0": ("C0", "P0", "K0"), "usual": ("C1", "", "K1")}
    assert len(got) == 3000
    assert all((r["class"], r.phylum, r.kingdom) == known.get(r.scientificName, ("", "", "")) for r in got)
    assert len({r.task for r in got if r.scientificName == "usual"}) > 1
