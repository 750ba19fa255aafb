"""Two-parent chimeras: what goes through shuffles and joins, and repeated or missing rows."""

from pyspark.sql import functions as F

from tidemark.operators import chimera as ch

LEFT, RIGHT = "ACGTACGGTTCA", "TTGACCATGGCA"
ROWS = [
    ("S1", LEFT, 90), ("S1", RIGHT, 80), ("S1", LEFT[:6] + RIGHT[6:], 10), ("S1", "GGGGCCCCAAAA", 5),
    ("S2", LEFT, 90), ("S2", LEFT[:6] + RIGHT[6:], 10), (None, LEFT[:6] + RIGHT[6:], 10), ("S1", None, 7),
]


def test_ends_carry_numbers_instead_of_texts(spark):
    base = spark.createDataFrame([(1, 9, "ACGT", "S1")], "no long, size long, sequence string, sample string")
    ends = ch._ends(base, ["sample"])
    assert [t for _, t in ends.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint"]
    assert sorted(r.cut for r in ends.collect()) == [-3, -2, -1, 1, 2, 3]


def test_no_join_of_the_calls_is_broadcast(spark):
    table = spark.createDataFrame([(s, 10) for _, s, _ in ROWS[:4]], "sequence string, size long")
    called = ch.call_chimeras(table.withColumn("amplicon", F.sha1("sequence")))
    assert "BroadcastHashJoin" not in called._jdf.queryExecution().executedPlan().toString()


def test_votes_by_sample_with_repeated_and_null_rows(spark):
    table = spark.createDataFrame(ROWS + ROWS[:1], "sample string, sequence string, reads long")
    votes = {r.sequence: (r.n_samples, r.n_flagged) for r in ch.sample_votes(table).collect()}
    mixed = LEFT[:6] + RIGHT[6:]
    assert votes[mixed] == (3, 1)  # a parent is missing in S2, and rows without a sample meet none
    assert votes[LEFT] == (3, 0) and votes[RIGHT] == (1, 0)
