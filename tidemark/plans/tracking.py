"""Queries: read tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import tracking as tr
from tidemark.plans.registry import query
from tidemark.plans.views import VIEWS, ctes, view
from tidemark.sources import logs

_BASE = f"""(SELECT eventID AS sample, k, r, CAST(floor(r * (k % 10) / 10) AS BIGINT) AS t FROM
  (SELECT eventID, sample_no AS k, 1000 + (sample_no * 7919) % 900000 AS r FROM ({VIEWS['samples']}) s) u) b"""


def _comma(c: str) -> str:
    return f"concat(CAST(CAST(floor({c} / 1000) AS BIGINT) AS STRING), ',', lpad(CAST({c} % 1000 AS STRING), 3, '0'))"


# Trim logs, line by line; some logs or count lines are missing, repeated counts come later.
VIEWS["trim_lines"] = " UNION ALL ".join(
    [
        f"SELECT concat('/logs/', sample, '_trim_pass1.txt') AS file, CAST(0 AS BIGINT) AS line_no, 'log of pass 1' AS value FROM {_BASE}",
        f"SELECT concat('/logs/', sample, '_trim_pass1.txt'), 1, concat('Total read pairs processed:    ', {_comma('r')}) FROM {_BASE} WHERE k % 13 <> 0",
        f"SELECT concat('/logs/', sample, '_trim_pass1.txt'), 2, 'Total read pairs processed: 1' FROM {_BASE} WHERE k % 13 <> 0",
        f"SELECT concat('/logs/', sample, '_trim_pass2.txt'), 0, 'log of pass 2' FROM {_BASE} WHERE k % 7 <> 0",
        f"SELECT concat('/logs/', sample, '_trim_pass2.txt'), 1, concat('Pairs written (passing filters):  ', {_comma('t')}, ' (1.0%)') FROM {_BASE} WHERE k % 7 <> 0 AND k % 11 <> 0",
        f"SELECT concat('/logs/', sample, '_trim_pass2.txt'), 2, 'Pairs written (passing filters): 2 (0.0%)' FROM {_BASE} WHERE k % 7 <> 0 AND k % 11 <> 0",
    ]
)
VIEWS["trim"] = f"""SELECT sample, CASE WHEN k % 13 <> 0 THEN r END AS raw,
  CASE WHEN k % 7 <> 0 AND k % 11 <> 0 THEN t END AS trimmed FROM {_BASE}"""
VIEWS["track"] = f"""SELECT CASE WHEN k % 19 = 4 THEN concat(sample, '-x') ELSE sample END AS sample, t AS input,
  CAST(floor(t * 9 / 10) AS BIGINT) AS filtered, CAST(floor(t * 8 / 10) AS BIGINT) AS denoised,
  CASE WHEN k % 17 <> 2 THEN CAST(floor(t * 7 / 10) AS BIGINT) END AS merged,
  CASE WHEN k % 6 = 1 THEN CAST(floor(t / 20) AS BIGINT) ELSE CAST(floor(t * 6 / 10) AS BIGINT) END AS nonchim
FROM {_BASE} WHERE k % 5 <> 3"""

TRACKING = ctes("trim", "track") + """,
tracking AS (SELECT sample, raw, coalesce(trimmed, input) AS trimmed, filtered, denoised, merged, nonchim,
  round(CASE WHEN raw <> 0 THEN nonchim / raw * 100 END, 2) AS pct_retained FROM trim FULL OUTER JOIN track
  USING (sample)),
steps AS (SELECT * FROM (VALUES ('raw', 0), ('trimmed', 1), ('filtered', 2), ('denoised', 3), ('merged', 4),
  ('nonchim', 5)) v(step, step_no)),
long AS (SELECT sample, step, step_no, CASE step WHEN 'raw' THEN raw WHEN 'trimmed' THEN trimmed WHEN 'filtered'
  THEN filtered WHEN 'denoised' THEN denoised WHEN 'merged' THEN merged ELSE nonchim END AS reads
  FROM tracking CROSS JOIN steps),
lagged AS (SELECT *, lag(reads) OVER (PARTITION BY sample ORDER BY step_no) AS previous,
  lag(step) OVER (PARTITION BY sample ORDER BY step_no) AS previous_step FROM long),
losses AS (SELECT *, (1 - reads / previous) * 100 AS loss_pct FROM lagged WHERE previous > 0 AND reads IS NOT
  NULL AND (1 - reads / previous) * 100 > 70)"""


def tracking(spark, sf):
    return tr.assemble_tracking(view(spark, sf, "trim"), view(spark, sf, "track"))


@query("s11_trim_counts", ctes("trim") + " SELECT * FROM trim")
def _(spark, sf):
    return logs.trim_counts(view(spark, sf, "trim_lines"))


@query("j14_tracking_table", TRACKING + " SELECT * FROM tracking")
def _(spark, sf):
    return tracking(spark, sf)


@query(
    "j14_tracking_clustered",
    ctes("trim", "samples", "counts")
    + """, c AS (SELECT eventID AS sample, CAST(sum(reads) AS BIGINT) AS clustered FROM counts JOIN samples USING
    (sample_no) GROUP BY eventID) SELECT sample, raw, trimmed, clustered, round(CASE WHEN raw <> 0 THEN
    clustered / raw * 100 END, 2) AS pct_retained FROM trim FULL OUTER JOIN c USING (sample)""",
)
def _(spark, sf):
    ids = view(spark, sf, "samples").select("sample_no", F.col("eventID").alias("sample"))
    clustered = (
        view(spark, sf, "counts").groupBy("sample_no").agg(F.sum("reads").alias("clustered")).join(ids, "sample_no")
    )
    return tr.assemble_tracking(view(spark, sf, "trim"), clustered=clustered.select("sample", "clustered"))


@query(
    "a12_trim_loss",
    ctes("trim")
    + """ SELECT CAST(sum(raw) AS BIGINT) AS raw_total, CAST(sum(trimmed) AS BIGINT) AS trimmed_total,
    round((1 - sum(trimmed) / sum(raw)) * 100, 6) AS loss_pct FROM trim WHERE raw IS NOT NULL AND trimmed
    IS NOT NULL""",
)
def _(spark, sf):
    return tr.trim_loss(view(spark, sf, "trim")).withColumn("loss_pct", F.round("loss_pct", 6))


@query("a13_retention", TRACKING + " SELECT sample, pct_retained FROM tracking")
def _(spark, sf):
    return tracking(spark, sf).select("sample", "pct_retained")


@query(
    "a14_step_summary",
    TRACKING
    + """ SELECT step, step_no, CAST(sum(reads) AS BIGINT) AS total_reads, count(CASE WHEN reads IS NULL THEN 1
    END) AS n_unmeasured, count(reads) AS n_measured, CASE WHEN step IN ('merged', 'nonchim') THEN (SELECT
    count(*) FROM part) END AS n_features FROM long GROUP BY step, step_no""",
)
def _(spark, sf):
    n = spark.read.parquet(f"{sf}/part.parquet").agg(F.count(F.lit(1)).alias("n_features"))
    features = n.withColumn("step", F.explode(F.array(F.lit("merged"), F.lit("nonchim"))))
    return tr.step_summary(tracking(spark, sf), features)


@query("a14_unmeasured_samples", TRACKING + " SELECT sample, step FROM long WHERE reads IS NULL")
def _(spark, sf):
    return tr.unmeasured_samples(tracking(spark, sf))


@query(
    "w5_step_loss",
    TRACKING
    + """ SELECT sample, previous_step, step, previous, reads, round(loss_pct, 6) AS loss_pct FROM losses""",
)
def _(spark, sf):
    return tr.step_losses(tracking(spark, sf)).withColumn("loss_pct", F.round("loss_pct", 6))


@query(
    "a15_tracking_warnings",
    TRACKING
    + """ SELECT sample, kind, step, round(value, 6) AS value FROM (SELECT sample, 'absent' AS kind, step, NULL AS
    value FROM long WHERE reads IS NULL UNION ALL SELECT sample, 'low retention', 'nonchim', pct_retained FROM
    tracking WHERE pct_retained < 30 UNION ALL SELECT sample, 'step loss', step, loss_pct FROM losses)""",
)
def _(spark, sf):
    return tr.tracking_warnings(tracking(spark, sf)).withColumn("value", F.round("value", 6))


@query(
    "a16_tracking_headline",
    TRACKING
    + """ SELECT count(*) AS n_samples, CAST(sum(raw) AS BIGINT) AS raw_reads_total, 'nonchim' AS final_step,
    CAST(sum(nonchim) AS BIGINT) AS final_reads_total, round(avg(pct_retained), 2) AS mean_retention_pct
    FROM tracking""",
)
def _(spark, sf):
    return tr.tracking_headline(tracking(spark, sf))


@query(
    "a16_per_sample_counts",
    TRACKING + " SELECT sample, raw, nonchim FROM tracking",
)
def _(spark, sf):
    df = tr.per_sample_counts(tracking(spark, sf))
    return df.select("sample", F.col("counts")["raw"].alias("raw"), F.col("counts")["nonchim"].alias("nonchim"))


@query(
    "a27_funnel",
    TRACKING
    + """ SELECT step, CAST(coalesce(sum(reads), 0) AS BIGINT) AS total, round(coalesce(sum(reads), 0) / (SELECT
    sum(raw) FROM tracking) * 100, 6) AS pct FROM long GROUP BY step""",
)
def _(spark, sf):
    return tr.funnel(tracking(spark, sf)).withColumn("pct", F.round("pct", 6))


@query(
    "r14_stage_counts",
    ctes("reads")
    + """ SELECT sample, count(*) AS input, count(CASE WHEN read_no % 3 <> 0 THEN 1 END) AS filtered,
    count(CASE WHEN read_no % 3 = 1 AND sample <> 'S7' THEN 1 END) AS denoised FROM reads GROUP BY sample""",
)
def _(spark, sf):
    reads = view(spark, sf, "reads").select("sample", "read_no", F.lit(1).alias("reads"))
    return tr.stage_counts(
        {
            "input": reads,
            "filtered": reads.where("read_no % 3 <> 0"),
            "denoised": reads.where("read_no % 3 = 1 AND sample <> 'S7'"),
        }
    )


@query(
    "r14_feature_counts",
    ctes("reads")
    + """ SELECT 'merged' AS step, count(DISTINCT sequence) AS n_features FROM reads UNION ALL SELECT 'nonchim',
    count(DISTINCT sequence) FROM reads WHERE read_no % 5 <> 0""",
)
def _(spark, sf):
    reads = view(spark, sf, "reads")
    return tr.feature_counts({"merged": reads, "nonchim": reads.where("read_no % 5 <> 0")})
