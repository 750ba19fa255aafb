"""Line-oriented scans with the position of every line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, row_no, value)``: 0-based line numbers per file and over all files.

    Lines are counted per file split; the split sizes, one row per split, become offsets. That
    small table is broadcast, so no line moves between tasks.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
        "value",
    )
    splits = raw.groupBy("file", "_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")
    )
    before = Window.orderBy("file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    in_file = F.min("_off").over(Window.partitionBy("file"))
    offsets = offsets.select("file", "_start", "_first", "_off", in_file.alias("_file_off"))
    row_no = F.col("_off") + F.col("_mid") - F.col("_first")
    return raw.join(F.broadcast(offsets), ["file", "_start"]).select(
        "file", (row_no - F.col("_file_off")).alias("line_no"), row_no.alias("row_no"), "value"
    )


def file_name(c: str = "file"):
    return F.element_at(F.split(F.col(c), "/"), -1)


def file_stem(c: str = "file"):
    return F.regexp_replace(file_name(c), r"\.[^.]*$", "")
