"""Live read tracking: counts of a run while its logs still arrive and grow."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.sources.logs import PASS1, PASS2, PROCESSED, WRITTEN
from tidemark.sources.tail import tail_lines
from tidemark.sources.text import file_name

COUNTS = "sample string, step string, offset bigint, reads bigint"


def count_lines(lines: DataFrame, name: Column | None = None) -> DataFrame:
    """``(sample, step, offset, reads)`` of lines ``(file, offset, value)`` that hold a log's count.

    A log's first line comes, too, with null reads if it holds none: it tells that the log is there. All
    other lines are dropped, so a log is a few rows however long it is.
    """
    named = file_name("file") if name is None else name
    step = F.when(named.endswith(PASS1), "raw").when(named.endswith(PASS2), "trimmed")
    pattern = F.when(step == "raw", F.regexp_extract("value", PROCESSED, 1)).otherwise(F.regexp_extract("value", WRITTEN, 1))
    return lines.select(
        F.regexp_replace(named, r"_trim_pass[12]\.txt$", "").alias("sample"),
        step.alias("step"),
        "offset",
        F.replace(pattern, F.lit(","), F.lit("")).try_cast("long").alias("reads"),
    ).where("step IS NOT NULL AND (reads IS NOT NULL OR offset = 0)")


def first_counts(counts: DataFrame) -> DataFrame:
    """Stream of ``(sample, step, offset, reads)`` whenever a log's first count gets known.

    State per log: the place of its first count line, or that the log was seen without one. A row comes
    when a log appears without a count (null reads), when its count is there, and when an
    earlier count line turns up. Lines that are delivered again change nothing.
    """

    def update(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        place, reads = state.get if state.exists else (None, None)
        known, before = state.exists, place
        for pdf in batches:
            found = pdf[pdf["reads"].notna()]
            if len(found):
                best = found.loc[found["offset"].idxmin()]
                if place is None or best["offset"] < place:
                    place, reads = int(best["offset"]), int(best["reads"])
        state.update((place, reads))
        if not known or place != before:
            row = {"sample": [key[0]], "step": [key[1]], "offset": pd.array([place], "Int64"), "reads": pd.array([reads], "Int64")}
            yield pd.DataFrame(row)

    return counts.groupBy("sample", "step").applyInPandasWithState(
        update, COUNTS, "offset bigint, reads bigint", "append", GroupStateTimeout.NoTimeout
    )


def watch_trim_logs(
    spark: SparkSession, folder: str, name: Column | None = None, quiet_seconds: float = 60.0
) -> DataFrame:
    """Stream of ``(sample, step, offset, reads)`` of the trim logs below a folder, also while they are written.

    ``name`` is the log's name, by the column ``file``, where it is not that of the file.
    """
    return first_counts(count_lines(tail_lines(spark, folder, ".txt", quiet_seconds), name))


def start(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a Parquet folder and stop: restart it to pick up what comes later."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(sample, step, reads)`` of the logs whose count is known."""
    rows = spark.read.schema(COUNTS).parquet(path).where("reads IS NOT NULL")
    return rows.groupBy("sample", "step").agg(F.min_by("reads", "offset").alias("reads"))


def waiting_logs(spark: SparkSession, path: str) -> DataFrame:
    """``(sample, step)`` of logs that are there without a count line so far."""
    rows = spark.read.schema(COUNTS).parquet(path)
    known = rows.groupBy("sample", "step").agg(F.max("offset").alias("_at"))
    return known.where("_at IS NULL").select("sample", "step")
