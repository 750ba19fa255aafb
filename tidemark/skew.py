"""Building blocks that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut_lineage

HOT_SHARES = 1000
HOT_SALTS = 128
HOT_ROWS = 100_000
POSITION_BLOCK = 1_000_000


def number_rows(df: DataFrame, order: Sequence[Column], out: str, start: int = 1) -> DataFrame:
    """Dense global row number in ``order`` without pulling rows into one task.

    Range partitioning plus a local sort fixes the order, a checkpoint freezes the partition
    of every row, and the per-partition counts (one row per partition, hence small) give the
    offset to add to the local position. ``order`` must be a total order.
    """
    local = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", 33))
        .withColumn("_pos", F.col("_mid") - F.shiftleft("_pid", 33))
        .drop("_mid")
    )
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        local.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_pos") + F.lit(start))
        .drop("_pid", "_pos", "_off")
    )


def rank_by_position(
    df: DataFrame, keys: Sequence[str], position: str, out: str, block: int = POSITION_BLOCK
) -> DataFrame:
    """1-based rank of each row in its key, by an integer position unique within the key.

    The key is split into blocks of ``block`` consecutive positions, so a window never holds
    more than ``block`` rows; block sizes turn into offsets that are joined back.
    """
    cut = df.withColumn("_blk", F.floor(F.col(position) / block))
    inside = Window.partitionBy(*keys, "_blk").orderBy(position)
    sizes = cut.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *keys, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    return (
        cut.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*keys, "_blk"])
        .withColumn(out, (F.col("_off") + F.col("_rn")).cast("long"))
        .drop("_blk", "_rn", "_off")
    )


def exact_median(df: DataFrame, value: Column) -> float | None:
    """Median of the values that are not null, the mean of the two middle ones if their number is even.

    Equal values are counted first; the counts are sorted by range, and per partition only its total
    goes through the driver, which tells the partitions of the middle ranks. No task holds all values.
    """
    held = df.select(value.cast("double").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    parts = cut_lineage(held.repartitionByRange("v").sortWithinPartitions("v").withColumn("_pid", F.spark_partition_id()))
    sizes = sorted((r["_pid"], r["n"]) for r in parts.groupBy("_pid").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return None
    found, before = [], 0
    for pid, n in sizes:
        ranks = [r - before for r in sorted({(total - 1) // 2, total // 2}) if before <= r < before + n]
        if ranks:
            upto = F.sum("n").over(Window.partitionBy("_pid").orderBy("v"))
            own = parts.where(F.col("_pid") == pid).withColumn("_upto", upto)
            for r in ranks:
                found.append(own.where(F.col("_upto") > r).agg(F.min("v")).first()[0])
        before += n
    return sum(found) / len(found)


def hot_keys(rows: DataFrame, keys: Sequence[str], shares: int = HOT_SHARES) -> DataFrame | None:
    """Keys that hold more than ``1/shares`` of the rows, or None when there are none.

    There are fewer than ``shares`` such keys whatever the data, so the list may go through
    the driver and be broadcast. Counting is one map-side combined aggregation.
    """
    return crowded_keys(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, shares)


def crowded_keys(per_key: DataFrame, keys: Sequence[str], shares: int = HOT_SHARES) -> DataFrame | None:
    """:func:`hot_keys` of rows that are counted already: ``(keys.., _n)``."""
    total = per_key.select(F.sum("_n")).scalar()
    hot = per_key.where(F.col("_n") * F.lit(shares) > total).where(F.col("_n") > HOT_ROWS).select(*keys)
    found = hot.collect()
    return per_key.sparkSession.createDataFrame(found, hot.schema) if found else None


def by_sorting(table: DataFrame) -> DataFrame:
    """The table, to be joined by sorting both sides.

    Spark's estimate of a table made by ``explode`` or Python leaves out the rows they add, so it would broadcast
    tables of any size through the driver.
    """
    return table.hint("merge")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    shares: int = HOT_SHARES,
    salts: int = HOT_SALTS,
    sort: bool = True,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to a table that is unique per key, splitting the hot keys of ``rows``.

    Without hot keys this is a plain join. Hot rows get a salt from ``spread`` and the matching
    table rows, fewer than ``shares``, are repeated once per salt. ``rows`` is read twice, so
    callers cut its lineage where it is expensive, or give the ``counts`` ``(keys.., _n)``. Both sides are sorted; without ``sort`` Spark may broadcast one.
    """
    keys = list(keys)
    found = hot_keys(rows, keys, shares) if counts is None else crowded_keys(counts, keys, shares)
    chosen = by_sorting if sort else (lambda df: df)
    if found is None:
        return rows.join(chosen(table), keys, how)
    hot = F.broadcast(found.withColumn("_hot", F.lit(True)))
    zero = F.lit(0).cast("long")
    salted = rows.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(zero)
    )
    every = F.sequence(zero, F.lit(salts - 1).cast("long"))
    copies = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(zero)))
    )
    return salted.drop("_hot").join(chosen(copies.drop("_hot")), [*keys, "_salt"], how).drop("_salt")


def grid_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_spread: Sequence[str], right_spread: Sequence[str],
    condition: Column, shares: int = HOT_SHARES, splits: int = 16,
) -> DataFrame:
    """Inner join on ``keys``, unique on neither side, that splits hot keys of both into a grid.

    A row of a hot key goes to one row or column of ``splits * splits`` cells, by its ``spread``
    columns, so every pair still meets in exactly one cell. Sides are read twice, and sorted.
    """
    keys = list(keys)
    found = [h for h in (hot_keys(left, keys, shares), hot_keys(right, keys, shares)) if h is not None]
    if not found:
        return left.join(by_sorting(right), keys).where(condition)
    crowded = found[0] if len(found) == 1 else found[0].unionByName(found[1]).distinct()
    hot = F.broadcast(crowded.withColumn("_hot", F.lit(True)))  # fewer than 2 * shares rows
    zero = F.lit(0).cast("long")
    every = F.explode(F.when(F.col("_hot"), F.sequence(zero, F.lit(splits - 1).cast("long"))).otherwise(F.array(zero)))

    def own(columns: Sequence[str]) -> Column:
        return F.when(F.col("_hot"), F.pmod(F.xxhash64(*columns), F.lit(splits))).otherwise(zero)

    x = left.join(hot, keys, "left").withColumn("_x", own(left_spread)).withColumn("_y", every).drop("_hot")
    y = right.join(hot, keys, "left").withColumn("_y", own(right_spread)).withColumn("_x", every).drop("_hot")
    return x.join(by_sorting(y), [*keys, "_x", "_y"]).drop("_x", "_y").where(condition)
