"""Removal of reads of a spike-in genome of any size, by shared words on either strand.

The genome's words set bits of a table of fixed size, built as a distributed aggregation. A pair whose mates
have too few words among the set bits is clean for certain and never leaves its task. The few others are
verified by a join of their words with the genome's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.functions.sequences import reverse_complement
from tidemark.session import cut_lineage

#: Bits of the table (32 MB), and bases of a genome text per row.
TABLE_BITS = 28
CHUNK = 1 << 20
_CODE = np.full(256, 4, np.uint8)
for _k, _b in enumerate("ACGT"):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _k
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(text: str, word: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, two-bit number) of every word of A, C, G and T."""
    codes = _CODE[np.frombuffer(text.encode(), np.uint8)]
    n = len(codes) - word + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    number, bad = np.zeros(n, np.int64), np.zeros(n, bool)
    for j in range(word):
        number = number << 2 | (codes[j : j + n] & 3)
        bad |= codes[j : j + n] > 3
    place = np.flatnonzero(~bad)
    return place, number[place]


def _bucket(number: np.ndarray) -> np.ndarray:
    x = number.astype(np.uint64) * _MIX
    return ((x ^ (x >> np.uint64(32))) * _MIX >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def apart(places: np.ndarray, word: int) -> int:
    """How many of the ascending places are taken from the left without overlap."""
    count, free = 0, -1
    for p in places.tolist():
        if p >= free:
            count, free = count + 1, p + word
    return count


def joined_texts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, str]]:
    """The texts in joined pieces of some ``CHUNK`` bytes: number of the first, starts in bytes, and the piece.

    A line end stands between two texts, so no word runs over it.
    """
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size < CHUNK):
            size += len(texts[last] or "") + 1
            last += 1
        own = [t or "" for t in texts[first:last]]
        sizes = np.array([len(t) if t.isascii() else len(t.encode()) for t in own])
        yield first, np.concatenate(([0], np.cumsum(sizes[:-1] + 1))), "\n".join(own)
        first = last


def genome_table(spark: SparkSession, genome: str | DataFrame, word: int) -> DataFrame:
    """``(number)``: the distinct words of a genome, a text or a table with ``sequence``, on both strands."""
    if isinstance(genome, str):
        parts = [(genome[i : i + CHUNK + word - 1],) for i in range(0, len(genome), CHUNK)]
        genome = spark.createDataFrame(parts, "sequence string")
    both = genome.select("sequence").unionByName(genome.select(reverse_complement("sequence").alias("sequence")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(word_numbers(text, word)[1]))], ["number"])

    return both.mapInArrow(rows, "number long").distinct()


def _bits(words: DataFrame) -> np.ndarray:
    """The table as bytes; one row per word of 64 bits that has any, so at most 2^22."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bucket(batch.column(0).to_numpy())
            bit = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bit)], ["cell", "bit"])

    cells = words.mapInArrow(rows, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return table.view(np.uint64)


def without_genome(pairs: DataFrame, genome: str | DataFrame, word: int = 16, min_hits: int = 2) -> DataFrame:
    """Drop pairs of which a mate shares ``min_hits`` words, not overlapping, with a spike-in genome.

    Words at all places of a mate count, on either strand of the genome, whose size has no limit.
    """
    if not 1 <= word <= 31:
        raise ValueError("a word has 1 to 31 bases")
    spark = pairs.sparkSession
    words = cut_lineage(genome_table(spark, genome, word))
    shared = spark.sparkContext.broadcast(_bits(words))  # 2^TABLE_BITS bits
    columns = list(pairs.columns)
    mates = [columns.index(f"r{i}_seq") for i in (1, 2)]

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            marked = np.zeros(len(batch), bool)
            for m in mates:
                for first, starts, text in joined_texts(batch.column(m).to_pylist()):
                    place, number = word_numbers(text, word)
                    at = _bucket(number)
                    place = place[(table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) != 0]
                    row = np.searchsorted(starts, place, side="right") - 1
                    for k in np.flatnonzero(np.bincount(row, minlength=len(starts)) >= min_hits).tolist():
                        own = slice(*np.searchsorted(row, (k, k + 1)))
                        marked[first + k] |= min_hits <= 1 or apart(place[own], word) >= min_hits
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marked)], [*columns, "_suspect"])

    schema = StructType([*pairs.schema.fields, StructField("_suspect", BooleanType())])
    judged = cut_lineage(pairs.mapInArrow(suspect, schema))
    clean = judged.where("NOT _suspect").drop("_suspect")
    # the checkpoint fixes partitions, hence the numbers
    doubtful = cut_lineage(judged.where("_suspect").drop("_suspect").withColumn("_id", F.monotonically_increasing_id()))

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for m in (1, 2):
                    place, number = word_numbers(row[f"r{m}_seq"] or "", word)
                    arrays = [pa.array(np.full(len(place), row["_id"])), pa.array(np.full(len(place), m, np.int32)), pa.array(place.astype(np.int32)), pa.array(number)]
                    yield pa.RecordBatch.from_arrays(arrays, ["_id", "mate", "place", "number"])

    @F.pandas_udf("int")
    def taken(places: pd.Series) -> pd.Series:
        return places.map(lambda p: apart(np.sort(p), word)).astype("int32")

    offered = doubtful.select("_id", "r1_seq", "r2_seq").mapInArrow(offer, "_id long, mate int, place int, number long")
    held = offered.join(words, "number").groupBy("_id", "mate").agg(F.collect_list("place").alias("places"))
    found = held.where(taken("places") >= min_hits).select("_id").distinct()
    return clean.unionByName(doubtful.join(found, "_id", "left_anti").drop("_id"))
