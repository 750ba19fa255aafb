"""Operator 12: quality from supervised subword embeddings.

A document's features are its words and the character n-grams inside them, hashed into ``BUCKETS``
rows of a learned table; a word that only repeats the word before it is the feature *again*. One feature,
which counts like ``PRIOR`` words, is common to all documents, so a few words alone decide little.
The rows are averaged, a softmax layer gives the chance of each label, and stochastic gradient
descent in NumPy learns both. A linear layer over an average is an average of per-bucket sums, so
scoring is one lookup per feature.

It learns from at most ``per_label`` documents of each label (a documented bound), chosen by the hash of their
id among labelled rows outside the held-out fold. Repeated equal labels of an id count once, an id
with both labels is left out, and of several texts of an id the one with the smallest hash is taken. Only
bucket counts leave the tasks that read the texts, so even a very long text weighs at most one row per
bucket. Scoring reads every whole text and only the text. Null and empty texts have the common
feature only and get a score like all others. Without a usable label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import mixed, slices

#: Rows of the hashed table and their length, and the bound of the training sample for each label.
BUCKETS = 1 << 15
DIMENSIONS = 12
PER_LABEL = 1500
#: Code points of a character n-gram; a word's edge counts as one.
GRAMS = (2, 3, 4)
EPOCHS = 12
RATE = 0.5
PRIOR = 8
CHARS = 1 << 20

_WORD = np.uint64(0x9E3779B97F4A7C15)
_WORD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_COMMON, _WORDS, _AGAIN = 0, 1, -1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(x + np.uint64((kind + 2) * int(_WORD) % (1 << 64))) >> _SHIFT).astype(np.int32)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(document, bucket)`` of every feature of the texts, documents by position."""
    held = [t or "" for t in texts]
    raw = np.frombuffer("".join(f" {t} " for t in held).encode("utf-32-le", "replace"), "<u4")
    size = np.array([len(t) + 2 for t in held], np.int64)
    doc = np.repeat(np.arange(len(held), dtype=np.int32), size)
    space = (raw <= 32) | (raw == 0x85) | (raw == 0xA0) | (raw == 0x3000) | ((raw >= 0x2000) & (raw <= 0x200A))
    code = np.where(space, 1, raw).astype(np.uint64)
    none = np.zeros(1, np.uint64)
    docs = [np.repeat(np.arange(len(held), dtype=np.int32), PRIOR)]
    buckets = [np.repeat(_bucket(none, _COMMON), len(docs[0]))]
    # a word's hash is a difference of prefix sums, divided by the power of its place
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    stops = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    place = np.arange(len(raw), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
    longest = int(size.max(initial=1))
    total = np.concatenate(([np.uint64(0)], np.cumsum(code * _powers(_WORD, longest)[place], dtype=np.uint64)))
    word = (total[stops] - total[starts]) * _powers(_WORD_INVERSE, longest)[place[starts]]
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[starts][1:] == doc[starts][:-1])
    docs.append(doc[starts])
    buckets.append(np.where(again, _bucket(none, _AGAIN), _bucket(word, _WORDS)))
    spaces = np.concatenate(([0], np.cumsum(space)))
    gram = code
    for n in range(2, max(GRAMS) + 1):
        gram = gram[: len(code) - n + 1] * _WORD + code[n - 1 :]
        if n in GRAMS:
            # white space may stand at the ends only
            inside = spaces[n - 1 : len(code)] - spaces[1 : len(code) - n + 2]
            at = np.flatnonzero((inside == 0) & ~(space[:-1] & space[1:]) if n == 2 else inside == 0)
            docs.append(doc[at])
            buckets.append(_bucket(gram[at], n))
    return np.concatenate(docs), np.concatenate(buckets)


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """``(doc_id, label, held, text)`` of at most ``per_label`` documents for each label.

    ``held`` is the number of usable labels like this one. A first cut by the labels' counts keeps the exact choice among few rows; ids are unique by then.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    each = usable.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_max")).where("label = _max")
    chance = F.xxhash64("doc_id", F.lit("quality sample")).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))
    drawn = each.select("doc_id", "label", chance.alias("_u"))
    counts = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    if not counts:
        return docs.where(F.lit(False)).select("doc_id", F.lit(0).alias("label"), F.lit(0).alias("held"), "text")
    number = F.coalesce(*[F.when(F.col("label") == k, F.lit(n)) for k, n in counts.items()])
    place = F.row_number().over(Window.partitionBy("label").orderBy("_u", "doc_id"))
    few = drawn.where(F.col("_u") * number < 4.0 * per_label).withColumn("_rn", place).where(F.col("_rn") <= per_label)
    chosen = F.broadcast(few.select("doc_id", "label"))  # at most per_label rows for each of two labels
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    best = found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return best.select("doc_id", "label", number.alias("held"), "text")


def counted(rows: DataFrame) -> DataFrame:
    """``(doc_id, label, held, buckets, counts)`` of every row, packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(3).to_pylist()):
                buckets, n = np.unique(features([text])[1], return_counts=True)
                packed = [pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in ((buckets, "<i4"), (n, "<f4"))]
                columns = [*batch.slice(k, 1).columns[:3], *packed]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "held", "buckets", "counts"])

    read = rows.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), F.col("held").cast("long"), "text")
    return read.mapInArrow(count, "doc_id long, label int, held long, buckets binary, counts binary")


def train(
    x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, held: np.ndarray, epochs: int = EPOCHS, rate: float = RATE
) -> np.ndarray:
    """Log odds of label 1 that a feature of each bucket adds, after learning table and layer.

    The sample's rows stand for the ``held`` rows of their label, so scores are chances among all
    labelled documents; the rate falls to zero in a straight line.
    """
    random = np.random.default_rng(11)
    table = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer = np.zeros((DIMENSIONS, 2))
    stands = np.array([held[y == k].max(initial=0) / max(1, (y == k).sum()) for k in (0, 1)])
    weight = (stands * len(y) / stands[y].sum()).clip(max=4)
    shares = [(b, n / n.sum()) for b, n in x]
    step, steps = 0, epochs * len(y)
    for _ in range(epochs):
        for k in random.permutation(len(y)):
            buckets, share = shares[k]
            rows = table[buckets]
            mean = share @ rows
            odds = mean @ layer
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[y[k]] -= 1
            p *= rate * (1 - step / steps) * weight[y[k]]
            back = layer @ p
            layer -= mean[:, None] * p
            # of the average's gradient every row gets its share, scaled up to the number of rows
            table[buckets] = rows - np.minimum(share * len(share), 4.0)[:, None] * back
            step += 1
    return table @ (layer[:, 1] - layer[:, 0])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> np.ndarray | None:
    """Log odds by bucket, learned in one task from the bounded sample; None without a usable label."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        pairs = zip(pdf["buckets"], pdf["counts"], strict=True)
        x = [(np.frombuffer(b, "<i4"), np.frombuffer(n, "<f4").astype(np.float64)) for b, n in pairs]
        odds = train(x, pdf["label"].to_numpy(), pdf["held"].to_numpy())
        return pd.DataFrame({"odds": [odds.astype("<f8").tobytes()]})

    sample = counted(training_rows(docs, labels, per_label))
    made = sample.groupBy(F.lit("all").alias("_all")).applyInPandas(learn, "odds binary").collect()  # one row
    return np.frombuffer(made[0]["odds"], "<f8") if made else None


def score_texts(texts: list[str | None], odds: np.ndarray) -> np.ndarray:
    """Chance of label 1 for each text."""
    out = []
    for a, b in slices([t or "" for t in texts], CHARS):
        doc, bucket = features(texts[a:b])
        mean = np.bincount(doc, odds[bucket], b - a) / np.bincount(doc, minlength=b - a)
        out.append(1 / (1 + np.exp(-mean.clip(-700, 700))))
    return np.concatenate(out) if out else np.empty(0)


def score(docs: DataFrame, odds: np.ndarray | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the score of every whole text, in a column that replaces one of that name."""
    if odds is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(odds)  # one number per bucket

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts([t if isinstance(t, str) else None for t in texts], shared.value))

    return docs.withColumn(out, judge(F.col(text)))
