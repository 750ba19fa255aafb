"""Operator 2: language by hierarchical discrimination, family first, then pairs within it.

A document is a vector of hashed byte bigrams and trigrams over its whole text. Linear support
vector machines, one per family against the rest, choose the family; inside a family one machine
per pair of languages votes. The machines learn from a bounded sample of labelled rows
(``per_language`` at most for each), each as a Spark task of its own; prediction streams all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import freeing

DIMENSIONS = 1 << 12
#: Bound of the training sample: rows for each language.
PER_LANGUAGE = 400
UNKNOWN = "und"
#: Families of ISO 639-1 codes; other labels form the family ``other``.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "indic": "hi ur bn mr gu pa ne",
    "semitic": "ar he am mt",
    "sinitic": "zh",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32
_FOLD[65:91] += 32


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower()[:2], "other")


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed byte n-gram counts of the whole text."""
    raw = _FOLD[np.frombuffer(f" {text} ".encode(), np.uint8)]
    two = raw[:-1] * np.uint32(256) + raw[1:]
    three = two[:-1] * np.uint32(256) + raw[2:]
    shift = np.uint32(32 - int(math.log2(DIMENSIONS)))
    bins = np.concatenate((two * np.uint32(2654435761) >> shift, three * np.uint32(2246822519) >> shift))
    x = np.sqrt(np.bincount(bins, minlength=DIMENSIONS)).astype(np.float32)
    return x / np.linalg.norm(x)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 40) -> np.ndarray:
    """Weights and bias of a linear support vector machine, by dual coordinate descent."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    extra = 1 / (2 * cost * weight)
    norms = (x * x).sum(1) + extra
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + extra[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``(lang, x)``: feature vectors of at most ``per_language`` rows of each language.

    Rows are chosen by the hash of their id, and an id counts once per language, with the text of the
    smallest hash, however many rows repeat it. A first cut by the languages' counts keeps the exact
    choice among few rows, whatever share one language has.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chance = F.xxhash64(F.col("doc_id"), F.lit("language sample")).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))
    ids = labelled.select("lang", "doc_id").distinct().withColumn("_u", chance)
    # One row per language, as there is one machine for each: bounded, so broadcast.
    counts = F.broadcast(ids.groupBy("lang").agg((F.lit(4.0 * per_language) / F.count(F.lit(1))).alias("_rate")))
    few = ids.join(counts, "lang").where("_u < _rate")
    best = few.withColumn("_rn", F.row_number().over(Window.partitionBy("lang").orderBy("_u", "doc_id")))
    # At most per_language rows for each language: bounded by the parameter, so broadcast.
    chosen = F.broadcast(best.where(F.col("_rn") <= per_language).select("doc_id", "lang"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for r in zip(*(c.to_pylist() for c in batch.columns), strict=True) if has_letter(r[1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([features(r[1]).tobytes() for r in rows], pa.binary())],
                ["lang", "x"],
            )

    found = labelled.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    texts = found.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return texts.select("lang", "text").mapInArrow(freeing(vectors), "lang string, x binary")


class Models:
    """Fitted machines: one per family, and one per pair of languages of a family."""

    def __init__(self, fitted: list[tuple[str, str, str, bytes]]) -> None:
        weights = {(kind, a, b): np.frombuffer(w, np.float64) for kind, a, b, w in fitted}
        self.languages = sorted(a for kind, a, _ in weights if kind == "language")
        self.families = sorted({family_of(x) for x in self.languages})
        self.of_family = {f: [x for x in self.languages if family_of(x) == f] for f in self.families}
        rows, self.row = [], {}
        for key, w in weights.items():
            if key[0] != "language":
                self.row[key] = len(rows)
                rows.append(w)
        self.w = np.array(rows).reshape(len(rows), DIMENSIONS + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the family's softmax share times the mean chance in its pairs."""
        if not has_letter(text) or not self.languages:
            return UNKNOWN, 0.0
        margins = self.w[:, :-1] @ features(text) + self.w[:, -1] if len(self.w) else np.empty(0)
        family, share = self.families[0], 1.0
        if len(self.families) > 1:
            m = np.array([margins[self.row["family", f, ""]] for f in self.families])
            e = np.exp(2 * (m - m.max()))
            best = int(np.argmax(e))
            family, share = self.families[best], float(e[best] / e.sum())
        inside = self.of_family[family]
        if len(inside) == 1:
            return inside[0], share
        chances = dict.fromkeys(inside, 0.0)
        for i, a in enumerate(inside):
            for b in inside[i + 1 :]:
                p = 1 / (1 + math.exp(-2 * float(np.clip(margins[self.row["pair", a, b]], -30, 30))))
                chances[a] += p
                chances[b] += 1 - p
        language = max(inside, key=lambda x: chances[x])
        return language, share * chances[language] / (len(inside) - 1)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Models:
    """Learn from the labelled rows outside the held-out fold.

    A machine is one task over at most ``per_language`` rows of each of its languages. Without a
    usable labelled row there is no machine and everything is ``und``.
    """
    sample = training_sample(docs, per_language)
    family = F.udf(family_of, "string")
    rows = sample.withColumn("family", family("lang")).persist()
    languages = [r["lang"] for r in rows.select("lang").distinct().collect()]
    families = sorted({family_of(x) for x in languages})
    jobs = [("family", f, "") for f in families] if len(families) > 1 else []
    jobs += [("pair", a, b) for f in families for a in languages for b in languages if a < b and family_of(a) == family_of(b) == f]
    fitted = [("language", x, "", b"") for x in languages]
    if jobs:
        members = [(x, *job) for job in jobs for x in languages if job[0] == "family" or x in job[1:]]
        takes = rows.join(docs.sparkSession.createDataFrame(members, "lang string, kind string, a string, b string"), "lang")

        def train(pdf: pd.DataFrame) -> pd.DataFrame:
            kind, a, b = pdf["kind"].iloc[0], pdf["a"].iloc[0], pdf["b"].iloc[0]
            pdf = pdf.sort_values(["lang", "x"])
            x = np.stack([np.frombuffer(v, np.float32) for v in pdf["x"]])
            own = pdf["family"] == a if kind == "family" else pdf["lang"] == a
            w = fit_svm(x, np.where(own, 1.0, -1.0))
            return pd.DataFrame({"kind": [kind], "a": [a], "b": [b], "w": [w.tobytes()]})

        done = takes.groupBy("kind", "a", "b").applyInPandas(train, "kind string, a string, b string, w binary")
        fitted += [tuple(r) for r in done.collect()]  # one row per machine
    rows.unpersist()
    return Models([(k, a, b, bytes(w)) for k, a, b, w in fitted])


def predict(docs: DataFrame, models: Models, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` plus the predicted language and its score; ``und`` and 0 for texts without a letter.

    The two columns are named by ``out`` and replace columns of these names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the languages

    @F.pandas_udf("l string, s double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["l", "s"])

    guessed = guess(F.col(text))
    return docs.withColumn(out[0], guessed).withColumns({out[0]: F.col(f"{out[0]}.l"), out[1]: F.col(f"{out[0]}.s")})
