"""Operator 12: features against a plain loop, held-out accuracy, a plain refit, odd rows."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import quality
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = "the of river stone light house garden winter summer letter paper music window morning evening story".split()


def good(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def bad(r, n):
    kind = r.randrange(3)
    words = [r.choice(WORDS) for _ in range(n)]
    return [" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(w for w in words[: n // 5 + 1] for _ in range(6))][kind]


def rows_of(n, seed=2):
    r = random.Random(seed)
    made = [(i, r.random() < 0.7) for i in range(n)]
    return [(i, good(r, r.randrange(8, 60)) if q else bad(r, r.randrange(8, 60)), int(q)) for i, q in made]


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, 0.1, "x") for i, t in rows], "doc_id long, text string, score double, label string")
    return docs, spark.createDataFrame([(*p, 0) for p in labels], "doc_id long, quality int, held int")


def plain_features(text):
    """Features by words, as (kind, text); the operator hashes the same ones."""
    words = (text or "").split()
    out = [("common", "")] * quality.PRIOR
    for before, word in zip([None, *words], words, strict=False):
        out.append(("again", "") if word == before else ("word", word))
        edged = f" {word} "
        out += [(n, edged[i : i + n]) for n in quality.GRAMS for i in range(len(edged) - n + 1)]
    return [(k, x) for k, x in out if k in ("common", "again", "word") or x.strip()]


@pytest.mark.parametrize("text", [None, "", "  ", "a", "a a b b b a", "é\tß  日本語\n\nx", "word " * 300, "😀 ab cd"])
def test_features_are_those_of_a_plain_loop(text):
    """Equal numbers of features, and equal features fall into equal buckets."""
    plain = plain_features(text)
    _, buckets = quality.features([text])
    assert len(buckets) == len(plain)
    counts = np.unique(buckets, return_counts=True)[1]
    wants = np.array(sorted(plain.count(x) for x in set(plain)))
    assert counts.sum() == wants.sum() and len(counts) <= len(wants)
    if len(wants) < 40:
        assert sorted(counts) == sorted(wants)


def test_features_do_not_depend_on_the_batch():
    texts = [t for _, t, _ in rows_of(30)] + [None, "", "x"]
    doc, bucket = quality.features(texts)
    for k, text in enumerate(texts):
        assert sorted(bucket[doc == k]) == sorted(quality.features([text])[1])


def plain_scores(rows, labels, texts):
    """The same sample and learning without Spark."""
    learn = {i: q for i, q in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    text = dict(rows)
    ids = sorted(i for i in learn if i in text)
    x = []
    for i in ids:
        b, n = np.unique(quality.features([text[i]])[1], return_counts=True)
        x.append((b, n.astype(np.float64)))
    y = np.array([learn[i] for i in ids])
    held = np.array([sum(v == q for v in learn.values()) for q in y])
    return quality.score_texts(texts, quality.train(x, y, held))


def test_held_out_accuracy_and_plain_refit(spark):
    made = rows_of(500)
    rows, labels = [r[:2] for r in made], [(i, q) for i, _, q in made]
    docs, marks = tables(spark, rows, labels)
    out = quality.score(docs, quality.fit(docs, marks)).withColumn("out", quality.held_out(docs.doc_id)).collect()
    got = {r["doc_id"]: r for r in out}
    assert all(r["out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i]["score"] >= 0.7, q == 1) for i, q in labels if got[i]["out"]]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)
    plain = plain_scores(rows, labels, [t for _, t in rows])
    assert np.allclose([got[i]["score"] for i, _ in rows], plain)


def test_odd_rows(spark):
    """Null, empty and long texts, repeated ids, conflicting and foreign labels, labels without document."""
    made = rows_of(200)
    rows = [r[:2] for r in made] + [(900, None), (901, ""), (902, " \n"), (None, "no id"), (903, "long words " * 30000), (1, "another text"), (1, made[1][1])]
    labels = [(i, q) for i, _, q in made] + [(1, made[1][2]), (None, 1), (900, 1), (901, None), (5, 7), (4444, 0), (3, 1 - made[3][2])]
    docs, marks = tables(spark, rows, labels)
    sample = quality.training_rows(docs, marks).collect()
    ids = [r["doc_id"] for r in sample]
    assert len(ids) == len(set(ids)) and 3 not in ids and not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)
    out = quality.score(docs, quality.fit(docs, marks)).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)


def test_sample_is_bounded(spark):
    """Also when one id holds a third of all rows."""
    made = rows_of(600)
    rows = [r[:2] for r in made] + [(7, f"text {k}") for k in range(300)]
    docs, marks = tables(spark, rows, [(i, q) for i, _, q in made] * 3)
    sample = quality.training_rows(docs, marks, per_label=40).collect()
    assert {sum(r["label"] == q for r in sample) for q in (0, 1)} == {40}


@pytest.mark.parametrize("labels", [[], [(0, None)], [(0, 1), (1, 1)]])
def test_nothing_or_one_label_to_learn_from(spark, labels):
    docs, marks = tables(spark, [(0, "a b"), (1, "c"), (3, None)], labels)
    scores = [r["score"] for r in quality.score(docs, quality.fit(docs, marks)).collect()]
    assert len(scores) == 3 and all((s >= 0.5) == (s == 0.5 or labels[0][1] == 1) for s in scores)


def test_no_documents(spark):
    docs, marks = tables(spark, [], [(1, 1), (3, 0)])
    assert quality.score(docs, quality.fit(docs, marks)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op12_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    plain = plain_scores(docs, [(r["doc_id"], r["quality"]) for r in labels], [t for _, t in docs])
    assert np.allclose([rows[i]["score"] for i, _ in docs], plain)
