"""Containment, staggered overlaps and what is collapsed by them, against brute force."""

import random

import numpy as np
import pytest

from tidemark.operators import classify, denoise, overlaps


def dna(r, n):
    return "".join(r.choice("ACGT") for _ in range(n))


def ragged(seed, roots, pieces, short=0):
    r = random.Random(seed)
    texts = set()
    for _ in range(roots):
        root = dna(r, 60)
        for _ in range(pieces):
            a = r.randrange(30)
            texts.add(root[a : a + r.randrange(22, 40)])
        texts.add(root)
    texts |= {dna(r, r.randrange(1, 9)) for _ in range(short)} | {"A" * 30, "A" * 25, "AC" * 14, "CA" * 14}
    return sorted(texts)


def inside(a, b):
    return a in b


def staggered(a, b, least):
    """An end of ``a`` is a start of ``b``."""
    return any(a[-n:] == b[:n] for n in range(least, min(len(a), len(b))))


@pytest.mark.parametrize("texts", [ragged(1, 6, 12), ragged(2, 3, 8, short=25)])
def test_containments(spark, texts, monkeypatch):
    rows = [(k, s, "x" if k % 2 else "y") for k, s in enumerate(texts)] + [(9999, None, "x")]
    df = spark.createDataFrame(rows, "id long, sequence string, scope string")
    want = {(a, b) for a, s, _ in rows for b, t, _ in rows if s and t and inside(s, t)}
    assert {tuple(r) for r in overlaps.containments(df, df).collect()} == want
    want = {(a, b) for a, s, u in rows for b, t, v in rows if s and t and u == v and inside(s, t)}
    assert {tuple(r) for r in overlaps.containments(df, df, ["scope"]).collect()} == want
    assert overlaps.containments(df.limit(0), df).count() == 0


@pytest.mark.parametrize("least", [10, 20])
def test_staggered_pairs(spark, least):
    texts = ragged(3, 5, 10, short=5)
    nodes = spark.createDataFrame(list(enumerate(texts)), "rank long, sequence string")
    want = {(a, b) for a, s in enumerate(texts) for b, t in enumerate(texts) if a != b and staggered(s, t, least)}
    got = [tuple(r) for r in overlaps.staggered_pairs(nodes, least).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def collapsed(table, least):
    total = {}
    for _, s, n in table:
        total[s] = total.get(s, 0) + n
    kept, target = [], {}
    for s in sorted(total, key=lambda s: (-total[s], s)):
        same = [k for k in kept if s in k or k in s or (least and (staggered(s, k, least) or staggered(k, s, least)))]
        target[s] = same[0] if same else s
        kept += [] if same else [s]
    out = {}
    for sample, s, n in table:
        out[sample, target[s]] = out.get((sample, target[s]), 0) + n
    return out


@pytest.mark.parametrize("least", [None, 20])
def test_collapsing_equals_sequential_order(spark, least):
    r = random.Random(4)
    table = [(f"s{k % 3}", s, r.choice([1, 3, 10, 40])) for k, s in enumerate(ragged(5, 5, 12) * 2)]
    df = spark.createDataFrame(table, "sample string, sequence string, reads long")
    made = denoise.collapse_overlapping(df, least) if least else denoise.collapse_contained(df)
    assert {(x["sample"], x.sequence): x.reads for x in made.collect()} == collapsed(table, least)


def test_library_tables_are_merged(spark):
    r = random.Random(6)
    root = dna(r, 60)
    one = [("a", root[:40], 10), ("b", root[5:50], 3)]
    two = [("a", root[:40], 5), ("c", root[12:60], 2), ("c", dna(r, 40), 7)]
    tables = [spark.createDataFrame(t, "sample string, sequence string, reads long") for t in (one, two)]
    got = {(x["sample"], x.sequence): x.reads for x in denoise.merge_library_tables(tables).collect()}
    assert got == collapsed(one + two, 20) and got["a", root[:40]] == 15 and got["b", root[:40]] == 3


def test_exact_species(spark):
    r = random.Random(7)
    refs = [(f"G{k % 3}", f"S{k % 5}" if k % 7 else None, dna(r, 50)) for k in range(30)] + [(None, "S9", dna(r, 50))]
    taxa = [(s[3 : 3 + r.choice([5, 30, 47])], g) for g, _, s in refs[:20]] + [(refs[0][2].lower(), "G0"), ("AC", "G1"), (dna(r, 30), "G0"), (refs[1][2], None)]
    got = classify.exact_species(spark.createDataFrame(taxa, "sequence string, genus string"), spark.createDataFrame(refs, "genus string, species string, sequence string"))
    found = {(x.sequence, x.genus): x.species or None for x in got.collect()}
    for s, g in taxa:
        names = {b for a, b, t in refs if a == g and b and g and s.upper() in t}
        assert found[s, g] == ("/".join(sorted(names)) or None)
    assert got.count() == len(taxa)


def test_words_of_many_texts_at_once():
    """One call per length of texts finds the words that a call per text finds."""
    texts = ragged(5, 4, 6, short=9) + [None, "", "AÄC"]
    for q in (0, 1, 6):
        got = {}
        for own, codes in overlaps._by_length(texts, q):
            words, fresh = overlaps._sorted_words(codes, q)
            got |= {i: words[k][fresh[k]].tolist() for k, i in enumerate(own.tolist())}
        size = lambda t: len(t.encode())
        assert got == {i: np.unique(overlaps.window_hashes(t.encode(), q)).tolist() for i, t in enumerate(texts) if t is not None and size(t) >= q}
