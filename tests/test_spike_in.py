"""Spike-in removal against a set of words, and its recall on mutated reads of a large genome."""

import random

import numpy as np
import pytest

from tidemark.functions.sequences import reverse_complement_text
from tidemark.operators import spike_in
from tidemark.operators.spike_in import apart, without_genome

SCHEMA = "n int, r1_seq string, r2_seq string, _id int"


def brute(rows, genome, word, least):
    words = {g[i : i + word] for g in (genome.upper(), reverse_complement_text(genome)) for i in range(len(g) - word + 1)}
    words = {w for w in words if set(w) <= set("ACGT")}
    hits = lambda s: apart(np.array([i for i in range(len(s or "") - word + 1) if s[i : i + word].upper() in words]), word)
    return sorted(n for n, a, b, _ in rows if max(hits(a), hits(b)) < least)


@pytest.mark.parametrize("word, least", [(8, 1), (8, 3), (16, 2)])
def test_equals_a_set_of_words(spark, word, least):
    r = random.Random(word + least)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    genome = dna(400) + "N" + dna(300).lower()
    rows = [(k, None, "", 7) for k in range(2)] + [(2, "ACG", "N" * 30, 7)]
    for k in range(3, 200):
        a, b = dna(40), dna(r.randrange(60))
        if r.random() < 0.5:
            at = r.randrange(600)
            piece = genome[at : at + r.choice([word, word + 3, 2 * word - 1, 2 * word, 3 * word])].upper()
            piece = reverse_complement_text(piece) if r.random() < 0.5 else piece
            a = a[:5] + piece + a[5:]
        rows.append((k, a.lower() if k % 9 == 0 else a, b, 7))
    pairs = spark.createDataFrame(rows, SCHEMA).drop("_id")
    want = brute(rows, genome, word, least)
    assert sorted(x.n for x in without_genome(pairs, genome, word, least).collect()) == want
    table = spark.createDataFrame([(genome[:450],), (genome[450 - word + 1 :],), (None,)], "sequence string")
    assert sorted(x.n for x in without_genome(pairs, table, word, least).collect()) == want


def test_large_genome_and_mutated_reads(spark):
    """Five million bases; reads of 150 bases with 2 % errors. Words of 20 bases meet by chance only rarely."""
    r = np.random.default_rng(3)
    genome = "".join(np.array(list("ACGT"))[r.integers(0, 4, 5_000_000)])
    rows = []
    for k in range(600):
        at = int(r.integers(0, len(genome) - 150))
        read = list(genome[at : at + 150]) if k % 2 else list(np.array(list("ACGT"))[r.integers(0, 4, 150)])
        for p in np.flatnonzero(r.random(150) < 0.02):
            read[p] = "ACGT"["ACGT".index(read[p]) - 1]
        rows.append((k, "".join(read), "ACGT" * 10))
    left = {x.n for x in without_genome(spark.createDataFrame(rows, "n int, r1_seq string, r2_seq string"), genome, word=20).collect()}
    spiked = {k for k, _, _ in rows if k % 2}
    assert len(spiked - left) >= 0.98 * len(spiked)
    assert len(left - spiked) >= 0.99 * 300


def test_no_genome(spark):
    pairs = spark.createDataFrame([(1, "ACGT" * 9, "ACGT")], "n int, r1_seq string, r2_seq string")
    assert without_genome(pairs, "").count() == 1


def test_mates_are_joined_in_pieces(monkeypatch):
    """A numpy call a read took most of the time; now one call takes some 2^20 bytes of reads."""
    monkeypatch.setattr(spike_in, "CHUNK", 10)
    texts = ["ACGT", None, "", "G" * 30, "AÄC", "TTT"]
    pieces = list(spike_in.joined_texts(texts))
    assert len(pieces) < len(texts) and [p[0] for p in pieces] == sorted({p[0] for p in pieces})
    found = []
    for first, starts, text in pieces:
        data = text.encode()
        ends = [*starts[1:].tolist(), len(data) + 1]
        found += [data[a : b - 1].decode() for a, b in zip(starts.tolist(), ends, strict=True)]
    assert found == [t or "" for t in texts]
