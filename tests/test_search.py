"""Similarity search against full alignment tables with affine gaps."""

import math
import random

import numpy as np
import pytest
from conftest import SMALL

from tidemark.functions.sequences import reverse_complement_text
from tidemark.operators import extension, search
from tidemark.plans import catalog
from tidemark.plans.views import view

FAR = -(10**6)


def dna(r, n):
    return "".join(r.choice("ACGT") for _ in range(n))


def edited(r, s, n):
    for _ in range(n):
        at = r.randrange(len(s) + 1)
        s = r.choice([s[:at] + r.choice("ACGT") + s[at + 1 :], s[:at] + s[at + r.randrange(1, 4) :], s[:at] + dna(r, r.randrange(1, 4)) + s[at:]])
    return s


def full_scores(pairs, scheme):
    """Best local score of every pair of texts: the whole table, all pairs at once."""
    n = len(pairs)
    x = extension._matrix([a.encode() for a, _ in pairs], max(len(a) for a, _ in pairs), 0)
    y = extension._matrix([b.encode() for _, b in pairs], max(len(b) for _, b in pairs), 1)
    new, longer = scheme.gap_open + scheme.gap_extend, scheme.gap_extend
    h = np.zeros((y.shape[1] + 1, n), np.int32)
    f = np.full((y.shape[1] + 1, n), FAR, np.int32)
    best = np.zeros(n, np.int32)
    for i in range(x.shape[1]):
        diagonal, e = h[0].copy(), np.full(n, FAR, np.int32)
        for j in range(y.shape[1]):
            f[j + 1] = np.maximum(f[j + 1] - longer, h[j + 1] - new)
            e = np.maximum(e - longer, h[j] - new)
            value = np.maximum(np.maximum(diagonal + np.where(x[:, i] == y[:, j], scheme.match, scheme.mismatch), 0), np.maximum(e, f[j + 1]))
            diagonal, h[j + 1] = h[j + 1].copy(), value
            np.maximum(best, value, out=best)
    return best


def prefix_best(a, b, scheme):
    """Best score of a start of ``a`` with a start of ``b``."""
    m = len(b) + 1
    h = [0] + [-scheme.gap_open - scheme.gap_extend * j for j in range(1, m)]
    f, best = [FAR] * m, 0
    for i, c in enumerate(a, 1):
        diagonal, h[0], e = h[0], -scheme.gap_open - scheme.gap_extend * i, FAR
        for j in range(1, m):
            f[j] = max(f[j] - scheme.gap_extend, h[j] - scheme.gap_open - scheme.gap_extend)
            e = max(e - scheme.gap_extend, h[j - 1] - scheme.gap_open - scheme.gap_extend)
            diagonal, h[j] = h[j], max(diagonal + (scheme.match if c == b[j - 1] else scheme.mismatch), e, f[j])
            best = max(best, h[j])
    return best


@pytest.mark.parametrize("task", sorted(search.SCHEMES))
def test_extension_equals_the_full_table(task):
    scheme, r = search.SCHEMES[task], random.Random(5)
    a = [dna(r, r.randrange(60)) for _ in range(300)]
    b = [edited(r, s, r.randrange(5)) if k % 3 else dna(r, r.randrange(60)) for k, s in enumerate(a)]
    score, path, used_a, used_b = extension.extend([s.encode() for s in a], [s.encode() for s in b], 64, scheme)
    assert list(score) == [prefix_best(x, y, scheme) for x, y in zip(a, b)]
    matches, mismatch, opened = path >> 40, path >> 20 & 0xFFFFF, path & 0xFFFFF
    gaps = used_a + used_b - 2 * (matches + mismatch)
    assert (matches * scheme.match + mismatch * scheme.mismatch - opened * scheme.gap_open - gaps * scheme.gap_extend == score).all()


def test_a_chance_word_is_dropped_soon(monkeypatch):
    """The rows of the table that unlike sequences cost do not grow with their length."""
    r, scheme = random.Random(6), search.SCHEMES["blastn"]
    steps = []
    for n in (300, 3000):
        a, b = [dna(r, n).encode() for _ in range(20)], [dna(r, n).encode() for _ in range(20)]
        count = [0]
        real = np.maximum

        def counted(*args, **named):
            count[0] += 1
            return real(*args, **named)

        monkeypatch.setattr(extension.np, "maximum", counted)
        extension.extend(a, b, 64, scheme)
        monkeypatch.undo()
        steps.append(count[0])
    assert steps[1] < 2 * steps[0]


def runs_of(q, r, word):
    return [
        (i, j) for i in range(len(q) - word + 1) for j in range(len(r) - word + 1)
        if q[i : i + word] == r[j : j + word] and (i == 0 or j == 0 or q[i - 1] != r[j - 1])
    ]


@pytest.mark.parametrize("task, word", [("megablast", 12), ("blastn", 11)])
def test_best_alignment_through_a_run_equals_the_local_optimum(task, word):
    r, scheme = random.Random(7), search.SCHEMES[task]
    pairs = []
    while len(pairs) < 150:
        q = dna(r, r.randrange(40, 90))
        t = dna(r, r.randrange(30)) + edited(r, q, r.randrange(6)) + dna(r, r.randrange(30))
        if runs_of(q, t, word):
            pairs.append((q, t))
    out = extension.best_alignments([q for q, _ in pairs], [t for _, t in pairs], [runs_of(q, t, word) for q, t in pairs], 75.0, scheme)
    assert (out["half_score"] == full_scores(pairs, scheme)).mean() == 1.0
    for k, (q, t) in enumerate(pairs):
        assert 1 <= out["qstart"][k] <= out["qend"][k] <= len(q) and 1 <= out["sstart"][k] <= out["send"][k] <= len(t)


@pytest.mark.parametrize("task", ["megablast", "blastn"])
def test_pairs_that_cannot_be_hits_are_not_aligned(task, monkeypatch):
    r, scheme, word = random.Random(8), search.SCHEMES[task], 12
    pairs = []
    while len(pairs) < 300:  # a shared half and a random one, as within a genus; every third is near, some are long
        q = dna(r, r.randrange(40, 90) if len(pairs) % 20 else 2500)
        t = edited(r, q, r.randrange(8)) if len(pairs) % 3 == 0 else q[: len(q) // 2] + dna(r, len(q) // 2)
        if runs_of(q[:90], t[:90], word):
            pairs.append((q, t))
    texts = [q for q, _ in pairs], [t for _, t in pairs], [runs_of(q[:90], t[:90], word) for q, t in pairs]
    whole = extension.best_alignments(*texts, 80.0, scheme)
    least = np.array([1.3 * len(q) * scheme.match / 2 for q, _ in pairs])
    covered = 100.0 * (whole["qend"] - whole["qstart"] + 1) / np.array([len(q) for q, _ in pairs])
    good = (whole["half_score"] >= least) & (covered >= 80)
    aligned, real = [], extension.extend
    monkeypatch.setattr(extension, "extend", lambda a, *rest: aligned.append(len(a)) or real(a, *rest))
    found = extension.best_alignments(*texts, 80.0, scheme, least, 80.0)
    assert 50 < good.sum() < 150 and sum(aligned) == 2 * good.sum()
    for name, values in whole.items():
        assert (found[name][good] == values[good]).all()
    assert (found["pident"][~good] == -1).all()


def traced(q, r, scheme):
    """(identity, query cover) of a best local alignment by a plain table with trace back."""
    n, m = len(q), len(r)
    h = np.zeros((n + 1, m + 1), int)
    e, f = np.full((n + 1, m + 1), FAR), np.full((n + 1, m + 1), FAR)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            e[i, j] = max(e[i, j - 1] - scheme.gap_extend, h[i, j - 1] - scheme.gap_open - scheme.gap_extend)
            f[i, j] = max(f[i - 1, j] - scheme.gap_extend, h[i - 1, j] - scheme.gap_open - scheme.gap_extend)
            h[i, j] = max(0, h[i - 1, j - 1] + (scheme.match if q[i - 1] == r[j - 1] else scheme.mismatch), e[i, j], f[i, j])
    i, j = np.unravel_index(h.argmax(), h.shape)
    stop, matches, length, state = i, 0, 0, "h"
    while state != "h" or h[i, j] > 0:
        if state == "h":
            same = scheme.match if q[i - 1] == r[j - 1] else scheme.mismatch
            if h[i, j] == h[i - 1, j - 1] + same:
                matches, length, i, j = matches + (same > 0), length + 1, i - 1, j - 1
            else:
                state = "f" if h[i, j] == f[i, j] else "e"
        elif state == "f":
            length, state, i = length + 1, "f" if f[i, j] == f[i - 1, j] - scheme.gap_extend and scheme.gap_open else "h", i - 1
        else:
            length, state, j = length + 1, "e" if e[i, j] == e[i, j - 1] - scheme.gap_extend and scheme.gap_open else "h", j - 1
    return 100.0 * matches / length, 100.0 * (stop - i) / n


def test_registered_search_equals_full_tables(spark):
    """Every pair of the registered input, both strands, without seeds."""
    run = catalog()["r9_similarity_search"].run
    scheme = search.SCHEMES["megablast"]
    asks = [(r.asv_id, r.sequence) for r in view(spark, SMALL, "asks").collect()]
    refs = [(r.ref_id, r.sequence) for r in view(spark, SMALL, "refs").collect()]
    keys = [(q, r, minus) for q, _ in asks for r, _ in refs for minus in (False, True)]
    text = {(q, False): s for q, s in asks} | {(q, True): reverse_complement_text(s) for q, s in asks}
    ref = dict(refs)
    scores = np.concatenate([full_scores([(text[q, m], ref[r]) for q, r, m in keys[a : a + 20000]], scheme) for a in range(0, len(keys), 20000)])
    size = sum(len(s) for _, s in refs)
    want = {}
    for (q, r, m), score in zip(keys, scores.tolist()):
        bits = (scheme.scale * score / 2 - math.log(scheme.constant)) / math.log(2)
        if len(text[q, m]) * size * 2.0**-bits <= 1e-10:
            identity, cover = traced(text[q, m], ref[r], scheme)
            if identity >= 80 and cover >= 80:
                want.setdefault(q, {})[r, m] = round(bits, 1)
    got = {}
    for h in run(spark, SMALL).collect():
        got.setdefault(h.qseqid, {})[h.sseqid, h.sstart > h.send] = h.bitscore
    assert got.keys() == want.keys()
    for q, hits in got.items():
        assert len(hits) == min(5, len(want[q]))
        assert all(abs(want[q][k] - v) < 0.11 for k, v in hits.items())
        assert sorted(hits.values(), reverse=True) == pytest.approx(sorted(want[q].values(), reverse=True)[:5], abs=0.11)
