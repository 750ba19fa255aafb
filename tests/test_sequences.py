"""Sequence jobs against brute force on small inputs."""

import random

import pandas as pd
import pytest

from tidemark.functions.sequences import reverse_complement_text
from tidemark.operators import chimera, clustering, denoise, reads, search


def dna(rnd, n):
    return "".join(rnd.choice("ACGT") for _ in range(n))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


@pytest.fixture(scope="module")
def amplicons():
    rnd = random.Random(5)
    texts = sorted({dna(rnd, rnd.choice([5, 6, 6, 7])) for _ in range(220)})
    return [(f"a{i:03d}", s, rnd.choice([1, 1, 2, 2, 3, 5, 9, 20])) for i, s in enumerate(texts)]


def grow(rows):
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(order)}
    label = {}
    for seed in order:
        if seed[0] in label:
            continue
        label[seed[0]] = rank[seed[0]]
        todo = [seed]
        while todo:
            cur = todo.pop()
            for o in order:
                if o[0] not in label and o[2] <= cur[2] and edits(cur[1], o[1]) <= 1:
                    label[o[0]] = rank[seed[0]]
                    todo.append(o)
    return rank, label


def test_clusters_and_grafts_equal_sequential_growth(spark, amplicons):
    df = spark.createDataFrame(amplicons, "amplicon string, sequence string, size long")
    members = clustering.cluster(df)
    rank, label = grow(amplicons)
    assert {r.amplicon: r.label for r in members.collect()} == label
    mass = {}
    for name, _, size in amplicons:
        mass[label[name]] = mass.get(label[name], 0) + size
    best = {}
    for n, s, _ in amplicons:
        for m, t, _ in amplicons:
            if mass[label[n]] <= 3 < mass[label[m]] and edits(s, t) <= 2:
                link = (rank[m], rank[n], label[m])
                best[label[n]] = min(best.get(label[n], link), link)
    want = {n: best[k][2] if k in best else k for n, k in label.items()}
    grafted = clustering.graft_light(members, 3)
    assert {r.amplicon: r.label for r in grafted.collect()} == want
    stats, member = clustering.cluster_tables(grafted)
    assert sum(r.mass for r in stats.collect()) == sum(r[2] for r in amplicons)
    assert member.count() == len(amplicons)
    with pytest.raises(ValueError):
        clustering.cluster(df, d=0)


def test_search_finds_every_reference_brute_force_accepts(spark, monkeypatch):
    rnd = random.Random(9)
    core = dna(rnd, 30)
    refs = [(f"R{i}", core + dna(rnd, 30)) for i in range(6)] + [(f"X{i}", dna(rnd, 60)) for i in range(10)]
    asks = [(f"Q{i}", refs[i][1][:50]) for i in range(6)] + [("M", reverse_complement_text(refs[8][1]))]
    q = spark.createDataFrame(asks, "qseqid string, sequence string")
    r = spark.createDataFrame(refs, "sseqid string, sequence string")

    def run():
        hits = search.similarity_search(q, r, perc_identity=60, qcov=50, evalue=1.0, max_targets=100)
        return {(h.qseqid, h.sseqid): h for h in hits.collect()}

    plain = run()
    want = {(a, b) for a, s in asks[:6] for b, t in refs[:6]} | {("M", "X2")}
    assert want <= set(plain)
    assert plain["M", "X2"].sstart > plain["M", "X2"].send and plain["M", "X2"].pident == 100.0
    monkeypatch.setattr("tidemark.skew.HOT_ROWS", 3)
    monkeypatch.setattr(search, "SHARES", 60)
    assert set(run()) == set(plain)  # split words give the same hits


def test_chimeras_equal_brute_force(spark):
    rnd = random.Random(11)
    parents = [dna(rnd, 12) for _ in range(10)]
    table = {p: rnd.choice([40, 60, 80, 100]) for p in parents}
    for _ in range(40):
        a, b = rnd.sample(parents, 2)
        cut = rnd.randrange(2, 10)
        table.setdefault(a[:cut] + b[cut:], rnd.choice([5, 10, 25, 35]))
    rows = [(f"a{i}", s, n) for i, (s, n) in enumerate(table.items())]

    def covered(fold):
        bad = set()
        for name, s, n in rows:
            for cut in range(1, len(s)):
                left = {m for m, t, k in rows if m != name and k >= fold * n and t[:cut] == s[:cut] and len(t) > cut}
                right = {m for m, t, k in rows if m != name and k >= fold * n and t[-(len(s) - cut):] == s[cut:]}
                if any(x != y for x in left for y in right):
                    bad.add(name)
        return bad

    got = chimera.call_chimeras(spark.createDataFrame(rows, "amplicon string, sequence string, size long"))
    sure, maybe = covered(2), covered(1 + 1e-9)
    want = {n: "Y" if n in sure else "?" if n in maybe else "N" for n, _, _ in rows}
    assert {r.amplicon: r.chimera for r in got.collect()} == want


def test_denoise_follows_the_skew_rule_within_a_batch(spark):
    rows = [("x", "AAAAA", 100), ("x", "AAAAC", 12), ("x", "AAACC", 1), ("x", "GGGGG", 13), ("y", "AAAAC", 12)]
    out = denoise.denoise(spark.createDataFrame(rows, "run string, sequence string, size long"), ["run"])
    got = {(r.run, r.sequence): r.variant for r in out.collect()}
    assert got["x", "AAAAC"] == "AAAAA" and got["x", "AAACC"] == "AAAAA"
    assert got["x", "GGGGG"] == "GGGGG" and got["y", "AAAAC"] == "AAAAC"


def test_merge_mates_rebuilds_the_amplicon(spark):
    rnd = random.Random(2)
    amp = dna(rnd, 80)
    r1, r2 = amp[:50], reverse_complement_text(amp)[:50]
    bad = r1[:45] + ("A" if r1[45] != "A" else "C") + r1[46:]
    rows = [("s", r1, "I" * 50, r2, "I" * 50), ("s", bad, "#" * 50, r2, "I" * 50), ("t", dna(rnd, 50), "I" * 50, r2, "I" * 50)]
    df = spark.createDataFrame(rows, "sample string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    out = reads.merge_mates(df, min_overlap=15, max_diffs=1)
    assert [(r.sequence, r.overlap, r.mismatches) for r in out.orderBy("mismatches").collect()] == [(amp, 20, 0), (amp, 20, 1)]
    assert [r.sample for r in reads.samples_without_merge(df, out).collect()] == ["t"]


def test_primers_match_ambiguity_codes_and_partial_ends():
    place = reads._locate(pd.Series(["TTACGTGGGG", "CGTGGGGGGG", "AAAA", None]), "ACRT", "front", 0.25, 3)
    assert list(place.stop) == [6, 3, -1, -1]
    back = reads._locate(pd.Series(["GGGGACAT", "GGGGGACA"]), "ACRT", "back", 0.0, 3)
    assert list(back.start) == [4, 5]


def test_quality_filter_truncates_then_judges(spark):
    good, low = "I" * 40, "I" * 25 + "#" + "I" * 14
    rows = [(1, "A" * 40, good, "C" * 40, good), (2, "A" * 40, low, "C" * 40, good), (3, "A" * 40, "I" * 5 + "#" * 35, "C" * 40, good),
            (4, "A" * 39 + "N", good, "C" * 40, good), (5, "A" * 40, "." * 40, "C" * 40, good)]
    df = spark.createDataFrame(rows, "n int, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    out = {r.n: len(r.r1_seq) for r in reads.filter_quality(df).collect()}
    assert out == {1: 40, 2: 25}
