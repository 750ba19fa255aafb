"""Tags behind a spacer and with ambiguity codes, pair by pair."""

import random
import re
from collections import Counter

import pytest

from tidemark.functions.sequences import IUPAC_SETS, reverse_complement_text
from tidemark.operators import tags

PAIR = "read_no int, library string, r1_seq string, r1_qual string, r2_seq string, r2_qual string, sample string"


def pattern(tag):
    return "".join(f"[{IUPAC_SETS[b]}]" for b in tag.upper())


def brute(rows, sheet, spacer):
    out = {}
    for n, lib, s1, q1, s2, q2, _ in rows:
        found = []
        for library, sample, tag in sheet:
            if library != lib or lib is None or sample.lower() == "unknown":
                continue
            at = [next((o for o in range(spacer + 1) if re.match(pattern(tag), (s or "").upper()[o:])), None) for s in (s1, s2)]
            if None not in at:
                found.append((sum(at), -len(tag), sample, tag, at))
        best = [f for f in found if f[:2] == min(f[:2] for f in found)]
        if len({f[2] for f in best}) != 1:
            out[n] = (None, "ambiguous" if best else "unmatched", s1, q1, s2, q2)
            continue
        _, _, sample, tag, at = best[0]
        cut = []
        for s, q, o in zip((s1, s2), (q1, q2), at):
            start, stop = o + len(tag), len(s)
            if re.search(pattern(reverse_complement_text(tag)) + r"\Z", s.upper()[start:]):
                stop -= len(tag)
            cut += [s[start:stop], q[start:stop]]
        out[n] = (sample, "assigned", *cut)
    return out


@pytest.mark.parametrize("spacer", [0, 3, 5])
def test_assignment(spark, spacer):
    r = random.Random(spacer)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    sheet = [(f"L{k % 2}", f"s{k}", dna(3) + r.choice(["R", "N", "Y", "A"]) + dna(r.choice([2, 4]))) for k in range(12)]
    sheet += [("L1", "long", dna(17) + "R" + dna(20))]
    sheet += [("L0", "Unknown", "ACGTAC"), ("L1", "twin", sheet[1][2]), ("L0", "longer", sheet[0][2] + "A"), (None, "none", "ACGT"), ("L0", "s0", "TTTTTT")]
    real = lambda t: "".join(r.choice(IUPAC_SETS[b]) for b in t)
    rows = []
    for n in range(400):
        lib, _, tag = r.choice(sheet[:13])
        mates = []
        for _ in range(2):
            tail = reverse_complement_text(real(tag)) if r.random() < 0.4 else ""
            mates.append(dna(r.randrange(7)) + (real(tag) if r.random() < 0.9 else dna(6)) + dna(r.choice([0, 12])) + tail)
        if r.random() < 0.1:
            mates[0] = mates[0].lower()
        rows.append((n, lib, mates[0], "I" * len(mates[0]), mates[1], "J" * len(mates[1]), "old"))
    rows += [(900, None, "ACGT", "IIII", "ACGT", "IIII", None), (901, "L9", "ACGT", "IIII", "ACGT", "IIII", None), (902, "L0", None, None, "", "", None)]
    rows += [(903, "L0", "NNNNNNN", "I" * 7, "ACGTAC", "I" * 6, None)]
    pairs, table = spark.createDataFrame(rows, PAIR), spark.createDataFrame(sheet, "library string, sample string, tag string")
    got = {x.read_no: (x["sample"], x.tag_status, x.r1_seq, x.r1_qual, x.r2_seq, x.r2_qual) for x in tags.assign_tags(pairs, table, spacer).collect()}
    want = brute(rows, sheet, spacer)
    assert got == want
    assert len(set(v[1] for v in want.values())) == 3
    report = {x.library: (x.assigned, x.ambiguous, x.unmatched) for x in tags.tag_report(pairs, table, spacer).collect()}
    lib_of = {x[0]: x[1] for x in rows}
    for lib, counts in report.items():
        own = Counter(v[1] for k, v in want.items() if lib_of[k] == lib)
        assert counts == (own["assigned"], own["ambiguous"], own["unmatched"])
    kept = tags.demultiplex(pairs, table, spacer)
    assert kept.count() == sum(v[1] == "assigned" for v in want.values()) and "tag_status" not in kept.columns


def test_sheets(spark):
    schema = "library string, sample string, tag string"
    pairs = spark.createDataFrame([(1, "L", "ACGT", "IIII", "ACGT", "IIII", None)], PAIR)
    for bad in (["N" * 12], ["AXC"]):
        with pytest.raises(ValueError):
            tags.demultiplex(pairs, spark.createDataFrame([("L", "s", t) for t in bad], schema))
    assert tags.demultiplex(pairs, spark.createDataFrame([], schema)).count() == 0
