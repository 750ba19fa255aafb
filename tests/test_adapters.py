"""Primer placement with indels against every start, length and primer part by a plain distance table."""

import random

import numpy as np
import pandas as pd
import pytest

from tidemark.functions.sequences import IUPAC_SETS, reverse_complement_text
from tidemark.operators import adapters, reads


def distance(primer, text):
    row = list(range(len(text) + 1))
    for i, x in enumerate(primer, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (y not in IUPAC_SETS[x])))
        row = new
    return row[-1]


def best_placement(read, primer, end, rate, min_overlap):
    best, m, n = None, len(primer), len(read)
    for k in range(m if end == "anchored" else min_overlap, m + 1):
        part = primer[m - k :] if end == "front" else primer[:k]
        allowed = int(rate * k + 1e-9)
        for size in range(max(1, k - allowed), min(n, k + allowed) + 1):
            starts = range(n - size + 1)
            if end == "anchored" or (end == "front" and k < m):
                starts = [0]
            elif end == "back" and k < m:
                starts = [n - size]
            for start in starts:
                errors = distance(part, read[start : start + size])
                if errors <= allowed:
                    key = (-(k - 2 * errors), abs(size - k), start, start + size, errors)
                    best = min(best or key, key)
    return best[2:] if best else (-1, -1, -1)


def edited_reads(primer, end, n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        core = [r.choice(IUPAC_SETS[c]) for c in primer]
        for _ in range(r.randrange(4)):
            at = r.randrange(len(core))
            core[at : at + 1] = r.choice([[r.choice("ACGTN")], [core[at], r.choice("ACGT")], []]) if len(core) > 1 else core
        head, tail = ("".join(r.choice("ACGT") for _ in range(r.choice([0, 0, 3, 8]))) for _ in "ab")
        text = head + "".join(core) + tail
        if r.random() < 0.4:
            cut = r.randrange(len(text) + 1)
            text = text[cut:] if end == "front" else text[:cut]
        out.append(text.lower() if r.random() < 0.1 else text)
    return [*out, None, "", "N", primer[:1]]


@pytest.mark.parametrize("end", ["front", "back", "anchored"])
@pytest.mark.parametrize("primer, rate, overlap", [("ACGTRYNACGTTGCA", 0.2, 3), ("GATTACAGGA", 0.1, 3), ("ACR", 0.34, 1)])
def test_best_placement(end, primer, rate, overlap):
    texts = edited_reads(primer, end, 250, len(primer))
    got = adapters.locate(pd.Series(texts, dtype=object), primer, end, rate, overlap)
    want = [best_placement((t or "").upper(), primer, end, rate, overlap) for t in texts]
    assert [tuple(map(int, row)) for row in got.itertuples(index=False)] == want


def test_fewest_errors_by_stop():
    r = random.Random(8)
    primer = "".join(r.choice("ACGTRYN") for _ in range(64))
    text = "".join(r.choice("ACGT") for _ in range(90))
    bits = adapters.base_bits()[np.frombuffer(text.encode(), np.uint8)][None, :]
    got = adapters.fewest_errors(bits, adapters.primer_bits(primer))[0]
    assert list(got) == [min(distance(primer, text[a:b]) for a in range(b + 1)) for b in range(1, 91)]


def test_a_lost_or_gained_base_is_trimmed_at_both_ends(spark):
    forward, reverse, insert = "ACACCGCCCGTCACTCT", "CTTCCGGTACACTTACCATG", "GATTACAGGATCCATTAGGCATAC"
    amplicon = forward + insert + reverse_complement_text(reverse)
    rows = []
    for at in (4, 10):
        for r1 in (amplicon[:at] + amplicon[at + 1 :], amplicon[:at] + "G" + amplicon[at:], amplicon[:-at] + "C" + amplicon[-at:]):
            rows.append((r1, "I" * len(r1), reverse_complement_text(amplicon), "I" * len(amplicon)))
    pairs = spark.createDataFrame(rows, "r1_seq string, r1_qual string, r2_seq string, r2_qual string")

    def trimmed(indels):
        first = reads.keep_trimmed(reads.trim_five_prime(pairs, forward, reverse, indels=indels)).drop("status")
        return reads.trim_three_prime(first, forward, reverse, indels=indels).collect()

    assert [(r.r1_seq, len(r.r1_qual), r.r2_seq) for r in trimmed(True)] == [(insert, len(insert), reverse_complement_text(insert))] * 6
    assert len([r for r in trimmed(False) if r.r1_seq == insert]) < 6


def test_long_primers_are_refused():
    with pytest.raises(ValueError):
        reads.locate_primer("r1_seq", "A" * 65)
