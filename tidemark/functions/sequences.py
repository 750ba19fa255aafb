"""Expressions over DNA text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

IUPAC = "ACGTRYSWKMBDHVN"
BASES = ("A", "C", "G", "T")

# Bases each ambiguity code stands for.
IUPAC_SETS = {
    "A": "A",
    "C": "C",
    "G": "G",
    "T": "T",
    "R": "AG",
    "Y": "CT",
    "S": "CG",
    "W": "AT",
    "K": "GT",
    "M": "AC",
    "B": "CGT",
    "D": "AGT",
    "H": "ACT",
    "V": "ACG",
    "N": "ACGT",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(c: Column | str) -> Column:
    """Reverse complement, upper case, ambiguity codes included."""
    return F.translate(F.reverse(F.upper(_col(c))), "ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN")


def reverse_complement_text(seq: str) -> str:
    """The same for a parameter such as a primer."""
    return seq.upper()[::-1].translate(str.maketrans("ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"))


def is_iupac(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(f"(?i)^[{IUPAC}]+$"), F.lit(False))


def amplicon_id(c: Column | str) -> Column:
    """SHA-1 of the sequence: the same sequence has one id in every sample."""
    return F.sha1(_col(c))


def occurrence_id(marker: Column | str, event_id: Column | str, sequence: Column | str) -> Column:
    """``marker:eventID:hash``, the hash being 8 hex digits of SHA-256 of the upper-case bases."""
    seq = F.coalesce(_col(sequence), F.lit(""))
    digest = F.when(seq == "", F.lit("NOSEQ")).otherwise(F.substring(F.sha2(F.upper(seq), 256), 1, 8))
    head = F.lit(marker) if isinstance(marker, str) else marker
    return F.concat_ws(":", head, _col(event_id), digest)


def truncated_length(qual: Column | str, trunc_q: int, offset: int = 33) -> Column:
    """Bases before the first score at or below ``trunc_q``."""
    q = _col(qual)
    last = chr(trunc_q + offset)
    hit = F.regexp_instr(q, F.lit(f"[\\x{offset:02x}-\\x{ord(last):02x}]"))
    return F.when(hit > 0, hit - 1).otherwise(F.length(q))


def expected_errors(qual: Column | str, offset: int = 33) -> Column:
    """Sum of error probabilities over the quality string, read from a table of the scores."""
    table = F.array(*[F.lit(10.0 ** (-score / 10.0)) for score in range(127 - offset)])
    return F.aggregate(
        F.filter(F.split(_col(qual), ""), lambda ch: ch != ""),
        F.lit(0.0),
        lambda total, ch: total + F.get(table, F.ascii(ch) - F.lit(offset)),
    )


def wide_hash(*cols: Column) -> Column:
    """128 bits from two differently seeded hashes, as a key for derived sequences."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))
