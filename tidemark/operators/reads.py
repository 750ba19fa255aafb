"""Read-level work: primers, tags, quality, merging of mates.

Bases are compared in Arrow batches, all reads of a batch at once; everything else is built-in.
The pandas functions are declared nondeterministic although they are not: otherwise a filter on
their result is pushed below later steps and every function in the chain runs twice.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sequences import (
    IUPAC_SETS,
    expected_errors,
    reverse_complement_text,
    truncated_length,
)
from tidemark.operators.adapters import base_bits, locate, primer_bits, text_matrix

LOCATION = "start int, stop int, errors int"
MERGED = "sequence string, quality string, overlap int, mismatches int"


def _locate(reads: pd.Series, primer: str, end: str, rate: float, min_overlap: int) -> pd.DataFrame:
    """Best placement without gaps: most matches minus errors, leftmost on ties.

    ``front`` may overlap the read start in part, ``back`` the read end, ``anchored`` starts at
    the first base.
    """
    texts = reads.fillna("")
    lengths = texts.str.len().to_numpy()
    n, m, width = len(texts), len(primer), int(lengths.max()) if len(texts) else 0
    none = np.full(n, -1)
    if n == 0 or width == 0:
        return pd.DataFrame({"start": none, "stop": none, "errors": none}).astype("int32")
    bits = base_bits()[text_matrix(texts, width)]
    padded = np.zeros((n, m + width + m), dtype=np.uint8)
    padded[:, m : m + width] = bits
    wanted = primer_bits(primer)
    first, last = {"front": (-(m - min_overlap), width), "back": (0, width), "anchored": (0, 1)}[end]
    offsets = np.arange(first, last)
    at = m + first
    matches = np.zeros((n, len(offsets)), dtype=np.int16)
    for j, bit in enumerate(wanted):
        matches += (padded[:, at + j : at + j + len(offsets)] & bit) != 0
    room = lengths[:, None] - offsets[None, :]
    overlap = np.minimum(m + np.minimum(offsets, 0)[None, :], room)
    if end == "back":
        allowed = overlap >= min_overlap
    else:
        allowed = (room >= m) & (overlap >= min_overlap)
    errors = overlap - matches
    allowed &= errors <= np.floor(rate * np.maximum(overlap, 0) + 1e-9)
    score = np.where(allowed, matches - errors, -(10**6))
    best = score.argmax(axis=1)
    rows = np.arange(n)
    found = allowed[rows, best]
    start = offsets[best]
    stop = np.minimum(start + m, lengths)
    return pd.DataFrame(
        {
            "start": np.where(found, np.maximum(start, 0), -1),
            "stop": np.where(found, stop, -1),
            "errors": np.where(found, errors[rows, best], -1),
        }
    ).astype("int32")


def locate_primer(
    c: Column | str, primer: str, end: str = "front", error_rate: float = 0.1, min_overlap: int = 3,
    indels: bool = True,
) -> Column:
    """Struct ``(start, stop, errors)`` of the primer in the read, -1 where it is absent.

    Errors are mismatches and, with ``indels``, inserted and deleted bases.
    """
    if len(primer) > 64:
        raise ValueError("a primer has at most 64 bases")
    unknown = sorted(set(primer.upper()) - set(IUPAC_SETS))
    if unknown:
        raise ValueError(f"primer holds {unknown}, which are not IUPAC codes")

    @F.pandas_udf(LOCATION)
    def place(reads: pd.Series) -> pd.DataFrame:
        find = locate if indels else _locate
        return find(reads, primer, end, error_rate, min_overlap)

    return place.asNondeterministic()(c)


def _after(seq: str, at: Column) -> Column:
    return F.when(at >= 0, F.substring(F.col(seq), at + 1, F.length(seq))).otherwise(F.col(seq))


def _before(seq: str, at: Column) -> Column:
    return F.when(at >= 0, F.substring(F.col(seq), F.lit(1), at)).otherwise(F.col(seq))


def trim_five_prime(
    pairs: DataFrame, forward: str, reverse: str, error_rate: float = 0.1, min_overlap: int = 3,
    min_length: int = 20, indels: bool = True,
) -> DataFrame:
    """Cut the 5′ primers of both mates; ``status`` says what becomes of the pair.

    ``untrimmed``: a mate lacks its primer; ``short``: a mate is shorter than ``min_length``.
    """
    located = pairs.withColumns(
        {
            "_l1": locate_primer("r1_seq", forward, "front", error_rate, min_overlap, indels),
            "_l2": locate_primer("r2_seq", reverse, "front", error_rate, min_overlap, indels),
        }
    )
    cut = {}
    for i in (1, 2):
        stop = F.col(f"_l{i}.stop")
        cut[f"r{i}_seq"] = _after(f"r{i}_seq", stop)
        cut[f"r{i}_qual"] = _after(f"r{i}_qual", stop)
    untrimmed = (F.col("_l1.stop") < 0) | (F.col("_l2.stop") < 0)
    done = located.withColumns({**cut, "_untrimmed": untrimmed}).drop("_l1", "_l2")
    short = (F.length("r1_seq") < min_length) | (F.length("r2_seq") < min_length)
    return done.withColumn(
        "status", F.when(F.col("_untrimmed"), "untrimmed").when(short, "short").otherwise("trimmed")
    ).drop("_untrimmed")


def keep_trimmed(trimmed: DataFrame, untrimmed: str = "discard") -> DataFrame:
    """Pairs that go on: ``discard`` drops pairs without primer, ``keep`` passes them."""
    wanted = ["trimmed"] + (["untrimmed"] if untrimmed == "keep" else [])
    return trimmed.where(F.col("status").isin(*wanted))


def trim_three_prime(
    pairs: DataFrame, forward: str, reverse: str, error_rate: float = 0.1, min_overlap: int = 3,
    min_length: int = 20, indels: bool = True,
) -> DataFrame:
    """Cut what follows the reverse-complemented opposite primer; its absence drops nothing."""
    located = pairs.withColumns(
        {
            "_l1": locate_primer("r1_seq", reverse_complement_text(reverse), "back", error_rate, min_overlap, indels),
            "_l2": locate_primer("r2_seq", reverse_complement_text(forward), "back", error_rate, min_overlap, indels),
        }
    )
    cut = {}
    for i in (1, 2):
        start = F.col(f"_l{i}.start")
        cut[f"r{i}_seq"] = _before(f"r{i}_seq", start)
        cut[f"r{i}_qual"] = _before(f"r{i}_qual", start)
    done = located.withColumns(cut).drop("_l1", "_l2")
    return done.where((F.length("r1_seq") >= min_length) & (F.length("r2_seq") >= min_length))


def detect_orientation(
    pairs: DataFrame, forward: str, reverse: str, error_rate: float = 0.1, min_overlap: int = 3,
    indels: bool = True,
) -> DataFrame:
    """Flags ``as_expected`` and ``reversed``: both mates carry both primers in that orientation.

    A mate must start with its primer and hold the reverse complement of the other one behind
    it. Nothing is trimmed.
    """
    primers = {"f": (forward, reverse_complement_text(reverse)), "r": (reverse, reverse_complement_text(forward))}
    df = pairs
    for mate in (1, 2):
        for tag, (head, tail) in primers.items():
            df = df.withColumns(
                {
                    f"_h{mate}{tag}": locate_primer(f"r{mate}_seq", head, "anchored", error_rate, min_overlap, indels),
                    f"_t{mate}{tag}": locate_primer(f"r{mate}_seq", tail, "back", error_rate, min_overlap, indels),
                }
            )

    def holds(mate: int, tag: str) -> Column:
        head, tail = F.col(f"_h{mate}{tag}"), F.col(f"_t{mate}{tag}")
        return (head["stop"] >= 0) & (tail["start"] >= head["stop"])

    flagged = df.withColumns(
        {
            "as_expected": holds(1, "f") & holds(2, "r"),
            "reversed": holds(1, "r") & holds(2, "f"),
        }
    )
    return flagged.select(*pairs.columns, "as_expected", "reversed")


def realign(flagged: DataFrame) -> DataFrame:
    """Pairs as expected, and reversed pairs with their mates swapped."""
    swap = {"r1_seq": "r2_seq", "r1_qual": "r2_qual", "r2_seq": "r1_seq", "r2_qual": "r1_qual"}
    base = [c for c in flagged.columns if c not in ("as_expected", "reversed")]
    kept = flagged.where("as_expected").select(*base)
    turned = flagged.where("reversed").select(*[F.col(swap.get(c, c)).alias(c) for c in base])
    return kept.unionByName(turned)


def sample_failures(demultiplexed: DataFrame, tags: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """Per library: samples with a tag, samples without a read, whether too many failed."""
    seen = demultiplexed.groupBy("library", "sample").agg(F.count(F.lit(1)).alias("_n"))
    all_samples = tags.select("library", "sample").where(F.lower("sample") != "unknown").distinct()
    joined = all_samples.join(seen, ["library", "sample"], "left")
    per = joined.groupBy("library").agg(
        F.count(F.lit(1)).alias("n_samples"), F.count(F.when(F.col("_n").isNull(), 1)).alias("n_empty")
    )
    return per.withColumn("failed", F.col("n_empty") / F.col("n_samples") > max_rate)


def filter_quality(
    pairs: DataFrame, trunc_q: int = 11, max_n: int = 0, max_ee: float = 2.0, min_len: int = 20,
    max_len: int | None = None,
) -> DataFrame:
    """Truncate mates at the first low score; keep pairs whose mates both pass every limit.

    All limits are built-in expressions over the quality text. ``max_len`` is judged before
    truncation, ``min_len`` after.
    """
    df = pairs
    if max_len is not None:
        df = df.where((F.length("r1_seq") <= max_len) & (F.length("r2_seq") <= max_len))
    for i in (1, 2):
        df = df.withColumn(f"_k{i}", truncated_length(f"r{i}_qual", trunc_q).cast("int"))
        df = df.where(F.col(f"_k{i}") >= min_len)
    for i in (1, 2):
        for part in ("seq", "qual"):
            name = f"r{i}_{part}"
            df = df.withColumn(name, F.substring(F.col(name), F.lit(1), F.col(f"_k{i}")))
    for i in (1, 2):
        ns = F.length(f"r{i}_seq") - F.length(F.replace(F.upper(f"r{i}_seq"), F.lit("N"), F.lit("")))
        df = df.where((ns <= max_n) & (expected_errors(f"r{i}_qual") <= F.lit(float(max_ee))))
    return df.drop("_k1", "_k2")


def _merge_batch(r1, q1, r2, q2, min_overlap: int, max_diffs: int, stagger: bool) -> pd.DataFrame:
    """Best overlap of R1 with the reverse complement of R2, reads of equal length together."""
    flip = np.zeros(256, dtype=np.uint8)
    flip[:] = ord("N")
    for a, b in zip("ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"):
        flip[ord(a)] = ord(b)
    frame = pd.DataFrame({"r1": r1.str.upper(), "q1": q1, "r2": r2.str.upper(), "q2": q2}).reset_index(drop=True)
    n = len(frame)
    out = {"sequence": [None] * n, "quality": [None] * n, "overlap": [0] * n, "mismatches": [-1] * n}
    sizes = pd.Series(list(zip(frame.r1.str.len(), frame.r2.str.len())))
    for (len1, len2), rows in sizes.groupby(sizes).groups.items():
        if min(len1, len2) < min_overlap:
            continue
        part = frame.loc[rows]
        a, qa = text_matrix(part.r1, len1), text_matrix(part.q1, len1)
        b = flip[text_matrix(part.r2, len2)[:, ::-1]]
        qb = text_matrix(part.q2, len2)[:, ::-1]
        best = np.full(len(part), -(10**6))
        where = np.full(len(part), 10**6)
        diffs = np.full(len(part), -1)
        low = -(len2 - min_overlap) if stagger else max(0, len1 - len2)
        for d in range(low, len1 - min_overlap + 1):
            s1, s2 = max(d, 0), max(-d, 0)
            size = min(len1 - s1, len2 - s2)
            if size < min_overlap or (not stagger and d + len2 < len1):
                continue
            x, y = a[:, s1 : s1 + size], b[:, s2 : s2 + size]
            mism = ((x != y) | (x == ord("N")) | (y == ord("N"))).sum(axis=1)
            score = size - 2 * mism
            better = (mism <= max_diffs) & ((score > best) | ((score == best) & (mism < diffs)))
            best, where, diffs = (
                np.where(better, score, best), np.where(better, d, where), np.where(better, mism, diffs)
            )
        for k, row in enumerate(rows):
            if diffs[k] < 0:
                continue
            d = int(where[k])
            s1, s2 = max(d, 0), max(-d, 0)
            size = min(len1 - s1, len2 - s2)
            x, y = a[k, s1 : s1 + size], b[k, s2 : s2 + size]
            px, py = qa[k, s1 : s1 + size], qb[k, s2 : s2 + size]
            mid, qmid = np.where(px >= py, x, y), np.maximum(px, py)
            head, tail = a[k, :s1], b[k, s2 + size :]
            if d < 0 or d + len2 < len1:
                head, tail = head[:0] if d < 0 else head, tail[:0] if d + len2 < len1 else tail
            qhead = qa[k, : len(head)]
            qtail = qb[k, s2 + size : s2 + size + len(tail)]
            out["sequence"][row] = np.concatenate([head, mid, tail]).tobytes().decode()
            out["quality"][row] = np.concatenate([qhead, qmid, qtail]).tobytes().decode()
            out["overlap"][row], out["mismatches"][row] = int(size), int(diffs[k])
    return pd.DataFrame(out).astype({"overlap": "int32", "mismatches": "int32"})


def merge_mates(
    pairs: DataFrame, min_overlap: int = 10, max_diffs: int = 10, allow_stagger: bool = False,
    min_length: int = 20, max_n: int | None = 0,
) -> DataFrame:
    """Pairs joined over their best overlap: sequence, quality, overlap, mismatches.

    The higher score wins a mismatch. Pairs that do not overlap, short results and results
    with too many N are dropped.
    """

    @F.pandas_udf(MERGED)
    def join(r1: pd.Series, q1: pd.Series, r2: pd.Series, q2: pd.Series) -> pd.DataFrame:
        return _merge_batch(r1, q1, r2, q2, min_overlap, max_diffs, allow_stagger)

    rest = [c for c in pairs.columns if c not in ("r1_seq", "r1_qual", "r2_seq", "r2_qual", "r1_id")]
    merged = pairs.withColumn("_m", join.asNondeterministic()("r1_seq", "r1_qual", "r2_seq", "r2_qual")).select(*rest, "_m.*")
    merged = merged.where(F.col("sequence").isNotNull() & (F.length("sequence") >= min_length))
    if max_n is not None:
        ns = F.length("sequence") - F.length(F.replace("sequence", F.lit("N"), F.lit("")))
        merged = merged.where(ns <= max_n)
    return merged


def samples_without_merge(pairs: DataFrame, merged: DataFrame) -> DataFrame:
    """Samples of which no pair merged: reported and left out."""
    return pairs.select("sample").distinct().join(merged.select("sample").distinct(), "sample", "left_anti")
