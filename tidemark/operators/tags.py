"""Demultiplexing by tags with ambiguity codes, behind a spacer of a few bases.

A tag's ambiguity codes are expanded to the texts that it stands for. Every window of a tag length at every
allowed place of a mate is a number of two bits a base (a hash, verified on the text, beyond 31 bases); all
reads of a batch look theirs up in the sorted numbers of their library. A pair belongs to the sample whose
tag both mates hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.sequences import IUPAC_SETS, reverse_complement_text

#: Bound of the tag sheet: texts that all tags stand for together.
MAX_TEXTS = 1 << 20
EXACT_BASES = 31
ASSIGNED, AMBIGUOUS, UNMATCHED = "assigned", "ambiguous", "unmatched"
_CODE = np.full(256, 4, np.uint8)
for _k, _b in enumerate("ACGT"):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _k


def _factor(length: int) -> np.uint64:
    return np.uint64(4 if length <= EXACT_BASES else 0x9E3779B97F4A7C15)


def expanded(tag: str) -> np.ndarray:
    """Numbers of all texts that a tag stands for."""
    out = np.zeros(1, np.uint64)
    for base in tag.upper():
        if base not in IUPAC_SETS:
            raise ValueError(f"tag {tag!r} holds {base!r}, which is no IUPAC code")
        out = (out[:, None] * _factor(len(tag)) + np.array(["ACGT".index(b) for b in IUPAC_SETS[base]], np.uint64)).ravel()
    return out


def _pattern(tag: str) -> str:
    return "".join(f"[{IUPAC_SETS[b]}]" for b in tag.upper())


class TagSheet:
    """Tags ``(library, sample, tag)`` ready for lookups; samples named ``unknown`` are left out."""

    def __init__(self, rows: list[tuple[str | None, str, str]]) -> None:
        self.samples = [r for r in rows if r[1] is not None and r[1].lower() != "unknown" and r[2]]
        self.libraries = {lib: k for k, lib in enumerate(sorted({r[0] for r in rows if r[0] is not None}))}
        sizes = [int(np.prod([len(IUPAC_SETS.get(b, "A")) for b in t.upper()], dtype=float)) for _, _, t in self.samples]
        if sum(sizes) > MAX_TEXTS:
            raise ValueError(f"tags stand for more than {MAX_TEXTS} texts")
        self.lengths = sorted({len(t) for _, _, t in self.samples})
        self.tables: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {n: {} for n in self.lengths}
        for n in self.lengths:
            per: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for k, (lib, _, tag) in enumerate(self.samples):
                if len(tag) == n and lib in self.libraries:
                    keys = expanded(tag)
                    per.setdefault(self.libraries[lib], []).append((keys, np.full(len(keys), k)))
            for lib, parts in per.items():
                keys, who = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.argsort(keys, kind="stable")
                self.tables[n][lib] = (keys[order], who[order])
        self.ahead = [re.compile(_pattern(t), re.IGNORECASE) for _, _, t in self.samples]
        self.behind = [re.compile(_pattern(reverse_complement_text(t)) + r"\Z", re.IGNORECASE) for _, _, t in self.samples]

    def found(self, reads: list[str], libraries: np.ndarray, spacer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(read, sample, offset) of every tag within the first ``spacer`` bases, the first place of each."""
        rows, samples, offsets = [], [], []
        width = spacer + max(self.lengths, default=0)
        codes = np.full((len(reads), width), 4, np.uint8)
        for i, read in enumerate(reads):
            own = np.frombuffer(read[:width].encode(), np.uint8)
            codes[i, : len(own)] = _CODE[own]
        good = codes < 4
        for n, per in self.tables.items():
            for offset in range(spacer + 1):
                part = codes[:, offset : offset + n]
                number, factor = np.zeros(len(reads), np.uint64), _factor(n)
                for j in range(part.shape[1]):
                    number = number * factor + (part[:, j] & 3)
                whole = good[:, offset : offset + n].all(axis=1)
                for lib, (keys, who) in per.items():
                    at = np.flatnonzero(whole & (libraries == lib))
                    low, high = (np.searchsorted(keys, number[at], side) for side in ("left", "right"))
                    count = high - low
                    read = at[np.repeat(np.arange(len(at)), count)]
                    sample = who[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
                    if n > EXACT_BASES:
                        real = [bool(self.ahead[s].match(reads[i], offset)) for i, s in zip(read, sample, strict=True)]
                        read, sample = read[np.array(real, bool)], sample[np.array(real, bool)]
                    rows.append(read)
                    samples.append(sample)
                    offsets.append(np.full(len(read), offset))
        if not rows:
            return (np.empty(0, np.int64),) * 3
        read, sample, offset = (np.concatenate(c) for c in (rows, samples, offsets))
        order = np.lexsort((offset, sample, read))
        read, sample, offset = read[order], sample[order], offset[order]
        first = np.ones(len(read), bool)
        first[1:] = (np.diff(read) != 0) | (np.diff(sample) != 0)
        return read[first], sample[first], offset[first]

    def assign(self, r1: list[str], r2: list[str], libraries: list, spacer: int) -> tuple[np.ndarray, ...]:
        """Per pair the sample (-1: none, -2: several equally good) and its offsets in both mates.

        The least sum of offsets counts, then the longest tag.
        """
        n, total = len(r1), max(1, len(self.samples))
        lib = np.array([self.libraries.get(x, -1) for x in libraries], np.int64)
        one, two = self.found(r1, lib, spacer), self.found(r2, lib, spacer)
        _, a, b = np.intersect1d(one[0] * total + one[1], two[0] * total + two[1], assume_unique=True, return_indices=True)
        read, sample = one[0][a], one[1][a]
        size = np.array([len(t) for _, _, t in self.samples], np.int64)
        names = np.array([f"{x[0]}\n{x[1]}" for x in self.samples] or [""])
        longest = int(size.max(initial=0))
        cost = (one[2][a] + two[2][b]) * (longest + 1) + longest - size[sample]
        order = np.lexsort((sample, cost, read))
        out, first_1, first_2 = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in order[::-1]:  # the best of each read is written last
            out[read[k]], first_1[read[k]], first_2[read[k]] = sample[k], one[2][a[k]], two[2][b[k]]
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, read, cost)
        rival = (cost == best[read]) & (names[sample] != names[np.maximum(out[read], 0)])
        out[read[rival]] = -2
        return out, first_1, first_2


def read_tags(tags: DataFrame) -> TagSheet:
    """The tag sheet, which a lab fills by hand: bounded by ``MAX_TEXTS``, so it goes to every task."""
    rows = tags.select("library", "sample", "tag").limit(MAX_TEXTS + 1).collect()
    return TagSheet([tuple(r) for r in rows])


def assign_tags(pairs: DataFrame, tags: DataFrame, max_spacer: int = 5) -> DataFrame:
    """``pairs`` with ``sample`` and ``tag_status``; tags, spacers and what lies before them are cut.

    A tag may start at any of the first ``max_spacer`` bases behind the read's start. Its reverse complement at the
    end of a mate is cut, too. Pairs are ``ambiguous`` when tags of two samples fit equally well, and
    ``unmatched`` without a tag in both mates; both stay whole and have no sample.
    """
    sheet = pairs.sparkSession.sparkContext.broadcast(read_tags(tags))
    columns = [c for c in pairs.columns if c not in ("sample", "tag_status")]
    places = {c: columns.index(c) for c in ("library", "r1_seq", "r1_qual", "r2_seq", "r2_qual")}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = sheet.value
        for batch in batches:
            values = {c: batch.column(k).to_pylist() for c, k in places.items()}
            reads = [[s or "" for s in values[f"r{i}_seq"]] for i in (1, 2)]
            sample, *offsets = tags.assign(*reads, values["library"], max_spacer)
            names: list[str | None] = [None] * len(sample)
            status = [UNMATCHED] * len(sample)
            for k in np.flatnonzero(sample != -1).tolist():
                if sample[k] == -2:
                    status[k] = AMBIGUOUS
                    continue
                tag = tags.samples[sample[k]]
                names[k], status[k] = tag[1], ASSIGNED
                for i in (1, 2):
                    text = reads[i - 1][k]
                    start = int(offsets[i - 1][k]) + len(tag[2])
                    behind = tags.behind[sample[k]].search(text, start)
                    stop = behind.start() if behind else len(text)
                    for part in ("seq", "qual"):
                        if values[f"r{i}_{part}"][k] is not None:
                            values[f"r{i}_{part}"][k] = values[f"r{i}_{part}"][k][start:stop]
            arrays = list(batch.columns)
            for c, at in places.items():
                if c != "library":
                    arrays[at] = pa.array(values[c], pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(names, pa.string()), pa.array(status, pa.string())], [*columns, "sample", "tag_status"])

    added = [StructField("sample", StringType()), StructField("tag_status", StringType())]
    return pairs.select(*columns).mapInArrow(rows, StructType([*[pairs.schema[c] for c in columns], *added]))


def demultiplex(pairs: DataFrame, tags: DataFrame, max_spacer: int = 5) -> DataFrame:
    """Pairs with the sample whose tag both mates hold, without their tags; others are dropped."""
    return assign_tags(pairs, tags, max_spacer).where(F.col("tag_status") == ASSIGNED).drop("tag_status")


def tag_report(pairs: DataFrame, tags: DataFrame, max_spacer: int = 5) -> DataFrame:
    """``(library, assigned, ambiguous, unmatched)``: how many pairs became what."""
    marked = assign_tags(pairs, tags, max_spacer)
    count = [F.count(F.when(F.col("tag_status") == s, 1)).alias(s) for s in (ASSIGNED, AMBIGUOUS, UNMATCHED)]
    return marked.groupBy("library").agg(*count)
