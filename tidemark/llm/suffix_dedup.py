"""Operator 6: repeated byte strings, by prefix doubling over sampled suffix positions.

Doubling over every byte would sort each position of the corpus several times. Equal strings of
``threshold`` bytes also agree in their minimizers, the positions with the smallest hash among
``window`` neighbours, so suffixes are ranked at these anchors only:

1. Doubling. The first rank of an anchor names the phrase up to the next anchor. A round joins
   the ranks of an anchor and of the one 1, 2, 4, ... anchors on, sorts the pairs by bucket and
   ranks them anew. An anchor whose pair is unique leaves; one whose next pair would pass the bytes
   that every repeated string shares stays as it is.
2. Segments. String starts between the same first and last anchors form a segment. Segments
   whose text as a whole occurs twice are repeated; one that differs at its ends only in part.
3. Ends. Every start of a partly repeated segment is looked up by the hash of its own string, so
   the result is exact to the byte. Wholly repeated text takes part by one segment of each kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.llm.common import mixed, parts, slices, stored
from tidemark.llm.exchange import TWICE, answers, grouped, joined, scatter

THRESHOLD = 400
GRAM, WINDOW = 16, 96
#: Bytes handled together; a longer text is handled by itself.
SLICE = 1 << 20
NAME_WIDTH = 7
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    return np.concatenate((np.ones(1, _U), np.cumprod(np.full((1 << bits) - 1, base, _U), dtype=_U)))


class Substrings:
    """Hashes of any substrings of bytes, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray) -> None:
        bits = max(21, (len(data) + 1).bit_length())
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_LETTERS[data] * _powers(_BASE, bits)[: len(data)], out=self.sums[1:])
        self.inverse = _powers(_BASE_INVERSE, bits)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def minimizers(data: np.ndarray, gram: int, window: int) -> np.ndarray:
    """For every start, the first position of the smallest gram hash among ``window`` grams."""
    n = len(data) - gram + 1
    if n < window:
        return np.empty(0, np.int64)
    h = _LETTERS[data]
    size = 1
    while size < gram:  # the hash of 2, 4, 8, ... bytes
        h = (h[: len(h) - size] * _U(_BASE)) ^ (h[size:] + (h[size:] >> _U(29)))
        size *= 2
    best = (mixed(h) & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=_U)
    size = 1
    while 2 * size <= window:
        best = np.minimum(best[: len(best) - size], best[size:])
        size *= 2
    rest = window - size
    if rest:
        best = np.minimum(best[: len(best) - rest], best[rest:])
    return (best & _U(0xFFFFFFFF)).astype(np.int64)


def _anchored(texts: list[str | None], threshold: int):
    """For each document of a slice: (bytes, first byte in the slice, minimizers or None); hashes."""
    raw = [(t or "").encode() for t in texts]
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    if all(len(r) < threshold for r in raw):
        return raw, [None] * len(raw), None
    nearest = minimizers(flat, GRAM, WINDOW)
    out = []
    for r, end in zip(raw, ends, strict=True):
        start = int(end) - len(r)
        out.append(nearest[start : end - GRAM - WINDOW + 2] - start if len(r) >= threshold else None)
    return raw, out, Substrings(flat)


def _starts(raw: list[bytes]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum([len(r) for r in raw])[:-1]))


def _changes(*values: np.ndarray) -> np.ndarray:
    """First index of every run in which none of the arrays changes."""
    new = np.ones(len(values[0]), bool)
    new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
    return np.flatnonzero(new)


def anchor_names(docs: DataFrame, threshold: int) -> DataFrame:
    """``(doc_id, pos, rank)``: anchors of every document and the names of their phrases."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([t or "" for t in texts], SLICE):
                raw, nearest, hashes = _anchored(texts[a:b], threshold)
                out = []
                for i, first in enumerate(_starts(raw)):
                    if nearest[i] is None:
                        continue
                    pos = nearest[i][_changes(nearest[i])]
                    names = hashes.of(pos[:-1] + first, pos[1:] + first + GRAM)
                    names = np.append(names, _U(0))  # the last anchor ends the last phrase
                    out.append((ids[a + i], pos.astype("<i4").tobytes(), names.astype("<u8").tobytes()))
                if out:
                    columns = zip(*out, strict=True)
                    kinds = [pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "pos", "rank"])

    return docs.mapInArrow(rows, "doc_id long, pos binary, rank binary")


def _pairs(pos: bytes, rank: bytes, step: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, names of their pairs, anchors that end as unique) in the round of ``step``.

    Step 0 names the phrases themselves.
    """
    at, r = np.frombuffer(pos, "<i4"), np.frombuffer(rank, "<u8")
    live = np.flatnonzero(r[:-1] != 0)
    if not step:
        return live, r[live], live[:0]
    live = live[live + 2 * step < len(at)]
    live = live[at[live + 2 * step] - at[live] <= span]
    mate = r[live + step]
    gone = live[mate == 0]
    live = live[mate != 0]
    return live, mixed(r[live] * _U(_BASE) + (r[live + step] >> _U(7)) + _U(step)), gone


def _ranked(state: DataFrame, found: DataFrame, step: int, span: int, seen: Observation) -> DataFrame:
    """State after a round: pairs that the answers hold get a new rank, unique ones rank 0."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, pos, rank, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                live, names, gone = _pairs(pos, rank, step, span)
                low = _U(8 * (8 - NAME_WIDTH))
                hit = np.isin(names >> low << low, joined(tokens, NAME_WIDTH))
                new = np.frombuffer(rank, "<u8").copy()
                new[live] = np.where(hit, names | _U(1), _U(0))
                new[gone] = 0
                if new.any():
                    data = new.tobytes()
                    out.append((doc_id, pos, data, len(_pairs(pos, data, max(1, 2 * step), span)[0])))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "pos", "rank", "open"])

    # In the first round a document without any answer has no repeated phrase.
    joined_ = state.join(found.select("doc_id", "tokens"), "doc_id", "left" if step else "inner")
    ranked = joined_.select("doc_id", "pos", "rank", "tokens").mapInArrow(rows, "doc_id long, pos binary, rank binary, open long")
    return stored(ranked.observe(seen, F.sum("open").alias("open")), "suffix-ranks").drop("open")


def repeated_anchors(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, pos, rank)`` of documents with anchors from which a repeated run starts.

    Rank 0 marks unique ones. Rounds go on while a pair fits in the bytes that every repeated
    string shares between its first and last anchor.
    """
    span = threshold - GRAM - 2 * WINDOW + 2
    state, step = stored(anchor_names(docs, threshold), "suffix-anchors"), 0
    while True:
        pairs = lambda pos, rank, s=step: [_pairs(p, r, s, span)[1] for p, r in zip(pos, rank, strict=True)]
        found = answers(scatter(state, pairs, NAME_WIDTH), NAME_WIDTH, TWICE)
        seen = Observation()
        state = _ranked(state, found, step, span, seen)
        step = max(1, 2 * step)
        if not seen.get["open"]:
            return state


def _segments(nearest: np.ndarray, n: int, live: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """(first start, last start, first anchor, last anchor) of the segments with a live anchor."""
    reach = threshold - GRAM - WINDOW + 1
    first, last = nearest[: n - threshold + 1], nearest[reach : reach + n - threshold + 1]
    at = _changes(first, last)
    until = np.append(at[1:], len(first)) - 1
    keep = np.isin(first[at], live)
    return at[keep], until[keep], first[at[keep]], last[at[keep]]


def _keys(nearest, first, n, live, hashes, threshold):
    """Segments with the hash of what all their strings share and of their whole text."""
    a, b, f, g = _segments(nearest, n, live, threshold)
    core = hashes.of(f + first, g + first + GRAM)
    whole = mixed(hashes.of(a + first, b + first + threshold) + (f - a).astype(_U) * _U(_BASE) + core)
    return a, b, core, whole


def _live(pos: bytes, rank: bytes) -> np.ndarray:
    return np.frombuffer(pos, "<i4").astype(np.int64)[np.frombuffer(rank, "<u8") != 0]


WHOLE, WHOLE_SHOWN, PART = 1, 2, 3


def _segment_codes(likely: DataFrame, threshold: int) -> DataFrame:
    """``(doc_id, keys, codes)``: what the exchange by shared text says of each segment.

    ``WHOLE``: its whole text occurs twice; ``WHOLE_SHOWN``: the same, and its strings stand for
    all copies where a partly different segment asks; ``PART``: its strings must be looked up.
    """
    buckets = parts(likely.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, pos, rank = (c.to_pylist() for c in batch.columns)
            for a, b in slices([t or "" for t in texts], SLICE):
                raw, nearest, hashes = _anchored(texts[a:b], threshold)
                docs, cores, wholes = [], [], []
                for i, first in enumerate(_starts(raw)):
                    if nearest[i] is not None:
                        _, _, core, whole = _keys(nearest[i], first, len(raw[i]), _live(pos[a + i], rank[a + i]), hashes, threshold)
                        docs.append(np.full(len(core), ids[a + i], np.int64))
                        cores.append(core)
                        wholes.append(whole)
                if not docs:
                    continue
                doc, core, whole = np.concatenate(docs), np.concatenate(cores), np.concatenate(wholes)
                of = ((mixed(core) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
                order = np.argsort(of, kind="stable")
                cuts = np.searchsorted(of[order], np.arange(buckets + 1))
                rows = [
                    (int(k), doc[at].tobytes(), core[at].tobytes(), whole[at].tobytes())
                    for k in np.flatnonzero(np.diff(cuts))
                    for at in [order[cuts[k] : cuts[k + 1]]]
                ]
                if rows:
                    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["bucket", "docs", "cores", "wholes"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for column, kind, into in zip(batch.columns[1:], ("<i8", "<u8", "<u8"), got, strict=True):
                into += [np.frombuffer(x, kind) for x in column.to_pylist()]
        if not got[0]:
            return
        doc, core, whole = (np.concatenate(x) for x in got)
        order = np.lexsort((doc, whole, core))
        doc, core, whole = doc[order], core[order], whole[order]
        new_core = np.concatenate(([True], core[1:] != core[:-1]))
        new_whole = new_core | np.concatenate(([True], whole[1:] != whole[:-1]))
        size = lambda new: np.repeat(np.diff(np.append(np.flatnonzero(new), len(new))), np.diff(np.append(np.flatnonzero(new), len(new))))
        of_core, of_whole = size(new_core), size(new_whole)
        asks = np.logical_or.reduceat(of_whole == 1, np.flatnonzero(new_core))[np.cumsum(new_core) - 1]
        first_doc = doc[np.flatnonzero(new_whole)][np.cumsum(new_whole) - 1]
        code = np.where(of_whole > 1, np.where(asks & (doc == first_doc), WHOLE_SHOWN, WHOLE), PART)
        keep = of_core > 1
        doc, whole, code = doc[keep], whole[keep], code[keep].astype(np.uint8)
        for group, at in grouped(doc, buckets):
            yield pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), *(pa.array([x[at].tobytes()], pa.binary()) for x in (doc, whole, code))],
                ["bucket", "docs", "keys", "codes"],
            )

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        doc, whole, code = (
            np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("docs", "<i8"), ("keys", "<u8"), ("codes", np.uint8))
        )
        order = np.argsort(doc, kind="stable")
        doc, whole, code = doc[order], whole[order], code[order]
        edges = np.append(np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), len(doc))
        out = [(int(doc[x]), whole[x:y].tobytes(), code[x:y].tobytes()) for x, y in zip(edges[:-1], edges[1:], strict=True)]
        for a in range(0, len(out), 1 << 12):
            columns = zip(*out[a : a + (1 << 12)], strict=True)
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "keys", "codes"])

    sent = likely.select("doc_id", "text", "pos", "rank").mapInArrow(send, "bucket int, docs binary, cores binary, wholes binary")
    found = sent.repartition(buckets, "bucket").mapInArrow(meet, "bucket int, docs binary, keys binary, codes binary")
    return found.repartition(buckets, "bucket").mapInArrow(by_document, "doc_id long, keys binary, codes binary")


def _coded(whole: np.ndarray, keys: bytes, codes: bytes) -> np.ndarray:
    """The code of each segment; 0 for one that nothing repeats."""
    known, code = np.frombuffer(keys, "<u8"), np.frombuffer(codes, np.uint8)
    order = np.argsort(known)
    at = np.minimum(np.searchsorted(known[order], whole), len(known) - 1)
    return np.where(known[order][at] == whole, code[order][at], 0)


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All integers of the ranges a..b, both included."""
    sizes = b - a + 1
    return np.repeat(a - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum()) if len(a) else a


def removed_ranges(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, text, spans)``: (start, end) bytes to remove, for documents that lose any."""
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    anchors = repeated_anchors(known, threshold)
    likely = stored(known.join(anchors, "doc_id"), "suffix-likely")
    codes = stored(_segment_codes(likely, threshold), "suffix-segments")
    coded = likely.join(codes, "doc_id")

    def strings(texts, pos, rank, keys, codes):
        out = []
        for a, b in slices([t or "" for t in texts], SLICE):
            raw, nearest, hashes = _anchored(texts[a:b], threshold)
            for i, first in enumerate(_starts(raw)):
                if nearest[i] is None:
                    out.append(np.empty(0, _U))
                    continue
                x, y, _, whole = _keys(nearest[i], first, len(raw[i]), _live(pos[a + i], rank[a + i]), hashes, threshold)
                code = _coded(whole, keys[a + i], codes[a + i])
                shown, part = (_spread(x[code == c], y[code == c]) + first for c in (WHOLE_SHOWN, PART))
                of = lambda s: hashes.of(s, s + threshold)
                out.append(np.concatenate((np.repeat(of(shown), 2), of(part))))
        return out

    found = answers(scatter(coded.select("doc_id", "text", "pos", "rank", "keys", "codes"), strings, 8, SLICE), 8, TWICE)
    marked = coded.join(stored(found, "suffix-strings").select("doc_id", "tokens"), "doc_id", "left")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for a, b in slices([t or "" for t in columns[1]], SLICE):
                ids, texts, pos, rank, keys, codes, tokens = (c[a:b] for c in columns)
                raw, nearest, hashes = _anchored(texts, threshold)
                out = []
                for i, first in enumerate(_starts(raw)):
                    if nearest[i] is None:
                        continue
                    x, y, _, whole = _keys(nearest[i], first, len(raw[i]), _live(pos[i], rank[i]), hashes, threshold)
                    code = _coded(whole, keys[i], codes[i])
                    sure = (code == WHOLE) | (code == WHOLE_SHOWN)
                    part = _spread(x[code == PART], y[code == PART])
                    hit = np.isin(hashes.of(part + first, part + first + threshold), joined(tokens[i], 8))
                    steps = np.zeros(len(raw[i]) + 1, np.int64)
                    np.add.at(steps, np.concatenate((x[sure], part[hit])), 1)
                    np.add.at(steps, np.concatenate((y[sure], part[hit])) + threshold, -1)
                    gone = np.concatenate(([0], (np.cumsum(steps[:-1]) > 0).view(np.int8), [0]))
                    edges = np.flatnonzero(np.diff(gone))
                    if len(edges):
                        out.append((ids[i], texts[i], edges.astype("<i4").tobytes()))
                if out:
                    kinds = [pa.int64(), pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "text", "spans"])

    order = ["doc_id", "text", "pos", "rank", "keys", "codes", "tokens"]
    return marked.select(*order).mapInArrow(spans, "doc_id long, text string, spans binary")


def cut(text: str | None, spans: bytes) -> bytes:
    """The bytes that remain."""
    data, edges = (text or "").encode(), np.frombuffer(spans, "<i4").tolist()
    return b"".join(data[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(data)], strict=True))


def byte_digests(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document.

    A byte goes if a string of ``threshold`` bytes that covers it starts at another place, too, in
    this or another document. Null and empty texts and shorter ones lose nothing. Rows without
    doc_id keep their text and take no part. Rows that repeat a doc_id are texts of their own; as
    copies they lose what they share, and differing ones are told apart by their text.
    """
    whole = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, kept = (text or "").encode(), cut(text, spans)
                out.append((doc_id, hashlib.sha256(data).hexdigest(), len(data) - len(kept), len(spans) // 8, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            names = ["_id", "_of", "_removed", "_spans", "_kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    lost = removed_ranges(docs, threshold).mapInArrow(digest, "_id long, _of string, _removed long, _spans long, _kept string")
    lost = stored(lost, "suffix-lost").dropDuplicates(["_id", "_of"])
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_sha") == F.col("_of"))
    zero = F.lit(0).cast("long")
    return whole.join(lost, same, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("_removed", zero).alias("n_removed"),
        F.coalesce("_spans", zero).alias("n_spans"),
        F.coalesce("_kept", "_sha").alias("kept_sha256"),
    )
