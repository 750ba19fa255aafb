"""Operator 11: alignment of two tokenizers' tokens, merged in lockstep for all documents of a batch.

Tokenizer A is a byte-level file of the tokenizers library, B a sentencepiece model that puts a
space before the text; A therefore encodes a space and the text. Where tokens of both end at the
same byte there is a cut; the tokens between two cuts form a group and are linked, every A token
with every B token.

Both tokenizers cut before a single space between two other characters, so a text is encoded by
such units, each once per worker. One NumPy vector of (A, B) pointers walks all documents of a
batch at once: a step advances whichever token ends first (both at a cut), marks the cuts and
drops finished lanes. A lane is a document or, if that is long, a run of whole units of it, so
that one long document does not leave the vector almost empty.

How many documents hold an id pair linked is a sum over blocks of documents: a block sends each
of its distinct pairs once with the number of its documents, and gets the totals back. So the
most frequent pair is one row per block, whatever the number of documents or links.

Null, empty and unfaithful texts (joined token bytes differ from space and text) have no tokens:
zeros, and '' for the digest. Rows are documents; repeated and null ids stay rows of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import slices, stored
from tidemark.llm.tokens import local_path

#: A block of documents: so many characters and documents at most (a longer document is alone). It is
#: aligned in slices, which bound a worker's memory.
BLOCK_CHARS = 1 << 22
BLOCK_DOCS = 1 << 15
SLICE_CHARS = 1 << 19
#: Units that are encoded in one call.
LEARN_UNITS = 1 << 12
#: Units of a lane, units kept per worker, and group size from which links are counted by distinct ids.
LANE_UNITS = 64
KEPT_UNITS = 1 << 18
WIDE_GROUP = 1 << 12
#: An id pair is one number, the B id in the lower bits; both vocabularies are smaller than 2^20.
B_BITS = 20

_CUT = re.compile(r"(?<=\S) (?=\S)")
_OPEN: dict[tuple[str, str], Pair] = {}


def _byte_level() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + k)] = b
    return table


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start .. start + size - 1`` of every row, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. size - 1 as rows of bytes, left aligned, and their number."""
    texts = np.arange(size).astype("S")
    table = texts.view(np.uint8).reshape(size, -1)
    return table, (table != 0).sum(axis=1).astype(np.int64)


@dataclass
class Aligned:
    """Tokens and cuts of a block: flat ids, and for each document its share of them."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray


class Pair:
    """Two tokenizers of a worker and the units that they encoded lately."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(a_path)
        self.first.encode_special_tokens = True  # their strings inside a text are plain text
        self.second = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        self.a_bytes = [b""] * self.first.get_vocab_size()
        for token, i in self.first.get_vocab().items():
            if all(c in byte_of for c in token):
                self.a_bytes[i] = bytes(byte_of[c] for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.digits, self.n_digits = _digits(max(len(self.a_bytes), len(self.b_bytes)))
        self._clear()

    def _piece(self, i: int) -> bytes:
        if self.second.is_byte(i):
            return bytes([int(self.second.id_to_piece(i)[3:-1], 16)])
        return self.second.id_to_piece(i).replace("▁", " ").encode()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.odd: dict[str, int] = {}
        self.a_ids = self.b_ids = np.empty(0, np.int32)
        self.a_at = self.b_at = np.empty(0, np.int64)
        self.a_n = self.b_n = np.empty(0, np.int64)
        self.faithful = np.empty(0, bool)
        self.uses = np.empty(0, np.int64)

    def _learn(self, units: list[str]) -> np.ndarray:
        """Encode units and append them to the store; returns their numbers."""
        if not units:
            return np.empty(0, np.int64)
        parts: dict[str, list[np.ndarray]] = {"a_ids": [], "b_ids": [], "a_n": [], "b_n": []}
        good: list[bool] = []
        for at in range(0, len(units), LEARN_UNITS):
            own = units[at : at + LEARN_UNITS]
            spaced = [" " + u for u in own]
            a = [e.ids for e in self.first.encode_batch_fast(spaced, add_special_tokens=False)]
            b = self.second.encode(own, num_threads=1)
            ab, bb = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            good += [b"".join(map(ab, x)) == t.encode() == b"".join(map(bb, y)) for x, y, t in zip(a, b, spaced, strict=True)]
            for side, found in (("a", a), ("b", b)):
                parts[f"{side}_n"].append(np.fromiter(map(len, found), np.int64, len(found)))
                parts[f"{side}_ids"].append(np.fromiter(chain.from_iterable(found), np.int32))
        first = len(self.a_n)
        for name, values in parts.items():
            setattr(self, name, np.concatenate((getattr(self, name), *values)))
        self.a_at, self.b_at = np.cumsum(self.a_n) - self.a_n, np.cumsum(self.b_n) - self.b_n
        self.faithful = np.concatenate((self.faithful, np.array(good, bool)))
        self.uses = np.concatenate((self.uses, np.zeros(len(units), np.int64)))
        return np.arange(first, first + len(units))

    def _shrink(self) -> None:
        """Keep the most used units only; the bound is on memory, not on what is encoded."""
        if len(self.a_n) <= KEPT_UNITS and max(len(self.a_ids), len(self.b_ids)) <= 8 * KEPT_UNITS:
            return
        short = (self.a_n <= 32) & (self.b_n <= 32)
        best = np.argsort(np.where(short, -self.uses, 1), kind="stable")[: KEPT_UNITS // 2]
        best = np.sort(best[short[best]])
        new = np.full(len(self.a_n), -1)
        new[best] = np.arange(len(best))
        for side in "ab":
            n, at, ids = (getattr(self, f"{side}_{x}") for x in ("n", "at", "ids"))
            setattr(self, f"{side}_ids", ids[_ranges(at[best], n[best])])
            setattr(self, f"{side}_n", n[best])
            setattr(self, f"{side}_at", np.cumsum(n[best]) - n[best])
        self.faithful, self.uses = self.faithful[best], self.uses[best] // 2
        self.known = {u: int(new[k]) for u, k in self.known.items() if k >= 0 and new[k] >= 0}
        self.odd = {u: int(new[k]) for u, k in self.odd.items() if new[k] >= 0}

    def _units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, and how many each text has."""
        split = [t.split(" ") for t in texts]
        new = list(set().union(*split).difference(self.known))
        regular = [u for u in new if u and not u[0].isspace() and not u[-1].isspace()]
        self.known.update(dict.fromkeys(new, -1))
        self.known.update(zip(regular, self._learn(regular).tolist(), strict=True))
        get = self.known.__getitem__
        out = [np.fromiter(map(get, s), np.int64, len(s)) for s in split]
        del split
        uneven = [k for k, x in enumerate(out) if (x < 0).any()]  # more than one space, or other white space at a cut
        parts = {k: _CUT.split(texts[k]) for k in uneven}
        new = list(set().union(*parts.values()).difference(self.odd))
        self.odd.update(zip(new, self._learn(new).tolist(), strict=True))
        for k, s in parts.items():
            out[k] = np.fromiter(map(self.odd.__getitem__, s), np.int64, len(s))
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _joined(self, units: np.ndarray) -> tuple[bytes, bytes]:
        a = self.a_ids[_ranges(self.a_at[units], self.a_n[units])]
        b = self.b_ids[_ranges(self.b_at[units], self.b_n[units])]
        return b"".join(map(self.a_bytes.__getitem__, a)), b"".join(map(self.b_bytes.__getitem__, b))

    def align(self, texts: list[str | None]) -> Aligned:
        """Tokens and groups of every text; none for texts without tokens."""
        zero = np.zeros(len(texts), np.int64)
        real = np.array([k for k, t in enumerate(texts) if t], np.int64)
        empty = np.empty(0, np.int64)
        if not len(real):
            return Aligned(empty, empty, empty, empty, zero, zero, zero)
        self._shrink()
        units, held = self._units([texts[k] for k in real])
        np.add.at(self.uses, units, 1)
        bad = np.add.reduceat(~self.faithful[units], np.cumsum(held) - held) > 0
        for k in np.flatnonzero(bad):  # rare: judged by the whole text
            own = units[held[:k].sum() : held[: k + 1].sum()]
            plain = (" " + texts[real[k]]).encode()
            bad[k] = any(x != plain for x in self._joined(own))
        units, real, held = units[np.repeat(~bad, held)], real[~bad], held[~bad]
        if not len(real):
            return Aligned(empty, empty, empty, empty, zero, zero, zero)
        a = self.a_ids[_ranges(self.a_at[units], self.a_n[units])]
        b = self.b_ids[_ranges(self.b_at[units], self.b_n[units])]
        starts = np.cumsum(held) - held
        place = np.arange(len(units)) - np.repeat(starts, held)
        heads = np.flatnonzero(place % LANE_UNITS == 0)  # first unit of every lane
        a_lane, b_lane = (np.add.reduceat(n[units], heads) for n in (self.a_n, self.b_n))
        cut_a, cut_b = lockstep(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), a_lane, b_lane)
        a_end, b_end = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        n_a, n_b, n_groups = zero.copy(), zero.copy(), zero.copy()
        n_a[real], n_b[real] = (np.add.reduceat(n[units], starts) for n in (self.a_n, self.b_n))
        n_groups[real] = np.add.reduceat(cut_a.astype(np.int64), np.cumsum(n_a[real]) - n_a[real])
        return Aligned(a, b, np.diff(a_end, prepend=0), np.diff(b_end, prepend=0), n_a, n_b, n_groups)

    def written(self, x: Aligned) -> list[str]:
        """Per document the digest of ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        g_a, g_b = (np.repeat(np.arange(len(n)), n) for n in (x.group_a, x.group_b))
        last_a, last_b = np.cumsum(x.group_a), np.cumsum(x.group_b)
        at_a = np.arange(len(x.a)) + (last_b - x.group_b)[g_a]
        at_b = np.arange(len(x.b)) + last_a[g_b]
        ids = np.empty(len(x.a) + len(x.b), np.int32)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[at_a], ids[at_b] = x.a, x.b
        mark[at_a[last_a - 1]], mark[at_b[last_b - 1]] = ord("|"), ord(";")
        width = self.digits.shape[1]
        cells = np.zeros((len(ids), width + 1), np.uint8)
        cells[:, :width] = self.digits[ids]
        cells[np.arange(len(ids)), self.n_digits[ids]] = mark
        text = memoryview(cells[cells != 0])
        size = np.cumsum(self.n_digits[ids] + 1)
        ends = np.cumsum(x.n_a + x.n_b)
        out, start = [], 0
        for n, end in zip(x.n_a, ends, strict=True):
            if n:
                stop = int(size[end - 1])
                out.append(hashlib.sha256(text[start : stop - 1]).hexdigest())
                start = stop
            else:
                out.append("")
        return out


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_lane: np.ndarray, b_lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which A and which B tokens end at a cut.

    ``a_end`` and ``b_end`` are the tokens' end offsets, rising over all lanes; a lane has ``a_lane``
    and ``b_lane`` tokens, which end at the same byte. All lanes advance together.
    """
    cut_a, cut_b = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    stop = np.cumsum(a_lane)
    i, j = stop - a_lane, np.cumsum(b_lane) - b_lane
    while len(i):
        ea, eb = a_end[i], b_end[j]
        a_on, b_on = ea <= eb, eb <= ea
        both = a_on & b_on
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i, j = i + a_on, j + b_on
        going = i < stop  # a lane's last A and B tokens end together, so both pointers finish at once
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return cut_a, cut_b


def links(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, document, times)`` of all links: pair is ``a << B_BITS | b``.

    Wide groups are folded by distinct ids first, so a group never costs the square of its tokens.
    """
    of = np.repeat(np.arange(len(x.n_groups)), x.n_groups)
    a_at, b_at = np.cumsum(x.group_a) - x.group_a, np.cumsum(x.group_b) - x.group_b
    total = x.group_a * x.group_b
    wide = np.flatnonzero(total > WIDE_GROUP)
    small = np.flatnonzero(total <= WIDE_GROUP)
    size, n_b = total[small], x.group_b[small]
    k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    n_b = np.repeat(n_b, size)
    a = x.a[np.repeat(a_at[small], size) + k // n_b].astype(np.int64)
    b = x.b[np.repeat(b_at[small], size) + k % n_b]
    pairs, docs, times = [a << B_BITS | b], [np.repeat(of[small], size)], [np.ones(len(a), np.int64)]
    for g in wide:
        ua, ca = np.unique(x.a[a_at[g] : a_at[g] + x.group_a[g]], return_counts=True)
        ub, cb = np.unique(x.b[b_at[g] : b_at[g] + x.group_b[g]], return_counts=True)
        pairs.append((ua[:, None].astype(np.int64) << B_BITS | ub[None, :]).ravel())
        times.append((ca[:, None] * cb[None, :]).ravel())
        docs.append(np.full(len(ua) * len(ub), of[g]))
    return np.concatenate(pairs), np.concatenate(docs), np.concatenate(times)


def opened(a: str, b: str) -> Pair:
    """The two tokenizers of this worker, opened once."""
    if (a, b) not in _OPEN:
        _OPEN[a, b] = Pair(local_path(a), local_path(b))
    return _OPEN[a, b]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(doc_ids, texts) of consecutive documents, across batches, up to the size of a block."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text)
            size += len(text or "")
            if size >= BLOCK_CHARS or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_sizes, b_sizes)``: each document's tokens, and the tokens of each group.

    Links are the pairs within a group; cuts are the running sums of the sizes.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = opened(a, b)
        for ids, texts in _blocks(batches):
            x = pair.align(texts)
            ends = [np.cumsum(n)[:-1] for n in (x.n_a, x.n_b, x.n_groups, x.n_groups)]
            lists = [np.split(v, e) for v, e in zip((x.a, x.b, x.group_a, x.group_b), ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(v, pa.list_(pa.int32())) for v in lists)],
                ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"],
            )

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def _least(values: np.ndarray) -> np.ndarray:
    """The values in the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _folded(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``pair << 15 | document`` (BLOCK_DOCS fits 15 bits), ascending, with their summed times."""
    key = pairs << 15 | (docs + first)
    if len(times) and times.max() > 1:
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        return key[at], np.add.reduceat(times[order], at)
    key.sort()
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return key[at], np.diff(at, append=len(key))


_PER_DOC = {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string"}


def aligned_blocks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per block of documents: their figures, and the linked id pairs of the block.

    ``pairs`` are the distinct ones, ascending, ``held`` the number of documents that have each;
    ``places`` and ``times`` list these documents and how often each has the pair.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = opened(a, b)
        part = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_blocks(batches)):
            keys, counts, figures = [], [], []
            for low, high in slices([t or "" for t in texts], SLICE_CHARS):
                x = pair.align(texts[low:high])
                key, times = _folded(*links(x), low)
                n_links = np.bincount((key & 0x7FFF) - low, times, high - low).astype(np.int64)
                keys.append(key)
                counts.append(_least(times))
                figures.append((x.n_a, x.n_b, x.n_groups, n_links, pair.written(x)))
            key, times = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key, kind="stable")  # slices hold different documents, so keys differ
            key, times = key[order], times[order]
            pairs = key >> 15
            heads = np.flatnonzero(np.diff(pairs, prepend=-1))
            packed = [pairs[heads].astype("<i8"), _least(np.diff(heads, append=len(pairs))), (key & 0x7FFF).astype("<u2"), _least(times)]
            columns = [ids, *(np.concatenate(c) for c in list(zip(*figures, strict=True))[:4]), [d for f in figures for d in f[4]]]
            kinds = [pa.int64()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 33 | number], pa.int64()),
                    *(pa.array([list(c)], pa.list_(k)) for c, k in zip(columns, kinds, strict=True)),
                    *(pa.array([p.tobytes()], pa.binary()) for p in packed),
                ],
                ["block", *_PER_DOC, "pairs", "held", "places", "times"],
            )

    arrays = ", ".join(f"{c} array<{k}>" for c, k in _PER_DOC.items())
    schema = f"block long, {arrays}, pairs binary, held binary, places binary, times binary"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def _sized(data: bytes, n: int) -> np.ndarray:
    """Unsigned values of a packed column that has ``n`` of them."""
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(block, pair, held)``: each distinct pair of each block and how many of its documents have it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair = np.frombuffer(pairs, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(_sized(held, len(pair)))], ["block", "pair", "held"]
                )

    return blocks.select("block", "pairs", "held").mapInArrow(rows, "block long, pair long, held long")


def document_figures(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per document the size of its alignment, and how common its links are in the whole corpus.

    ``n_best`` counts links whose pair is in as many documents as any pair of the same A id,
    ``count_sum`` sums the links' document counts.
    """
    blocks = stored(aligned_blocks(docs, a, b), "aligned-blocks")
    asked = pair_counts(blocks)
    total = asked.groupBy("pair").agg(F.sum("held").alias("total"))
    # At most one row for each B id in a window, as pairs are distinct.
    same = Window.partitionBy(F.shiftright("pair", B_BITS))
    judged = total.withColumn("best", F.col("total") == F.max("total").over(same))
    answers = asked.join(judged, "pair").select("block", "pair", "total", "best")

    columns = [*list(_PER_DOC)[:-1], "n_best", "count_sum", "groups_sha256"]

    def figures(block: pa.Table, answer: pa.Table) -> pa.Table:
        out = {c: block.column(c).combine_chunks().flatten() for c in _PER_DOC}
        answer = answer.sort_by("pair")
        n, docs = len(answer), len(out["doc_id"])
        held = _sized(block.column("held")[0].as_py(), n)
        place = np.frombuffer(block.column("places")[0].as_py(), "<u2")
        times = _sized(block.column("times")[0].as_py(), len(place))
        best = np.repeat(answer.column("best").to_numpy(), held)
        product = times * np.repeat(answer.column("total").to_numpy(), held)
        # summed in two parts, as sums of floats are exact below 2^53 only
        low, high = (np.bincount(place, p, docs).astype(np.int64) for p in (product & 0xFFFFFF, product >> 24))
        out["n_best"] = pa.array(np.bincount(place, times * best, docs).astype(np.int64))
        out["count_sum"] = pa.array(low + (high << 24))
        return pa.table({c: out[c] for c in columns})

    schema = ", ".join(f"{c} {_PER_DOC.get(c, 'bigint')}" for c in columns)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(figures, schema)
