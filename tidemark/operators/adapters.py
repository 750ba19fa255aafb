"""Placement of primers in reads with mismatches, insertions and deletions, a batch of reads at once.

A placement aligns ``k`` primer bases with ``l`` read bases at ``e`` errors, the edit distance of the two. Its
primer part is the whole primer, or, where the read ends inside the primer, the part that the
read can hold. It is allowed with at most ``rate * k`` errors and at least ``min_overlap`` bases. The best one
has most bases less twice the errors; then the least difference of ``l`` and ``k``, the leftmost start,
the leftmost stop, the fewest errors.

Whole primers are searched by bit-parallel edit distance: one 64-bit word per read holds a column of
the distance table, and a read base costs a dozen word operations for all reads of the batch. That
gives the errors of the best placement that stops at each base. Only at stops with the read's fewest errors
the start is resolved, in a band of the allowed length differences.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from tidemark.functions.sequences import IUPAC_SETS

_BIT = {"A": 1, "C": 2, "G": 4, "T": 8}
_FAR = np.int16(1 << 12)
_NO_KEY = np.iinfo(np.int64).max


def base_bits() -> np.ndarray:
    """One bit for each of the four bases, none for other characters."""
    table = np.zeros(256, dtype=np.uint8)
    for base, bit in _BIT.items():
        table[ord(base)] = table[ord(base.lower())] = bit
    return table


def primer_bits(primer: str) -> np.ndarray:
    """The bases that each position of a primer stands for."""
    return np.array([sum(_BIT[b] for b in IUPAC_SETS[c]) for c in primer.upper()], dtype=np.uint8)


def text_matrix(texts: pd.Series, width: int) -> np.ndarray:
    return np.array(texts.tolist(), dtype=f"S{max(width, 1)}").view(np.uint8).reshape(len(texts), -1)


def fewest_errors(bits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Errors of the best whole-primer placement that stops after each base of each read.

    ``bits`` has a read per row, zero where it has ended.
    """
    n, width = bits.shape
    m = len(wanted)
    if m > 64:
        raise ValueError("a primer has at most 64 bases")
    place = np.uint64(1) << np.arange(m, dtype=np.uint64)
    masks = np.array([place[(wanted & b) != 0].sum(dtype=np.uint64) for b in range(16)], dtype=np.uint64)
    one, last = np.uint64(1), np.uint64(m - 1)
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64)
    errors = np.full(n, m, dtype=np.int16)
    out = np.empty((n, width), dtype=np.int16)
    for j in range(width):
        equal = masks[bits[:, j]]
        zero = (((equal & up) + up) ^ up) | equal | down
        plus, minus = down | ~(zero | up), zero & up
        errors += ((plus >> last) & one).astype(np.int16)
        errors -= ((minus >> last) & one).astype(np.int16)
        plus, minus = plus << one, minus << one
        up, down = minus | ~(zero | plus), zero & plus
        out[:, j] = errors
    return out


def band_errors(text: np.ndarray, wanted: np.ndarray, band: int) -> np.ndarray:
    """Edit distances of ``wanted`` to the first ``l`` bases of each text, for ``l = k - band .. k + band``.

    ``text`` has at least ``k + band`` columns.
    """
    k, n = len(wanted), len(text)
    row = np.full((2 * band + 1, n), _FAR, dtype=np.int16)
    for d in range(band, 2 * band + 1):
        row[d] = d - band
    for i in range(1, k + 1):
        new = np.full_like(row, _FAR)
        for d in range(2 * band + 1):
            at = i + d - band  # read bases used
            if at < 0:
                continue
            best = row[d] + ((text[:, at - 1] & wanted[i - 1]) == 0) if at > 0 else row[d] + _FAR
            if d < 2 * band:
                best = np.minimum(best, row[d + 1] + np.int16(1))
            if d > 0:
                best = np.minimum(best, new[d - 1] + np.int16(1))
            new[d] = np.minimum(best, _FAR)
        row = new
    return row.T


def _windows(bits: np.ndarray, rows: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bases before each stop, backwards, zero before the read."""
    at = stops[:, None] - 1 - np.arange(size)
    return np.where(at >= 0, bits[rows[:, None], np.maximum(at, 0)], 0).astype(np.uint8)


def _keys(k: int, errors: np.ndarray, used: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sort key of placements: bases less twice the errors, length difference, start, stop, errors."""
    errors, start = errors.astype(np.int64), start.astype(np.int64)
    order = (256 - (k - 2 * errors)) << 6 | np.abs(used - k)
    return ((order << 20 | start) << 20 | (start + used)) << 6 | errors


class _Best:
    """The best placement so far of every read."""

    def __init__(self, n: int) -> None:
        self.key = np.full(n, _NO_KEY)

    def offer(self, rows: np.ndarray, k: int, errors: np.ndarray, used: np.ndarray, start: np.ndarray) -> None:
        np.minimum.at(self.key, rows, _keys(k, errors, used, start))


def _offer_parts(best: _Best, text: np.ndarray, room: np.ndarray, part: np.ndarray, band: int, front: bool) -> None:
    """Placements of a primer part at a read's edge; ``text`` runs inwards from that edge."""
    k = len(part)
    need = k + band
    if text.shape[1] < need:
        text = np.pad(text, ((0, 0), (0, need - text.shape[1])))
    if band == 0:
        ok = np.ones(len(text), dtype=bool)
        for i in range(k):
            ok &= (text[:, i] & part[i]) != 0
        errors = np.where(ok, 0, _FAR).astype(np.int16)[:, None]
    else:
        errors = band_errors(text, part, band)
    used = k + np.arange(-band, band + 1)
    rows, which = np.nonzero((errors <= band) & (used[None, :] <= room[:, None]) & (used[None, :] > 0))
    if len(rows):
        taken = used[which]
        best.offer(rows, k, errors[rows, which], taken, np.zeros_like(taken) if front else room[rows] - taken)


def locate(reads: pd.Series, primer: str, end: str, rate: float, min_overlap: int) -> pd.DataFrame:
    """``(start, stop, errors)`` of the best placement in each read, -1 where there is none.

    ``front`` lets the read start inside the primer, ``back`` lets it end inside, ``anchored`` wants
    the whole primer from the first base.
    """
    texts = reads.fillna("")
    lengths = texts.str.len().to_numpy()
    n, m, width = len(texts), len(primer), int(lengths.max()) if len(texts) else 0
    best = _Best(n)
    if n and width:
        bits = base_bits()[text_matrix(texts, width)]
        wanted = primer_bits(primer)
        allowed = [int(np.floor(rate * k + 1e-9)) for k in range(m + 1)]
        if end == "anchored":
            if m >= min_overlap:
                _offer_parts(best, bits, lengths, wanted, allowed[m], front=True)
        else:
            if m >= min_overlap:
                _offer_whole(best, bits, lengths, wanted, allowed[m])
            # inwards from the edge where the read may end inside the primer
            front = end == "front"
            text = bits if front else _windows(bits, np.arange(n), lengths, min(width, m + allowed[m]))
            for k in range(max(1, min_overlap), m):
                part = wanted[m - k :] if front else wanted[:k][::-1]
                _offer_parts(best, text, lengths, part, allowed[k], front)
    found = best.key != _NO_KEY
    parts = {"start": best.key >> 26 & 0xFFFFF, "stop": best.key >> 6 & 0xFFFFF, "errors": best.key & 63}
    return pd.DataFrame({c: np.where(found, v, -1) for c, v in parts.items()}).astype("int32")


def _offer_whole(best: _Best, bits: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, band: int) -> None:
    """Placements of the whole primer anywhere in the read."""
    m = len(wanted)
    errors = fewest_errors(bits, wanted)
    errors[np.arange(bits.shape[1])[None, :] >= lengths[:, None]] = _FAR
    least = errors.min(axis=1)
    rows, stops = np.nonzero((errors == least[:, None]) & (least <= band)[:, None])
    if not len(rows):
        return
    stops = stops + 1
    exact = band_errors(_windows(bits, rows, stops, m + band), wanted[::-1], band)
    used = m + np.arange(-band, band + 1)
    at, which = np.nonzero((exact == least[rows][:, None]) & (used[None, :] <= stops[:, None]))
    taken = used[which]
    best.offer(rows[at], m, exact[at, which], taken, stops[at] - taken)
