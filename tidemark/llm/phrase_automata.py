"""Operator 10: repeated passages, located in every document by Aho-Corasick automata.

1. Seeds. Each window of 13 words holds seven runs of seven words; the smallest of their hashes
   is the same wherever the window occurs. Seeds of one document only cannot belong to a repeated
   window. About a quarter of the words carry a seed.
2. Confirmed passages. Windows with a shared seed are exchanged by their own hash, and each
   document learns which of its windows start in an earlier one. Consecutive ones form passages.
3. Automata. Documents stream through tasks in slices. For each slice, a shard, one automaton is
   compiled from the confirmed passages of its documents (words are letters, so a node is a word),
   and every document of the slice runs through it. A shard needs only the passages that occur in
   it, so the work grows with the text and not with its square, and no list of passages is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import run_hashes, slices, stored, word_hashes
from tidemark.llm.exchange import EARLIER, OTHERS, answers, joined, scatter

WINDOW_WORDS = 13
SEED_WORDS = 7
#: Bytes kept of seeds, which only select, and of windows, which decide.
SEED_WIDTH, WINDOW_WIDTH = 6, 8


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def window_seeds(hashes: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The smallest seed hash in every window."""
    runs = run_hashes(hashes, seed)
    n = len(hashes) - window + 1
    out = runs[: max(n, 0)].copy()
    for i in range(1, window - seed + 1):
        np.minimum(out, runs[i : i + len(out)], out=out)
    return out


def document_seeds(text: str | None, window: int, seed: int) -> np.ndarray:
    return np.unique(window_seeds(word_hashes(split_words(text)), window, seed))


def shared_windows(text: str | None, seeds: bytes, window: int, seed: int) -> np.ndarray:
    """Distinct hashes of the windows whose seed another document holds."""
    hashes = word_hashes(split_words(text))
    low = np.uint64(8 * (8 - SEED_WIDTH))
    own = window_seeds(hashes, window, seed) >> low << low
    return np.unique(run_hashes(hashes, window)[np.isin(own, joined(seeds, SEED_WIDTH))])


def earlier_windows(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """``(doc_id, tokens, firsts)``: each document's windows that start in an earlier one."""
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    seeds = stored(
        answers(scatter(known, lambda t: [document_seeds(x, window, seed) for x in t], SEED_WIDTH), SEED_WIDTH, OTHERS),
        "phrase-seeds",
    ).select("doc_id", F.col("tokens").alias("seeds"))
    likely = known.join(seeds, "doc_id")
    packed = scatter(likely, lambda t, s: [shared_windows(*x, window, seed) for x in zip(t, s, strict=True)], WINDOW_WIDTH)
    return stored(answers(packed, WINDOW_WIDTH, EARLIER), "phrase-windows")


class _Letters:
    """Words of a shard as letters: one code point a word, or two if there are too many words."""

    PLAIN, HIGH, SURROGATES = 0x100, 0x20000, range(0xD800, 0xE000)

    def __init__(self, documents: Sequence[Sequence[bytes]]) -> None:
        words = dict.fromkeys(w for d in documents for w in d)
        self.size = 1 if len(words) < 1_000_000 else 2
        for i, w in enumerate(words):
            words[w] = self._plain(i) if self.size == 1 else chr(self.HIGH + i // 50_000) + self._plain(i % 50_000)
        self.get = words.__getitem__

    def _plain(self, i: int) -> str:
        code = self.PLAIN + i
        return chr(code if code < self.SURROGATES.start else code + len(self.SURROGATES))

    def spell(self, words: Sequence[bytes]) -> str:
        return "".join(map(self.get, words))


def passages_of(words: Sequence[bytes], tokens: np.ndarray, firsts: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(from, to, first document) of maximal runs of confirmed windows in a document.

    The first document of a passage is the largest among its windows, so a document with a
    larger id repeats every window of it.
    """
    hashes = run_hashes(word_hashes(words), window)
    order = np.argsort(tokens)
    at = np.searchsorted(tokens[order], hashes)
    at[at == len(tokens)] = 0
    hit = tokens[order][at] == hashes
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    first = firsts[order][at]
    return [(int(a), int(b) + window - 1, int(first[a:b].max())) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def locate(documents: Sequence[Sequence[bytes]], ids: Sequence[int | None], passages: dict[int, list[tuple[int, int, int]]]) -> list[np.ndarray]:
    """Per document which words a passage of an earlier document covers, by one automaton."""
    covered = [np.zeros(len(d), bool) for d in documents]
    if not passages:
        return covered
    letters = _Letters(documents)
    size = letters.size
    automaton = ahocorasick.Automaton()
    for i, found in passages.items():
        spelled = letters.spell(documents[i])
        for a, b, first in found:
            automaton.add_word(spelled[a * size : b * size], (b - a, first))
    automaton.make_automaton()
    for i, words in enumerate(documents):
        if ids[i] is None:
            continue
        steps = np.zeros(len(words) + 1, np.int64)
        for end, (length, first) in automaton.iter(letters.spell(words)):
            if first < ids[i]:
                last = (end + 1) // size
                steps[last - length] += 1
                steps[last] -= 1
        covered[i] = np.cumsum(steps[:-1]) > 0
    return covered


def _per_document(
    docs: DataFrame, windows: DataFrame, result: Callable[[list[bytes], np.ndarray], tuple], schema: str, names: list[str], window: int
) -> DataFrame:
    """Rows (doc_id, *result(words, covered)) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, tokens, firsts = (c.to_pylist() for c in batch.columns)
            for a, b in slices([t or "" for t in texts]):
                documents = [split_words(t) for t in texts[a:b]]
                passages = {
                    i: passages_of(documents[i], joined(tokens[a + i], WINDOW_WIDTH), np.frombuffer(firsts[a + i], "<i8"), window)
                    for i in range(b - a)
                    if tokens[a + i]
                }
                covered = locate(documents, ids[a:b], passages)
                out = [(i, *result(d, c)) for i, d, c in zip(ids[a:b], documents, covered, strict=True)]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) if any(x is not None for x in c) else pa.nulls(b - a, pa.int64()) for c in columns], names)

    marked = docs.select("doc_id", "text").join(windows.select(F.col("doc_id").alias("_id"), "tokens", "firsts"), F.col("doc_id") == F.col("_id"), "left")
    return marked.select("doc_id", "text", "tokens", "firsts").mapInArrow(rows, schema)


def repeated_words(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every document.

    A word goes if a window that covers it also starts in a document with a smaller id. Null,
    empty and blank texts have no words. Rows without doc_id lose nothing and give nothing; rows
    that repeat a doc_id are one document, whose windows are not earlier than themselves.
    """

    def digest(words: list[bytes], covered: np.ndarray) -> tuple[int, int, str]:
        kept = [words[i] for i in np.flatnonzero(~covered)] if covered.any() else words
        return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _per_document(docs, earlier_windows(docs, window), digest, schema, ["doc_id", "n_words", "n_removed", "kept_sha256"], window)


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``(doc_id, text)``: the kept words of every document, joined by one space."""

    def text(words: list[bytes], covered: np.ndarray) -> tuple[str]:
        return (b" ".join(words[i] for i in np.flatnonzero(~covered)).decode(),)

    return _per_document(docs, earlier_windows(docs, window), text, "doc_id long, text string", ["doc_id", "text"], window)
