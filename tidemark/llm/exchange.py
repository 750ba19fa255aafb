"""Who else holds a token: documents' hashes exchanged by bucket, packed in arrays.

A document's tokens are 64-bit hashes. Rows for the shuffle are one per slice of
documents and bucket, with the tokens and their documents as arrays: about ``width + 2`` bytes
for each token instead of a row. Equal tokens meet in a bucket; the answers go back by document.
Buckets are as many as the session's shuffle partitions, which is what bounds a task's memory. A
token that many documents hold costs its bucket one entry for each of them, and no pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import mixed, parts, slices

SLICE = 1 << 22
#: From the columns of a slice of documents to the tokens of each.
Features = Callable[..., list[np.ndarray]]
#: Which tokens are answered: those that another document holds, that a document with a smaller id
#: holds, or that occur twice anywhere (``COUNTS``: with how often).
OTHERS, EARLIER, TWICE, COUNTS = "others", "earlier", "twice", "counts"


def pack_tokens(tokens: np.ndarray, width: int) -> bytes:
    """The upper ``width`` bytes of 64-bit tokens."""
    raw = np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8)
    return raw[:, 8 - width :].tobytes()


def unpack_tokens(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - width :] = raw
    return wide.view("<u8").reshape(-1)


def scatter(docs: DataFrame, features: Features, width: int, slice_size: int = SLICE) -> DataFrame:
    """Packed rows ``(bucket, ids, refs, tokens)``.

    ``docs`` has doc_id, a text or binary column and maybe more; ``features`` gets lists of these
    for a slice of documents and returns the tokens of each, distinct ones for ``OTHERS``.
    """
    buckets = parts(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for a, b in slices([t or "" for t in columns[0]], slice_size):
                found = features(*(c[a:b] for c in columns))
                flat = np.concatenate(found)
                ref = np.repeat(np.arange(b - a, dtype=np.uint32), [len(x) for x in found])
                of = ((mixed(flat) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(of, kind="stable")
                flat, ref, of = flat[order], ref[order], of[order]
                cuts = np.searchsorted(of, np.arange(buckets + 1))
                out = []
                for k in np.flatnonzero(np.diff(cuts)):
                    x, y = cuts[k], cuts[k + 1]
                    held, local = np.unique(ref[x:y], return_inverse=True)
                    small = "<u2" if len(held) < 1 << 16 else "<u4"
                    out.append((int(k), doc_ids[a:b][held].astype("<i8").tobytes(), local.astype(small).tobytes(), pack_tokens(flat[x:y], width)))
                if out:
                    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "ids", "refs", "tokens"]
                    )

    return docs.mapInArrow(rows, "bucket int, ids binary, refs binary, tokens binary")


def answers(packed: DataFrame, width: int, rule: str) -> DataFrame:
    """``(doc_id, tokens, firsts)``: one row for each document with tokens that the rule selects.

    ``firsts`` has for ``EARLIER`` the smallest id that holds each token, for ``COUNTS`` their
    number. Answers go back packed, too: one row per bucket and group of documents.
    """
    buckets = parts(packed.sparkSession)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, tokens = [], []
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], "<i8")
                token = unpack_tokens(row["tokens"], width)
                kind = "<u2" if len(row["refs"]) == 2 * len(token) else "<u4"
                docs.append(own[np.frombuffer(row["refs"], kind)])
                tokens.append(token)
        if not docs:
            return
        doc, token = np.concatenate(docs), np.concatenate(tokens)
        del docs, tokens
        order = np.lexsort((doc, token)) if rule == EARLIER else np.argsort(token)
        doc, token = doc[order], token[order]
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        sizes = np.diff(np.append(starts, len(token)))
        first = np.repeat(np.minimum.reduceat(doc, starts), sizes)
        if rule == EARLIER:
            keep = doc > first
        elif rule in (TWICE, COUNTS):
            first = np.repeat(sizes, sizes)
            keep = first > 1
        else:
            keep = np.repeat(np.maximum.reduceat(doc, starts), sizes) > first
        doc, token, first = doc[keep], token[keep], first[keep]
        for group, at in grouped(doc, buckets):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group], pa.int32()),
                    pa.array([doc[at].astype("<i8").tobytes()], pa.binary()),
                    pa.array([pack_tokens(token[at], width)], pa.binary()),
                    pa.array([first[at].astype("<i8").tobytes() if rule in (EARLIER, COUNTS) else b""], pa.binary()),
                ],
                ["bucket", "docs", "tokens", "firsts"],
            )

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        doc = np.concatenate([np.frombuffer(r["docs"], "<i8") for r in rows])
        raw = np.concatenate([np.frombuffer(r["tokens"], np.uint8) for r in rows]).reshape(-1, width)
        first = np.concatenate([np.frombuffer(r["firsts"], "<i8") for r in rows])
        del rows
        order = np.argsort(doc, kind="stable")
        doc, raw = doc[order], raw[order]
        first = first[order] if len(first) else first
        edges = np.append(np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), len(doc))
        for a in range(0, len(edges) - 1, 1 << 12):
            at = list(zip(edges[a : a + (1 << 12)], edges[a + 1 : a + 1 + (1 << 12)], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(doc[x]) for x, _ in at], pa.int64()),
                    pa.array([raw[x:y].tobytes() for x, y in at], pa.binary()),
                    pa.array([first[x:y].tobytes() for x, y in at], pa.binary()),
                ],
                ["doc_id", "tokens", "firsts"],
            )

    found = packed.repartition(buckets, "bucket").mapInArrow(meet, "bucket int, docs binary, tokens binary, firsts binary")
    return found.repartition(buckets, "bucket").mapInArrow(by_document, "doc_id long, tokens binary, firsts binary")


def grouped(doc: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, positions) of the groups by document hash that occur."""
    of = ((mixed(doc.astype(np.uint64)) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(groups + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k] : cuts[k + 1]]


def joined(tokens: bytes | None, width: int) -> np.ndarray:
    """The tokens of an answer; none where there was no answer."""
    return unpack_tokens(tokens, width) if tokens else np.empty(0, np.uint64)
