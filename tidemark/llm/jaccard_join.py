"""Operator 3: documents whose 5-word shingle sets have a Jaccard similarity of 0.8 or more.

1. Screen. Of each set the smallest hashes, the prefix for ``n // 10`` common tokens, go to
   buckets by hash, packed in arrays. A document of a pair shares ``least_shared(n)`` of them
   with its partner, so one whose prefix tokens occur too rarely elsewhere has no partner. What is
   left are sets that others hold mostly, one for each group of equal sets; for these the tokens
   are counted. A token that only one set holds bounds what it can share with any other.
2. Multiple-global-order filtering. In the first order rarer tokens come first; the other orders
   are hashes. Each set's prefixes in the other orders are kept beside it, in 32 bits a token. A pair that
   met in the first order must share a prefix token in each of the others, too; only what passes all
   filters fetches its sets.
3. No pairs within a group. A bucket of the first order first offers its members to one hub
   each, the set with the fewest tokens of its own; links merge groups, and only members of
   different groups of a bucket are paired later, if what both can share allows a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import mixed, parts, run_hashes, slices, stored, without_ids, word_hashes
from tidemark.llm.components import components
from tidemark.llm.exchange import COUNTS, answers, grouped, joined, pack_tokens, scatter, unpack_tokens

SHINGLE_WORDS = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Order 2 and 3 sort tokens by the mixed hash of token xor salt.
SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
HUB_ROUNDS = 2
#: Bytes of a token that are kept to count its holders; a chance collision only costs work.
WIDTH = 6
_LOW = np.uint64(8 * (8 - WIDTH))


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of a shorter text one hash of all words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(words))], np.uint64)
    return np.unique(run_hashes(hashes, size))


def least_overlap(n: int | np.ndarray) -> int | np.ndarray:
    """Tokens that a set of n shares with any partner at least: ceil(0.8 n)."""
    return -(-PERCENT * n // 100)


def screen_length(n: int) -> int:
    return min(n, n - least_overlap(n) + max(1, n // 10))


def least_shared(n: int) -> int:
    """Of the screened tokens, those that a partner's screened tokens share at least."""
    return max(1, least_overlap(n) // 10)


def _set_print(tokens: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), ">i8")
    return int(both[0]), int(both[1])


def _scatter(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed rows: for each bucket and slice of documents its tokens and who holds them.

    Tokens keep 48 bits besides the bucket; a chance collision only keeps a document longer.
    """
    schema = "bucket int, ids binary, n binary, prints binary, refs binary, tokens binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            for a, b in slices([t or "" for t in texts], 1 << 22):
                ids, sizes, prints, refs, tokens = doc_ids[a:b], [], [], [], []
                for i, text in enumerate(texts[a:b]):
                    found = shingle_set(text)
                    sizes.append(len(found))
                    prints.append(_set_print(found))
                    tokens.append(found[: screen_length(len(found))])
                    refs.append(np.full(len(tokens[-1]), i, np.uint32))
                flat, ref = np.concatenate(tokens), np.concatenate(refs)
                of = ((mixed(flat) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(of, kind="stable")
                flat, ref, of = flat[order], ref[order], of[order]
                cuts = np.searchsorted(of, np.arange(buckets + 1))
                home = int(ids[0]) % buckets
                out = []
                for k in range(buckets):
                    x, y = cuts[k], cuts[k + 1]
                    if x == y and k != home:
                        continue
                    here = k == home
                    held, ref_k = np.unique(ref[x:y], return_inverse=True)
                    out.append(
                        {
                            "bucket": k,
                            "ids": (ids if here else ids[held]).astype("<i8").tobytes(),
                            "n": np.array(sizes, "<i4").tobytes() if here else None,
                            "prints": np.array(prints, "<i8").tobytes() if here else None,
                            "refs": (ref[x:y] if here else ref_k).astype("<u2" if b - a < 1 << 16 else "<u4").tobytes(),
                            "tokens": pack_tokens(flat[x:y], WIDTH),
                        }
                    )
                kinds = [("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "n", "prints", "refs", "tokens"))]
                yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    return docs.mapInArrow(rows, schema)


def _gather(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket and group of documents: how many tokens of each document others hold."""
    ids, refs, tokens, metas, base = [], [], [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            own = np.frombuffer(row["ids"], "<i8")
            token = unpack_tokens(row["tokens"], WIDTH)
            kind = "<u2" if len(row["refs"]) == 2 * len(token) else "<u4"
            ids.append(own)
            refs.append(np.frombuffer(row["refs"], kind).astype(np.int64) + base)
            tokens.append(token)
            base += len(own)
            if row["n"] is not None:
                sizes, prints = np.frombuffer(row["n"], "<i4"), np.frombuffer(row["prints"], "<i8").reshape(-1, 2)
                metas.append((own, sizes.astype(np.int64), prints[:, 0], prints[:, 1], np.zeros(len(own), np.int64)))
    if not base:
        return
    own, ref, token = np.concatenate(ids), np.concatenate(refs), np.concatenate(tokens)
    order = np.argsort(token)
    starts = np.flatnonzero(np.concatenate(([True], np.diff(token[order]) != 0))) if len(token) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(token)))
    counts = np.empty(len(token), np.int64)
    counts[order] = np.repeat(sizes, sizes)
    hits = np.bincount(ref[counts >= 2], minlength=base)
    some = np.flatnonzero(hits)
    zero = np.zeros(len(some), np.int64)
    metas.append((own[some], zero - 1, zero, zero, hits[some]))
    columns = [np.concatenate(c) for c in zip(*metas, strict=True)]
    names = ["doc_id", "n", "p1", "p2", "hits"]
    for group, at in grouped(columns[0], buckets):
        data = [pa.array([c[at].astype("<i8").tobytes()], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), *data], ["bucket", *names])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its largest set and all its hits."""
    names = ["doc_id", "n", "p1", "p2", "hits"]
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    doc, n, p1, p2, hits = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows]) for c in names)
    order = np.lexsort((p2, p1, n, doc))
    doc, n, p1, p2, hits = (x[order] for x in (doc, n, p1, p2, hits))
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    last = np.append(starts[1:], len(doc)) - 1
    out = [doc[last], n[last], p1[last], p2[last], np.add.reduceat(hits, starts)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)


def profiles(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, p1, p2, hits)``: set size, fingerprint and screen of every document."""
    buckets = parts(docs.sparkSession)
    packed = _scatter(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), buckets)
    counted = packed.repartition(buckets, "bucket").mapInArrow(
        lambda batches: _gather(batches, buckets), "bucket int, doc_id binary, n binary, p1 binary, p2 binary, hits binary"
    )
    merged = counted.repartition(buckets, "bucket").mapInArrow(_merge, "doc_id long, n int, p1 long, p2 long, hits long")
    return stored(merged, "shingle-profiles")


def _candidate_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, n, tokens)`` of the wanted documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                tokens = shingle_set(row["text"])
                if _set_print(tokens) == (row["p1"], row["p2"]):  # else another row with this id
                    out.append({"doc_id": row["doc_id"], "n": len(tokens), "tokens": tokens.tobytes()})
            kinds = [("doc_id", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    texts = docs.select("doc_id", "text").join(wanted.select("doc_id", "p1", "p2"), "doc_id")
    return stored(texts.mapInArrow(rows, "doc_id long, n int, tokens binary"), "candidate-sets")


def _prefixes(sets: DataFrame) -> DataFrame:
    """``(doc_id, n, s, prefix)``: tokens that other sets hold, and the prefix of the first order.

    Tokens of one set only come first in that order and match nothing, so the prefix keeps only
    what follows them. A set that shares less than every link needs has none and is left out.
    """

    def tokens_of(column: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint64) for x in column]

    counts = answers(scatter(sets.select("doc_id", "tokens"), tokens_of, WIDTH), WIDTH, COUNTS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                tokens, n = np.frombuffer(row["tokens"], np.uint64), row["n"]
                known, often = joined(row["known"], WIDTH), np.frombuffer(row["often"], "<i8")
                order = np.argsort(known, kind="stable")
                short = tokens >> _LOW << _LOW
                at = np.minimum(np.searchsorted(known[order], short), len(known) - 1)
                count = np.where(known[order][at] == short, often[order][at], 1)
                shared = count > 1
                s, length = int(shared.sum()), n - least_overlap(n) + 1
                if s < least_overlap(n):
                    continue
                rest = tokens[shared][np.lexsort((tokens[shared], count[shared]))][: max(0, length - (n - s))]
                out.append({"doc_id": row["doc_id"], "n": n, "s": s, "prefix": rest.view(np.int64).tolist()})
            kinds = [("doc_id", pa.int64()), ("n", pa.int32()), ("s", pa.int32()), ("prefix", pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    both = sets.join(counts.select("doc_id", F.col("tokens").alias("known"), F.col("firsts").alias("often")), "doc_id")
    return both.select("doc_id", "n", "tokens", "known", "often").mapInArrow(rows, "doc_id long, n int, s int, prefix array<bigint>")


def order_prefix(tokens: np.ndarray, salt: int) -> np.ndarray:
    """The first tokens in the order of a salt, as many as any partner must share one of, in 32 bits."""
    length = len(tokens) - least_overlap(len(tokens)) + 1
    ranks = mixed(tokens ^ np.uint64(salt))
    first = np.partition(ranks, length - 1)[:length] if length < len(tokens) else ranks
    # the lower bits, as the upper ones are alike in a prefix; a chance collision only lets a pair pass
    return np.unique(first.astype(np.uint32)).view(np.int32)


def _order_prefixes(sets: DataFrame) -> DataFrame:
    """``(doc_id, o2, o3)``: the prefixes of every set in the orders after the first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(t, np.uint64) for t in batch.column(1).to_pylist()]
            columns = [pa.array([order_prefix(t, salt) for t in own], pa.list_(pa.int32())) for salt in SALTS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "o2", "o3"])

    made = sets.select("doc_id", "tokens").mapInArrow(rows, "doc_id long, o2 array<int>, o3 array<int>")
    return stored(made, "order-prefixes")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link, by the exact ratio."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def met_in_all_orders(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(a, b)`` of the pairs whose prefixes meet in every order after the first."""
    of_a = prefixes.select(F.col("doc_id").alias("a"), F.col("o2").alias("a2"), F.col("o3").alias("a3"))
    of_b = prefixes.select(F.col("doc_id").alias("b"), F.col("o2").alias("b2"), F.col("o3").alias("b3"))
    both = pairs.join(of_b, "b").join(of_a, "a")
    return both.where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3")).select("a", "b")


def _verify(pairs: DataFrame, sets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(a, b)`` of the pairs that link: filtered by all orders, then compared as whole sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep = [i for i in range(len(a)) if linked(np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"]
            )

    passed = stored(met_in_all_orders(pairs, prefixes), "filtered-pairs")
    of_b = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    of_a = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    return passed.join(of_b, "b").join(of_a, "a").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _label(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("label", F.col("doc_id"))
    found = components(links)
    return rows.join(found, F.col("doc_id") == F.col("id"), "left").withColumn("label", F.coalesce("label", "doc_id")).drop("id")


def _may_link(n1, s1, n2, s2):
    """Whether sets of these sizes can link if a token is their first common one.

    ``s`` counts a set's shared tokens from that token on, in the first order; common tokens are
    among them. A pair that links passes at its first common token, so no link is lost.
    """
    both = F.least(s1, s2)
    return F.lit(100) * both >= F.lit(PERCENT) * (n1 + n2 - both)


def set_links(sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect what the similarity connects; copies of a set occur once."""
    placed = _prefixes(sets).select("doc_id", "n", F.col("s").alias("all_s"), F.posexplode("prefix").alias("at", "t"))
    entries = stored(placed.select("doc_id", "n", "all_s", (F.col("all_s") - F.col("at")).alias("s"), "t"), "prefix-entries")
    prefixes = _order_prefixes(sets)
    links: DataFrame | None = None
    for turn in range(HUB_ROUNDS):
        labelled = _label(entries, links)
        rank = F.struct((F.col("n") - F.col("all_s")).alias("own"), F.col("doc_id").alias("d")) if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
        member = F.struct(rank.alias("r"), F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"), F.col("s").alias("hub_s"), F.col("label").alias("hub_label"))
        hubs = labelled.groupBy("t").agg(F.min(member).alias("_h"), F.min("label").alias("_l1"), F.max("label").alias("_l2"))
        open_hubs = hubs.where("_l1 < _l2").select("t", "_h.hub", "_h.hub_n", "_h.hub_s", "_h.hub_label")
        offers = labelled.join(open_hubs, "t").where(
            (F.col("label") != F.col("hub_label")) & _may_link(F.col("n"), F.col("s"), F.col("hub_n"), F.col("hub_s"))
        )
        counted = offers.groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("c"))
        if turn == 0:  # each document's most frequent hub
            counted = counted.groupBy("doc_id").agg(F.max_by("hub", F.struct("c", -F.col("hub"))).alias("hub"))
        pairs = stored(counted.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")), "hub-pairs")
        found = stored(_verify(pairs, sets, prefixes), "hub-links")
        links = found if links is None else links.union(found)
    labelled = stored(_label(entries, links), "prefix-labelled")
    mixed_buckets = labelled.groupBy("t").agg(F.min("label").alias("_l1"), F.max("label").alias("_l2")).where("_l1 < _l2")
    rest = labelled.join(mixed_buckets.select("t"), "t")
    left = rest.select("t", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"), F.col("label").alias("la"))
    right = rest.select("t", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"), F.col("label").alias("lb"))
    across = left.join(right, "t").where(
        (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & _may_link(F.col("na"), F.col("sa"), F.col("nb"), F.col("sb"))
    )
    pairs = stored(across.select("a", "b").distinct(), "cross-pairs")
    return stored(links.union(_verify(pairs, sets, prefixes)), "set-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: the smallest doc_id reachable by links.

    A null or empty text, or one of blanks, has no shingle and links with nothing. Rows without
    doc_id take no part. Rows that repeat a doc_id are one document with the largest of their
    sets. Other columns are ignored; an empty table gives no rows.
    """
    known = profiles(docs)
    groups = known.where("n > 0").groupBy("n", "p1", "p2").agg(
        F.min("doc_id").alias("rep"), F.max("hits").alias("hits")
    )
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * PERCENT / 100) / 10))
    wanted = groups.where(F.col("hits") >= need).select(F.col("rep").alias("doc_id"), "n", "p1", "p2")
    labels = components(set_links(_candidate_sets(docs, wanted)))
    reps = groups.select("n", "p1", "p2", "rep").join(
        labels.withColumnRenamed("id", "rep"), "rep", "left"
    )
    named = reps.select("n", "p1", "p2", F.coalesce("label", "rep").alias("component"))
    return known.join(named, ["n", "p1", "p2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of every component."""
    return without_ids(docs, near_duplicates(docs).where("component_id <> doc_id").select("doc_id"))
