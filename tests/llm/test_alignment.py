"""Operator 11 against whole-text encodings and a plain walk over both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "a\n\nb c"), (6, "x <|endoftext|> y<s></s>"), (7, "▁ under"), (8, "日本語 テキスト 漢字" * 50),
    (9, "😀😀 émoji nbsp  　 wide"), (10, "don't 's 't 'll 1234 56.7"), (11, "a" * 5000), (12, "\x00\x01 b"), (13, "\t tab"),
    (None, "no id here"), (None, "no id here"), (15, "ſt́ combining é"), (16, "  "), (17, "\r\n x \r\n"), (18, "\x1c a \x85 b"),
    (19, "ab " * 30000), (20, " lead"), (20, "same id"), (2**53 + 1, "a large id"),
]


def byte_values():
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
    rest = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(rest)): b for b in range(256)}


def brute(rows):
    first = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    values, docs, held = byte_values(), [], Counter()
    for doc, text in rows:
        groups, n_a, n_b = [], 0, 0
        if text:
            e = first.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(values[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
            pieces = [(i, second.id_to_piece(i)) for i in second.encode(text)]
            b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
            if b"".join(x for _, x in a) == (" " + text).encode() == b"".join(x for _, x in b):
                n_a, n_b = len(a), len(b)
                ends = [np.cumsum([len(x) for _, x in side]) for side in (a, b)]
                last = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    to = [int(np.searchsorted(e, cut)) + 1 for e in ends]
                    groups.append(tuple([i for i, _ in side[x:y]] for side, x, y in zip((a, b), last, to, strict=True)))
                    last = to
        links = [(x, y) for g, h in groups for x in g for y in h]
        held.update(set(links))
        docs.append((doc, n_a, n_b, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc, n_a, n_b, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best, total = sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links)
        out.append((doc, n_a, n_b, len(groups), len(links), best, total, digest))
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def documents(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 1) for r in rows], "doc_id long, text string, n_a int, block string, pair int")


def noise(n, seed=3):
    r = random.Random(seed)
    return [(100 + k, "".join(r.choice(" \n\tab'é.1日😀 ▁sZ") for _ in range(r.randrange(1, 60)))) for k in range(n)]


def test_figures_of_odd_texts(spark):
    rows = ODD + noise(300)
    assert ordered(alignment.document_figures(documents(spark, rows), BYTE_BPE, PIECE_BPE).collect()) == brute(rows)


def test_small_blocks_and_lanes(spark, monkeypatch):
    """Totals over many blocks, lanes of a few units, wide groups and a store that forgets."""
    rows = ODD + noise(200, 4)
    pair = alignment.Pair(*(str(public_tokenizers.path(p)) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    want = pair.align([t for _, t in rows])
    digests = pair.written(want)
    for name, value in (("LANE_UNITS", 3), ("KEPT_UNITS", 50)):
        monkeypatch.setattr(alignment, name, value)
    for k, (_, text) in enumerate(rows):
        got = pair.align([text])
        assert (got.n_a[0], got.n_b[0], got.n_groups[0]) == (want.n_a[k], want.n_b[k], want.n_groups[k])
        assert pair.written(got)[0] == digests[k]
    few = alignment.links(want)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    folded = alignment.links(want)
    counts = []
    for pairs, docs, times in (few, folded):
        c = Counter()
        for key, n in zip(zip(pairs.tolist(), docs.tolist(), strict=True), times.tolist(), strict=True):
            c[key] += n
        counts.append(c)
    assert counts[0] == counts[1]
    assert len(pair.a_n) < 400


def test_blocks_share_their_counts(spark):
    rows = ODD + noise(200, 5)
    docs = documents(spark, rows).repartition(7)
    assert ordered(alignment.document_figures(docs, BYTE_BPE, PIECE_BPE).collect()) == brute(rows)


def test_groups_are_returned(spark):
    row = alignment.align(documents(spark, [(1, "don't 1234")]), BYTE_BPE, PIECE_BPE).first()
    assert sum(row.a_sizes) == len(row.a_ids) and sum(row.b_sizes) == len(row.b_ids) and len(row.a_sizes) == len(row.b_sizes)
    assert alignment.align(documents(spark, [(1, None)]), BYTE_BPE, PIECE_BPE).first().a_ids == []


def test_no_documents(spark):
    assert alignment.document_figures(documents(spark, []), BYTE_BPE, PIECE_BPE).count() == 0


@pytest.mark.parametrize("folder", [SMALL])
def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op11_token_alignment"](spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(got.collect()) == brute(rows)
