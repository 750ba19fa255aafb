"""Operators 1 and 4: token files and packing."""

import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tidemark.llm import packing, token_blocks, tokens
from tidemark.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from tidemark.llm.tokens import PLAIN, PieceEncoder

SMALL = "/root/testdata/sf0.001"
ODD = [
    (5, None), (1, ""), (2, "  two  spaces\n\n tab\tend "), (3, "x" * 5000), (4, "Ünïcode İ日本 <|endoftext|> it's."),
    (7, "same text"), (7, "same text"), (8, "word, " * 4000), (6, "\n"), (9, "a\u0000b"),
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, shard string, planes int")


@pytest.mark.parametrize(("name", "spaces"), [("word_bpe_49k.json", "dropped"), ("byte_bpe_50k.json", "leading")])
def test_cut_texts_give_the_ids_of_whole_texts(name, spaces):
    encoder = PieceEncoder(path(name), spaces)
    parts = st.sampled_from([*"ab Z'sté.,<|>-_\n\t ²½ſßΣİJ̸̌日1", "<|endoftext|>", "'s", " ", "  ", " \n"])

    @settings(max_examples=300, deadline=None)
    @given(st.lists(parts, max_size=30).map("".join))
    def check(text):
        want = array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert encoder.encode([text, text]) == [want, want]

    check()


def test_plain_texts_give_the_ids_of_whole_texts():
    encoder = PieceEncoder(path("word_bpe_49k.json"), "dropped")
    whole = lambda t: array("I", encoder.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()
    parts = st.sampled_from([*map(chr, range(1, 0x17F)), *"abcdeTS'....,,,\n\n\n   ", "'LL", "'re", "<|", "<|ENDOFTEXT|>", "</w>", "w>"])

    @settings(max_examples=500, deadline=None)
    @given(st.lists(parts, max_size=30).map("".join))
    def check(text):
        plain = "".join(c for c in text if PLAIN.fullmatch(c))
        assert encoder.encode([plain, text]) == [whole(plain), whole(text)]

    check()
    for c in map(chr, range(0x250)):  # every character between words and marks
        texts = [f"a{c}b", f" {c},", f"'{c}s", f"É{c}{c}", c]
        assert encoder.encode(texts) == [whole(t) for t in texts]


def test_words_are_encoded_once_whatever_case_and_marks():
    encoder = PieceEncoder(path("word_bpe_49k.json"), "dropped")
    encoder.encode(["Été, été. (ÉTÉ)\nété\tété!", "Été: 2 été's"])
    assert set(encoder.known) == {"été", "'s", "2", *",.()!:"}


def test_words_beyond_the_cache_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    encoder = PieceEncoder(path("word_bpe_49k.json"), "dropped")
    texts = [f"one two. three, four {'x' * 60} {i}{' 日 本' * (i % 2)}" for i in range(50)]
    for _ in range(2):
        assert encoder.encode(texts) == [array("I", encoder.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
        assert len(encoder.known) <= 3


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    assert (token_blocks.unshuffle_planes(token_blocks.shuffle_planes(ids, planes), n) == ids).all()


@pytest.mark.parametrize(("block_ids", "planes"), [(64, "bit"), (1 << 16, "byte")])
def test_token_files_of_odd_texts(spark, block_ids, planes):
    files = token_blocks.write_token_files(docs_of(spark, ODD), WORD_BPE, "dropped", 1, block_ids, planes)
    got = sorted(tuple(r) for r in token_blocks.token_digests(spark, files).collect())
    tokenizer, start, want = Tokenizer.from_file(path("word_bpe_49k.json")), 0, []
    for doc_id, text in sorted(ODD, key=lambda r: (r[0], r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == sorted(want)
    index = spark.read.parquet(files.index).orderBy("first").collect()
    assert index[0]["first"] == 0
    assert all(a["first"] + a["n_ids"] == b["first"] for a, b in zip(index, index[1:], strict=False))


def test_token_files_of_nothing(spark):
    files = token_blocks.write_token_files(docs_of(spark, []), WORD_BPE, "dropped", 1)
    assert token_blocks.token_digests(spark, files).count() == 0


def check_packing(rows, limit, longest_first=True):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return sequences, documents


def test_packing_of_odd_texts(spark):
    limit = 16
    pieces = packing.cut_pieces(docs_of(spark, ODD), BYTE_BPE, "leading", 0, limit)
    rows = packing.pack(pieces, limit).collect()
    sequences, documents = check_packing(rows, limit)
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for doc_id, text in ODD:
        want[doc_id] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert {k: sum(p[2] for p in v) for k, v in documents.items()} == want
    assert len(sequences) <= -(-sum(want.values()) // limit) + 1


@pytest.mark.parametrize("lengths", [[], [9] * 40, [10, 9, 8, 7, 6, 5, 4, 3, 2, 1], [16, 16, 1], [8] * 7 + [3] * 5])
def test_packing_of_lengths(spark, lengths):
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    got = packing.pack(spark.createDataFrame(rows, packing._PIECE), 16).collect()
    sequences, _ = check_packing(got, 16)
    assert len(got) == len(lengths)
    assert len(sequences) <= 1.3 * max(-(-sum(lengths) // 16), sum(n > 8 for n in lengths)) + 1


@pytest.mark.parametrize("limit", [7, 64, 2048])
def test_slots_hold_every_rank_once(limit):
    r = np.random.default_rng(limit)
    sizes = np.minimum(limit - 1, np.exp(r.normal(np.log(limit) - 1.5, 1.0, 5000)).astype(int) + 1)
    counts = dict(zip(*(c.tolist() for c in np.unique(sizes, return_counts=True)), strict=True))
    slots = packing.fill(dict(counts), limit)
    size = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = slots.places(size, rank)
    order = np.lexsort((offset, sequence))
    sequence, offset, size = sequence[order], offset[order], size[order]
    first = np.r_[True, sequence[1:] != sequence[:-1]]
    assert (offset[first] == 0).all() and (offset + size).max() <= limit
    assert (offset[~first] == (offset + size)[:-1][~first[1:]]).all()
    assert first.sum() <= 1.01 * size.sum() / limit + 3


def test_queries_on_the_small_tables(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SMALL).collect()
    sequences, _ = check_packing(rows, 2048)
    assert len(sequences) <= 1.03 * sum(r["length"] for r in rows) / 2048 + 2
    ids = QUERIES["op1_token_blocks"](spark, SMALL).collect()
    assert len(ids) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
