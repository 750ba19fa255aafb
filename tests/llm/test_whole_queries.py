"""Registered queries and the pipeline over whole tables, against plain Python."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from public_tokenizers import path
from test_duplicates import linked_components
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import chat_windows, language
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_whole_text_encodings(spark, documents):
    tokenizer = Tokenizer.from_file(str(path("word_bpe_49k.json")))
    start, want = 0, []
    for doc, text in sorted(documents):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r)[:4] for r in QUERIES["op1_token_blocks"](spark, SMALL).collect()) == want


def check_pieces(rows, documents):
    """Every piece's ids, gapless places, and no more sequences than a simple packing needs."""
    tokenizer = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in documents}
    held, places = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])
        held[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert held.keys() == ids.keys()
    for doc, pieces in held.items():
        at = 0
        for number, (piece, start, length) in enumerate(sorted(pieces)):
            assert (piece, start) == (number, at) and (len(pieces) == 1 or number == 0 or length == 2048)
            at += length
        assert at == len(ids[doc])
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.03 * sum(map(len, ids.values())) / 2048 + 2


def test_packed_pieces_hold_whole_text_encodings(spark, documents):
    check_pieces(QUERIES["op4_best_fit_packing"](spark, SMALL).collect(), documents)


def escaped(text, role=False):
    for plain, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e")) + ((("\n", "\\n"),) if role else ()):
        text = text.replace(plain, code)
    return text


def plain_windows(turns, tokenizer, budget=chat_windows.BUDGET, history=chat_windows.HISTORY):
    """Texts of the windows of one conversation, turn by turn."""
    rendered = [(f"### {escaped(role or '', True)}\n", escaped(text or "") + "</turn>\n", role) for _, role, text in turns]
    rows = sorted(zip([t[0] for t in turns], rendered, strict=True), key=lambda x: (x[0], x[1][0], x[1][1]))
    texts = [h + b for _, (h, b, _) in rows]
    tokens = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    system = rows[0][1][2] == "system"
    half = max(1, (budget - history - (tokens[0] if system else 0)) // 2)
    spans, start, before = [], 0, None
    for k in range(int(system), len(texts)):
        big, cell = tokens[k] > half, start // half
        if before is None or big or before[0] or cell != before[1]:
            spans.append([])
        spans[-1].append(k)
        before, start = (big, cell), start + tokens[k]
    out, lead = [], [texts[0]] if system else []
    for k, span in enumerate(spans):
        tail = []
        if k:
            for t in reversed(spans[k - 1]):
                if sum(tokens[x] for x in [t, *tail]) > history:
                    break
                tail.insert(0, t)
        out.append("".join(lead + [texts[t] for t in tail + span]))
    return out or ["".join(lead)]


def test_windows_equal_a_walk_over_the_turns(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    odd = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in rows] + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    tokenizer, turns = Tokenizer.from_file(str(path("byte_bpe_50k.json"))), defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role, text))
    got = {r["conv_id"]: r for r in QUERIES["op5_chat_windows"](spark, SMALL).collect()}
    assert got.keys() == turns.keys()
    for conv, own in turns.items():
        own.sort(key=lambda t: t[0])
        loss = "".join(x or "" for _, role, x in own if role == "assistant")
        body = "".join(f"{role or ''}\n{x or ''}\n" for _, role, x in own)
        assert tuple(got[conv]) == (
            conv, len(own), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(map(len, plain_windows(own, tokenizer))),
        )


def chance(doc_id):
    first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    return xxhash.xxh64_intdigest(b"language sample", seed=first) & ((1 << 53) - 1)


def plain_models(rows):
    """The machines of the same sample, one after the other."""
    held = defaultdict(dict)
    for doc, text, lang in rows:
        if lang is not None and zlib.crc32(str(doc).encode()) % 5:
            held[lang][doc] = text
    sample = []
    for lang, texts in held.items():
        for doc in sorted(texts, key=lambda d: (chance(d), d))[: language.PER_LANGUAGE]:
            if language.has_letter(texts[doc]):
                sample.append((lang, language.features(texts[doc])))
    langs = sorted({lang for lang, _ in sample})
    families = sorted({language.family_of(x) for x in langs})
    fitted = [("language", x, "", b"") for x in langs]
    jobs = [("family", f, "", langs) for f in families] if len(families) > 1 else []
    jobs += [("pair", a, b, [a, b]) for a in langs for b in langs if a < b and language.family_of(a) == language.family_of(b)]
    for kind, a, b, members in jobs:
        own = sorted(((lang, x) for lang, x in sample if lang in members), key=lambda s: (s[0], s[1].tobytes()))
        y = [1.0 if (language.family_of(lang) if kind == "family" else lang) == a else -1.0 for lang, _ in own]
        fitted.append((kind, a, b, language.fit_svm(np.stack([x for _, x in own]), np.array(y)).tobytes()))
    return language.Models(fitted)


def test_languages_equal_a_plain_refit(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    models = plain_models(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op2_language"](spark, SMALL).collect()}
    want = {doc: models.predict(text) for doc, text, _ in rows}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def test_language_sample_of_repeated_ids(spark):
    """One id with half of all rows counts once per language."""
    rows = [(7, f"the {k} words of one id", "en" if k % 2 else "de") for k in range(300)]
    rows += [(k, "other words here", "en") for k in range(1000, 1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = [r["lang"] for r in language.training_sample(docs, 50).collect()]
    assert (sample.count("en"), sample.count("de")) == (50, 1)


def without_repeated_lines(rows):
    """Texts without the lines whose key a document with a smaller id holds."""
    key = lambda line: line.strip(b"\t\n\v\f\r ").lower()
    first = {}
    for i, t in rows:
        for line in t.encode().split(b"\n"):
            if len(key(line).decode()) >= 10:
                first[key(line)] = min(i, first.get(key(line), i))
    return [(i, b"\n".join(x for x in t.encode().split(b"\n") if first.get(key(x), i) == i).decode()) for i, t in rows]


def contaminated(docs, items, least=0.8):
    """Documents with a window of an item's size that reaches the similarity, plain or weighted by rarity."""
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    held = {i: (len(w), min(5, len(w)), grams(w, min(5, len(w)))) for i, t in items for w in [(t or "").encode().lower().split()] if w}
    often = Counter(g for _, _, gs in held.values() for g in set(gs))
    out = set()
    for doc, text in docs:
        w = text.encode().lower().split()
        own_grams = {k: set(grams(w, k)) for k in {k for _, k, _ in held.values()}}
        for n, k, gs in held.values():
            if not own_grams[k] & set(gs):
                continue
            a, own = Counter(gs), sum(1 / often[g] for g in gs)
            for start in range(len(w)):
                window = grams(w[start : start + n], k)
                b = Counter(window)
                both = {g: min(a[g], b[g]) for g in a.keys() & b.keys()}
                other = sum(1 / often[g] if g in often else own / len(gs) for g in window)
                if both and max(sum(c / often[g] for g, c in both.items()) / max(own, other), sum(both.values()) / len(gs)) >= least - 1e-9:
                    out.add(doc)
                    break
    return out


def test_pipeline_equals_plain_stages(spark, documents):
    """Language drops texts without a letter; then lines, near duplicates, passages; then pieces."""
    want = [(i, t) for i, t in documents if language.has_letter(t)]
    want = without_repeated_lines(want)
    groups = linked_components(want)
    want = [(i, t) for i, t in want if groups[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = contaminated(want, items)
    want = [(i, t) for i, t in want if i not in hit]
    assert 0 < len(want) < len(documents)
    check_pieces(corpus_pipeline.run(spark, SMALL).collect(), want)
