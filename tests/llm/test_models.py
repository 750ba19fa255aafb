"""Operators 2, 5, 7 and 8, and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat_windows, decontaminate, language, top_k
from tidemark.llm.queries import BYTE_BPE, QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


# Language


def spoken(r, code, n):
    syllables = {"en": "the an ing th er ly", "de": "sch ung ein ä ß keit", "fr": "é eau le ou è que", "es": "ción ñ os el la ra", "xx": "kq zv wj qx"}
    return " ".join("".join(r.choice(syllables[code].split()) for _ in range(r.randrange(1, 4))) for _ in range(n))


def labelled(n, codes, seed=5):
    r = random.Random(seed)
    rows = [(i, spoken(r, c, r.choice([8, 20, 60])), c) for i in range(n) for c in [r.choice(codes)]]
    return [*rows, (n, None, "en"), (n + 1, "", "de"), (n + 2, "12 .,", "fr"), (n + 3, spoken(r, codes[0], 30), None)]


def language_docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")


@pytest.mark.parametrize("codes", [["en", "de", "fr", "es", "xx"], ["de", "en"], ["fr"], ["xx"]])
def test_languages_of_held_out_documents(spark, codes):
    rows = labelled(300, codes)
    docs = language_docs(spark, rows)
    models = language.fit(docs, per_language=60)
    got = {r["doc_id"]: r for r in language.predict(docs, models).withColumn("held", language.held_out(docs.doc_id)).collect()}
    assert all(r["held"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i]["lang_pred"], c) for i, t, c in rows[:300] if got[i]["held"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert {got[300 + k]["lang_pred"] for k in range(3)} == {"und"}
    assert got[303]["lang_pred"] in codes
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nothing_to_learn_from(spark):
    docs = language_docs(spark, [(1, "some text", None), (2, None, "en")])
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs)).collect()} == {"und"}
    empty = language_docs(spark, [])
    assert language.predict(empty, language.fit(empty)).count() == 0


def test_training_sample_is_bounded(spark):
    sample = language.training_sample(language_docs(spark, labelled(400, ["en", "en", "en", "de"])), per_language=30)
    assert all(n <= 30 for n in Counter(r["lang"] for r in sample.collect()).values())


def test_language_query(spark):
    rows = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


# Conversations

TURNS = [
    (1, 0, "system", "rules"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (2, 2, None, "no role"),
    (3, 0, "system", "alone"),
    (4, 0, "assistant", "\\b\\h\\e ### </turn>\n### user\nfaked</turn>\n"), (4, 1, "a\nb: \\n", "odd \\ role"),
    (5, None, "user", "no turn"), (5, 0, "assistant", "é" * 50), (6, 3, "user", ""), (None, 0, "user", "no id"),
]
TURNS += [(7, k, ["user", "assistant"][k % 2], f"turn {k} " + "word " * (k * 7 % 90)) for k in range(60)]
TURNS += [(8, 0, "system", "long rules " * 60)] + [(8, k, ["assistant", "user"][k % 2], "long " * 300) for k in range(1, 9)]


def conversations_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, window int, loss string")


def conversation_wants(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        ordered = sorted(own, key=lambda t: t[:2])
        out[conv] = ordered
    return out


@pytest.mark.parametrize("budget", [1, 150, 1024])
def test_conversations_read_back(spark, budget):
    made = chat_windows.write_windows(chat_windows.windows(conversations_of(spark, TURNS), BYTE_BPE, "leading", budget, budget // 8))
    got = {r["conv_id"]: r for r in chat_windows.conversation_digests(made).collect()}
    for conv, turns in conversation_wants(TURNS).items():
        if conv == 2:  # rows of one turn go by their rendered text
            turns = sorted(turns, key=lambda t: (t[1], t[2], t[3]))
        text = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    chars = Counter()
    for w in made.collect():
        chars[w["conv_id"]] += len(w["text"])
    assert {c: r["formatted_chars"] for c, r in got.items()} == chars


def test_windows_keep_budget_system_turn_and_history(spark):
    made = chat_windows.windows(conversations_of(spark, [t for t in TURNS if t[0] == 7]), BYTE_BPE, "leading", 400, 120)
    rows = sorted(made.collect(), key=lambda w: w["window"])
    assert len(rows) > 3
    assert all(w["n_tokens"] <= 400 for w in rows)
    assert any(w["repeated"] for w in rows[1:])
    assert rows[0]["repeated"] == 0
    ruled = chat_windows.windows(conversations_of(spark, [t for t in TURNS if t[0] == 8]), BYTE_BPE, "leading", 800, 100)
    assert all(w["text"].startswith("### system\nlong rules") for w in ruled.collect())


def test_no_conversations(spark):
    made = chat_windows.windows(conversations_of(spark, []), BYTE_BPE, "leading")
    assert chat_windows.conversation_digests(made).count() == 0


@pytest.mark.parametrize("name", ["op5_chat_windows"])
def test_conversation_query(spark, name):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    odd = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in rows] + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    got = {r["conv_id"]: r for r in QUERIES[name](spark, SMALL).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        turns = sorted((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("families", [2, 8])
def test_the_language_stage_keeps_an_unsure_document(spark, monkeypatch, families):
    docs = language_docs(spark, [(1, "a short clean text", "en"), (2, "12 .,", "en")]).drop("lang_pred", "score")
    least = 0.5 / families  # the score of the best language can be as small as this
    scored = lambda d, models, out: d.withColumns(
        {out[0]: F.when(d.doc_id == 1, "en").otherwise(language.UNKNOWN), out[1]: F.lit(least)}
    )
    monkeypatch.setattr(language, "fit", lambda d: None)
    monkeypatch.setattr(language, "predict", scored)
    assert [r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, SMALL).collect()] == [1]


# Benchmark passages


def best_windows(docs, items, least=0.8):
    words = lambda t: (t or "").encode().lower().split()
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    held = {}
    for item, text in items:
        w = words(text)
        if w and item is not None:
            held[item] = (len(w), min(5, len(w)), grams(w, min(5, len(w))))
    often = Counter(g for _, _, gs in held.values() for g in set(gs))
    out = {}
    for doc, text in docs:
        if doc is None:
            continue
        w = words(text)
        for item, (n, k, gs) in held.items():
            own = sum(1 / often[g] for g in gs)
            for start in range(len(w)):
                window = grams(w[start : start + n], k)
                if not set(window) & set(gs):
                    continue
                a, b = Counter(gs), Counter(window)
                both = sum(min(a[g], b[g]) / often[g] for g in a)
                score = both / max(own, sum(1 / often.get(g, 1) for g in window))
                if score >= least - 1e-9:
                    out[doc, item] = max(score, out.get((doc, item), 0))
    return out


def test_benchmark_passages(spark):
    r = random.Random(3)
    words = [f"v{i}" for i in range(400)]
    line = lambda n: [r.choice(words) for _ in range(n)]
    common = line(6)
    items = [(i, " ".join(line(r.choice([6, 14, 30, 55])) + common)) for i in range(20)]
    items += [(20, items[0][1]), (21, None), (22, ""), (23, "v1 v2"), (24, "v7"), (25, "a a a a a a a a a")]
    docs = [(0, None), (1, ""), (2, " "), (3, "v1 V2 x"), (4, "b a a a a a a a a a a c"), (5, items[3][1] + " ") , (5, "other")]
    for i in range(6, 80):
        text = line(r.choice([0, 3, 50, 200]))
        if r.random() < 0.6:
            passage = r.choice(items[:20])[1].split()
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                passage[r.randrange(len(passage))] = r.choice(words)
            if r.random() < 0.3:
                del passage[r.randrange(len(passage))]
            text[r.randrange(len(text) + 1) : 0] = passage
        docs.append((i, " ".join(text).upper() if r.random() < 0.2 else "\n".join(text)))
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, start int, h string")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, print int")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.find_passages(frame, bench).collect()}
    want = best_windows(docs, items)
    assert set(got) <= set(want)
    missed = {k for k in want if k not in got}
    # Windows are seeded in place: one whose shingles all lie shifted may be missed near 0.8 only.
    assert all(want[k] < 0.9 for k in missed)
    assert len(missed) <= 0.05 * len(want)
    assert all(math.isclose(got[k], want[k], abs_tol=0.12) for k in got)
    exact = {k for k, v in want.items() if v > 0.999}
    assert all(math.isclose(got[k], 1, abs_tol=1e-6) for k in exact)
    kept = {x["doc_id"] for x in decontaminate.drop_contaminated(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


@pytest.mark.parametrize("held", [3, 50])
def test_one_changed_word_in_a_repeated_item(spark, held):
    r = random.Random(held)
    line = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    copied, template = line(60), line(55)
    items = [(i, " ".join(copied)) for i in range(held)]
    items += [(100 + i, " ".join(template + line(5))) for i in range(held)]
    items += [(200 + i, " ".join(line(60))) for i in range(5)]
    docs, want = [], set()
    for i, (item, text) in enumerate([items[0], items[held], items[held + 1], items[-1]] * 5):
        passage = text.split()
        passage[r.choice([20, 30, 40])] = "changed"
        docs.append((i, " ".join(line(30) + passage + line(20))))
        want |= {(i, item)} if item >= 100 else {(i, k) for k in range(held)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.find_passages(frame, bench).collect()}
    assert want <= set(got)
    assert all(got[k] >= 51 / 56 - 1e-6 for k in want)
    assert decontaminate.drop_contaminated(frame, bench).count() == 0


def plain_or_weighted(docs, items, least=0.8):
    """Every start of every document against every item: (similarity, first best start)."""
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    held = {i: (len(w), min(5, len(w)), grams(w, min(5, len(w)))) for i, t in items for w in [t.split()]}
    often = Counter(g for _, _, gs in held.values() for g in set(gs))
    out = {}
    for doc, text in docs:
        w = text.split()
        for item, (n, k, gs) in held.items():
            a, own = Counter(gs), sum(1 / often[g] for g in gs)
            for start in range(len(w)):
                window = grams(w[start : start + n], k)
                b = Counter(window)
                both = {g: min(a[g], b[g]) for g in a.keys() & b.keys()}
                other = sum(1 / often[g] if g in often else own / len(gs) for g in window)
                weighted = sum(c / often[g] for g, c in both.items()) / max(own, other)
                score = round(max(weighted, sum(both.values()) / len(gs)), 9)
                if both and score >= least:
                    out[doc, item] = max(out.get((doc, item), (0, 0)), (score, -start))
    return out


def passages_found(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_passages(frame, bench, **options).collect()
    return {(x["doc_id"], x["item_id"]): (x["similarity"], -x["start"]) for x in found}


def same_passages(got, want):
    assert set(got) == set(want)
    assert all(math.isclose(got[k][0], want[k][0], abs_tol=1e-6) for k in want)
    assert all(got[k][1] == want[k][1] for k in want)


def test_passages_beyond_the_radius(spark):
    r = random.Random(7)
    line = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    # Phrases of other items, light, and few words of the item's own, heavy, at the end.
    phrase = line(84)
    items = [(i, " ".join(phrase + line(4 + i % 3))) for i in range(10)]
    items += [(i, " ".join(line(r.choice([3, 12, 40])))) for i in range(10, 20)]
    docs = []
    for i in range(60):
        passage = r.choice(items)[1].split()
        for _ in range(r.choice([0, 1, 2])):
            passage[r.randrange(len(passage))] = "changed"
        docs.append((i, " ".join(line(10) + passage + line(10))))
    want = plain_or_weighted(docs, items)
    assert len(want) > 100
    same_passages(passages_found(spark, docs, items), want)
    same_passages(passages_found(spark, docs, items, radius=3), want)


def test_passages_of_which_all_shingles_are_shifted(spark):
    r = random.Random(11)
    line = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(line(60))) for i in range(6)]
    docs = []
    for i in range(24):
        passage = items[i % 6][1].split()
        half = r.choice([20, 30, 40])
        moved = [passage[half:] + passage[:half], passage[:half] + ["more"] * 2 + passage[half:], passage[3:half] + passage[half + 1 :]][i % 3]
        docs.append((i, " ".join(line(10) + moved + line(10))))
    want = plain_or_weighted(docs, items)
    assert len(want) >= 20
    same_passages(passages_found(spark, docs, items), want)


def test_no_documents_or_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f"), (None, "z")], "item_id long, text string")
    assert decontaminate.find_passages(docs.where("false"), bench).count() == 0
    assert decontaminate.find_passages(docs, bench.where("false")).count() == 0
    assert decontaminate.find_passages(docs, bench).count() == 1
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()] == [None]


def test_equal_fingerprints_are_found_at_every_distance_in_the_radius(spark):
    r = random.Random(9)
    base = r.getrandbits(63)
    rows = []
    for n in range(decontaminate.RADIUS + 1):
        flipped = base
        for b in r.sample(range(63), n):
            flipped ^= 1 << b
        rows.append((n, flipped))
    blocks = lambda df: df.selectExpr("n", "p").select("n", "p")
    frame = spark.createDataFrame(rows, "n int, p long")
    cut = blocks(frame).select("n", F.inline(decontaminate.blocks_of(F.col("p"), decontaminate.RADIUS)))
    base_blocks = cut.where("n = 0").drop("n")
    assert cut.join(base_blocks, ["block", "value"]).select("n").distinct().count() == len(rows)


# Search


def brute_top(rows, is_query, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 3, 400])
def test_top_k(spark, monkeypatch, n):
    monkeypatch.setattr(top_k, "BLOCK", 32)
    r = random.Random(n)
    rows = [(i, [float(r.choice([-1, -0.5, 0, 0.5, 0.25, r.gauss(0, 1)])) for _ in range(8)]) for i in range(n)]
    rows += [(1000, None), (1001, [None] * 8), (1002, [math.nan] * 8), (1003, [math.inf] + [0.0] * 7), (None, [1.0] * 8)] if n else []
    rows += [(2000 + i, rows[5][1]) for i in range(6)] if n > 5 else []
    frame = spark.createDataFrame([(*x, 1, 2.0) for x in rows], "vec_id long, embedding array<float>, label int, norm double").repartition(5)
    got = top_k.top_k(frame, F.col("vec_id") % 10 == 0, 5).collect()

    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(tuple(x) for x in got) == brute_top(single, lambda i: i % 10 == 0, 5)


def test_top_k_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = QUERIES["op8_exact_top_k"](spark, SMALL)
    want = con.execute(SQL["op8_exact_top_k"]).fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


# Pipeline


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == names, name
        assert 0.9 * rows < docs.count() <= rows, name
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_pipeline_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, found_lang string, keep int"
    rows = [(1, None, None, None, None, "x", 1), (None, "words of no id", "en", "s", 3, None, 2), (2, "", "de", "s", 0, "y", 3)]
    rows += [(i, f"some english words number {i} and more of them here", "en", "s", 9, "z", 4) for i in range(3, 30)]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, "a passage")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.where("false")):
        out = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.stored(stage(spark, out, str(tmp_path)), "test-odd")
            assert out.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path))
        assert packed.count() == out.count()
