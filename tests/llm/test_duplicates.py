"""Operators 3, 6, 9 and 10 against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import jaccard_join, line_dedup, phrase_automata, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, tokens int, keep string, _id long, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x", 9, len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def varied(seed, n=60, sizes=(1, 3, 4, 5, 6, 9, 12, 40, 200)):
    """Texts with copies, edits, shared passages, blanks and nulls."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "ÀB", "B"]
    passage = " ".join(r.choice(words) for _ in range(80))
    out = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "ONE"), (5, "x " * 900)]
    for i in range(6, n):
        kind = r.random()
        if kind < 0.35 or len(out) < 10:
            text = " ".join(r.choice(words) for _ in range(r.choice(sizes)))
        elif kind < 0.8:
            parts = (r.choice(out)[1] or "").split(" ")
            for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
                parts[r.randrange(len(parts))] = r.choice(words)
            text = " ".join(parts)
        else:
            text = f"{r.choice(words)} {passage[r.randrange(50):]}\n{r.choice(words)}"
        out.append((i * 7 % 1009, text))
    r.shuffle(out)
    return out


def shingles(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_components(spark, seed):
    rows = varied(seed, 120)
    got = jaccard_join.near_duplicates(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == linked_components(rows)
    assert len(got) == len(rows)


def test_jaccard_at_the_threshold_and_in_chains(spark):
    """Sets of every small size that share exactly, just or not quite enough; a long chain."""
    rows, at = [], 0
    for n in range(5, 40):
        base = [f"b{n}x{i}" for i in range(n)]
        for cut in range(3):
            rows.append((at, " ".join(base[: n - cut])))
            at += 1
    long = [f"c{i}" for i in range(200)]
    rows += [(1000 + k, " ".join(long[3 * k : 3 * k + 60])) for k in range(40)]
    got = jaccard_join.near_duplicates(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == linked_components(rows)


def test_pairs_must_meet_in_every_order(spark):
    """No pair that links is lost by the filters, and pairs that only share a few tokens are."""
    r = random.Random(9)
    sets = {0: [], 1: []}
    pairs = []
    for k in range(300):
        base = [r.getrandbits(64) for _ in range(60)]
        other = base[: 54 if k % 2 else 2] + [r.getrandbits(64) for _ in range(6 if k % 2 else 58)]
        pairs.append((2 * k, 2 * k + 1))
        sets |= {2 * k: sorted(base), 2 * k + 1: sorted(other)}
    rows = [(i, np.array(t, np.uint64).tobytes()) for i, t in sets.items()]
    prefixes = jaccard_join._order_prefixes(spark.createDataFrame(rows, "doc_id long, tokens binary"))
    passed = {p.a for p in jaccard_join.met_in_all_orders(spark.createDataFrame(pairs, "a long, b long"), prefixes).collect()}
    assert {2 * k for k in range(300) if k % 2} <= passed
    assert len(passed) < 200


def test_components_of_a_path(spark):
    edges = spark.range(1, 400).selectExpr("id AS a", "id - 1 AS b")
    assert {r["label"] for r in components(edges).collect()} == {0}


def repeated_bytes(rows, size):
    starts = {}
    data = {k: (t or "").encode() for k, (_, t) in enumerate(rows)}
    for k, b in data.items():
        for i in range(len(b) - size + 1):
            starts[b[i : i + size]] = starts.get(b[i : i + size], 0) + 1
    out = []
    for k, (i, _) in enumerate(rows):
        b, gone = data[k], bytearray(len(data[k]))
        for s in range(len(b) - size + 1):
            if starts[b[s : s + size]] > 1:
                gone[s : s + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone), strict=False))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_bytes(spark, seed):
    rows = varied(seed, 70, (1, 40, 200, 400))
    rows += [(2000, "z" * 399), (2001, "y" * 400), (2002, "v" * 401), (2003, "ab" * 700), (2004, "é" * 500)]
    got = suffix_dedup.byte_digests(docs_of(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == repeated_bytes(rows, 400)


def repeated_words(rows):
    first = {}
    grams = lambda t: [tuple(t.split()[i : i + 13]) for i in range(len(t.split()) - 12)]
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for g in grams(t):
            first[g] = min(i, first.get(g, i))
    out = []
    for i, t in data:
        words, gone = t.split(), set()
        for s, g in enumerate(grams(t)):
            if first[g] < i:
                gone |= set(range(s, s + 13))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_phrases(spark, seed):
    rows = varied(seed, 120)
    got = phrase_automata.repeated_words(docs_of(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == repeated_words(rows)


def test_phrases_with_wide_letters(monkeypatch):
    """More words than code points: two letters a word give the same places."""
    docs = [[b"a", b"b", b"c", b"d"], [b"c", b"b", b"c", b"d", b"a"]]
    passages = {1: [(1, 4, 0)]}
    want = [list(x) for x in phrase_automata.locate(docs, [0, 1], passages)]
    plain = phrase_automata._Letters.__init__

    def wide(self, documents):
        plain(self, documents)
        words = dict.fromkeys(w for d in documents for w in d)
        self.size = 2
        for i, w in enumerate(words):
            words[w] = chr(self.HIGH + i // 2) + self._plain(i % 2)
        self.get = words.__getitem__

    monkeypatch.setattr(phrase_automata._Letters, "__init__", wide)
    assert [list(x) for x in phrase_automata.locate(docs, [0, 1], passages)] == want
    assert want[1] == [False, True, True, True, False]


def kept_lines(rows):
    ascii_lower = lambda b: b.strip(b"\t\n\v\f\r ").lower()
    first = {}
    for i, t in rows:
        for line in (t or "").encode().split(b"\n"):
            key = ascii_lower(line)
            if len(key.decode()) >= 10:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        keep = [x for x in lines if first.get(ascii_lower(x), i) == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256(b"\n".join(keep)).hexdigest()))
    return sorted(out)


def lined(seed):
    r = random.Random(seed)
    lines = ["", "short", "exactly10c", "Longer line of text", "  LONGER line of TEXT\t", "ééééé", "éééééééééé", "unique"]
    rows = [(0, None), (1, ""), (2, "\n\n")]
    rows += [(i, "\n".join(r.choice([*lines, f"own line of {i}"]) for _ in range(r.randrange(8)))) for i in range(3, 60)]
    return rows + [(100 + i, "common line of everyone") for i in range(200)]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, seed):
    rows = lined(seed)
    docs = docs_of(spark, rows)
    bits = line_dedup.keep_bitmaps(docs)
    assert sorted(tuple(r) for r in line_dedup.line_digests(docs, bits).collect()) == kept_lines(rows)
    cut = line_dedup.drop_lines(docs, bits)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    want = {i: sha for i, _, _, sha in kept_lines(rows)}
    assert {i: hashlib.sha256((t or "").encode()).hexdigest() for i, (t, _) in texts.items()} == want
    assert all(n == len(t or "") for t, n in texts.values())


@pytest.mark.parametrize(
    "run",
    [
        lambda d: jaccard_join.near_duplicates(d),
        lambda d: jaccard_join.drop_duplicates(d),
        lambda d: suffix_dedup.byte_digests(d),
        lambda d: phrase_automata.repeated_words(d),
        lambda d: phrase_automata.without_repeats(d),
        lambda d: line_dedup.drop_lines(d, line_dedup.keep_bitmaps(d)),
    ],
)
def test_empty_tables_null_ids_and_repeated_rows(spark, run):
    assert run(docs_of(spark, [])).count() == 0
    text = "one line that is long enough to count\n" + "again and again " * 60
    rows = [(None, text), (None, text), (1, text), (1, text), (2, text), (3, None)]
    assert run(docs_of(spark, rows)).count() > 0
    assert run(docs_of(spark, [(None, None)])).count() <= 1


@pytest.mark.parametrize("name", ["op9_line_dedup"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = sorted(dict(zip(names, r, strict=True)).items() for r in cur.fetchall())
    got = QUERIES[name](spark, SMALL)
    assert sorted(sorted(r.asDict().items()) for r in got.collect()) == sorted(sorted(x) for x in want)


def test_queries_match_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    jaccard = QUERIES["op3_jaccard_join"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard} == linked_components(rows)
    assert sorted(tuple(r) for r in QUERIES["op10_phrase_automata"](spark, SMALL).collect()) == repeated_words(rows)
    assert sorted(tuple(r) for r in QUERIES["op6_suffix_dedup"](spark, SMALL).collect()) == repeated_bytes(rows, 400)
