"""Operator 13 against plain Lloyd rounds over Python integers, and against its SQL."""

import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tidemark.llm import vector_codes
from tidemark.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = defaultdict(list)
            for c in cut:
                got[nearest(p, c[p])[1]].append(c[p])
            new.append([[sum(col) // len(col) for col in zip(*got[k], strict=True)] if got[k] else old for k, old in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, per_label = [], defaultdict(int)
    for (i, _, label), c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        per_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return ordered([(i, code, error, per_label[label], digest) for i, code, error, label in out])


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def vectors(spark, rows):
    named = [(*r, "x", 1.0, 0) for r in rows]
    return spark.createDataFrame(named, "vec_id long, embedding array<double>, label int, code string, v double, ids int")


def cloud(n, seed, step=None, size=16):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(n):
        x = [c + r.gauss(0, 0.3) for c in r.choice(centres)]
        rows.append((i * 7 % n, [round(a / step) * step for a in x] if step else x, r.choice([None, 0, 1, 1, 1, 2])))
    return rows


@pytest.mark.parametrize("step", [None, 0.5, 2.0])
def test_equals_plain_rounds(spark, step):
    """Coarse grids make ties and repeated vectors."""
    rows = cloud(400, 3, step)
    assert ordered(vector_codes.code_report(vectors(spark, rows).repartition(5)).collect()) == brute(rows)


def test_odd_rows(spark):
    rows = cloud(60, 5) + [
        (None, [0.5] * 16, 1), (None, [0.5] * 16, None), (3, [0.25] * 16, 2), (3, [0.25] * 16, 2), (900, None, 1), (901, [math.nan] * 16, 1),
        (902, [math.inf] + [0.0] * 15, 0), (-5, [None] + [0.0] * 15, 0), (903, [-1e3] * 16, None), (2**53 + 1, [0.0] * 16, 4),
    ]
    assert ordered(vector_codes.code_report(vectors(spark, rows)).collect()) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 15])
def test_fewer_rows_than_entries(spark, n):
    rows = cloud(n, n)
    assert ordered(vector_codes.code_report(vectors(spark, rows)).collect()) == brute(rows)


def test_other_sizes(spark):
    rows = cloud(150, 9, 0.25, size=12)
    got = vector_codes.code_report(vectors(spark, rows), parts=3, entries=40, rounds=4, scale=10)
    assert ordered(got.collect()) == brute(rows, 3, 40, 4, 10)


def test_no_rows(spark):
    assert vector_codes.code_report(vectors(spark, [])).count() == 0
    assert vector_codes.code_report(vectors(spark, [(1, None, 2)])).count() == 0


@pytest.mark.parametrize("bad", [[(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)], [(1, [1.0] * 9, 0)], [(1, [1e30] * 8, 0)]])
def test_refused(spark, bad):
    with pytest.raises(ValueError):
        vector_codes.code_report(vectors(spark, bad))


def test_bounds_hold(spark):
    """Bounds stay below the true distances and in order, whatever the width."""
    r = np.random.default_rng(1)
    x, book = r.integers(-500, 500, (300, 4)), r.integers(-500, 500, (16, 4))
    state = vector_codes.Bounds.fresh(x, book, 4)
    for width in (4, 6, 2, 1, 8, 3):
        new = book + r.integers(-60, 60, book.shape)
        moved = np.sqrt(((new - book) ** 2).sum(1)) * 1.000001
        state, needed = state.resized(width).advance(x, new, moved)
        book = new
        true = vector_codes.distances(x, book)
        assert (state.entry == true.argmin(1)).all()
        far = np.sqrt(true)
        rows = np.arange(len(x))
        listed = np.zeros(true.shape, bool)
        for k in range(width):
            # a padded place repeats the outer bound and stands for no entry
            real = state.lower[:, k] < state.outer
            assert (state.lower[real, k] <= far[rows, state.closest[:, k]][real]).all()
            listed[rows[real], state.closest[real, k]] = True
        listed[rows, state.entry] = True
        assert (np.where(listed, np.inf, far).min(1) >= state.outer).all()
        assert (np.diff(state.lower, axis=1) >= 0).all() and needed.max() <= width + 1


@pytest.mark.parametrize("folder", [SMALL])
def test_query_equals_sql(spark, folder):
    got = QUERIES["op13_vector_codes"](spark, folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert ordered(got.collect()) == ordered(db.execute(SQL["op13_vector_codes"]).fetchall())
    assert got.columns == [d[0] for d in db.description]
