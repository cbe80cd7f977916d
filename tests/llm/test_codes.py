"""Product codes against a scan of all entries in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from tidewell.llm import codes


def brute(rows, entries=256, parts=4, rounds=4):
    """code and error by vec_id, and the codebooks' digest."""
    rows = sorted((r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(rows[0][1]) // parts
    x = [[[math.floor(1024 * v) for v in r[1][k * d : k * d + d]] for r in rows] for k in range(parts)]
    books = [[list(v) for v in part[:entries]] for part in x]

    def near(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            of = [near(books[k], v)[1] for v in x[k]]
            for e in set(of):
                mine = [v for v, i in zip(x[k], of) if i == e]
                books[k][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[near(books[k], x[k][i]) for k in range(parts)] for i in range(len(rows))]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in f), sum(e for e, _ in f)) for r, f in zip(rows, found)], digest


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code long, error long")


def check(spark, rows, kind="float", of=None):
    want, digest = brute(of or rows)
    got = codes.compress(table(spark, rows, kind)).collect()
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} == {digest}
    return got


def test_search_is_exact():
    rng = np.random.default_rng(0)
    book = rng.integers(-40, 40, (256, 3))
    book[100:120] = book[:20]  # equal entries
    x = rng.integers(-50, 50, (3000, 3))
    d = ((x[:, None] - book[None]) ** 2).sum(2)
    s = codes.Searcher(book)
    previous, _ = s.nearest(x, rng.integers(0, 256, 3000))
    assert (previous == d.argmin(1)).all()
    s.scanned = 0
    best, least = s.nearest(x, previous)
    assert (best == d.argmin(1)).all() and (least == d.min(1)).all() and s.scanned < 0.3 * d.size


def test_against_all_entries(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(400)]
    rows += [(i + 1000, rows[i][1], 7) for i in range(50)]  # equal vectors
    got = check(spark, rows)
    of = {r[0]: r[2] for r in rows}
    total = {}
    for r in got:
        total[of[r.vec_id]] = total.get(of[r.vec_id], 0) + r.error
    assert all(r.label_error == total[of[r.vec_id]] for r in got)


def test_odd_rows(spark):
    good = [(3, [0.5, -0.5, 1.0, 2.0], 1), (3, [0.25, -0.5, 1.0, 2.0], None), (None, [0.1, 0.1, 0.1, 0.1], None), (9, [0.5, -0.5, 1.0, 2.0], 1), (9, [0.5, -0.5, 1.0, 2.0], 1)]
    bad = [(1, None, 1), (2, [0.5, None, 1.0, 2.0], 1), (4, [math.nan, 0.0, 0.0, 0.0], 1), (5, [math.inf, 0.0, 0.0, 0.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1), (8, [1.0] * 8, 1)]
    check(spark, good + bad, of=good)
    none = codes.compress(table(spark, bad[:5]))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes.compress(table(spark, good).limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1e9, 1e40, 1e300])
def test_large_components(spark, scale):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(0, 1, 4) * scale).tolist(), 1) for i in range(300)]
    want, digest = brute(rows)
    got = codes.compress(table(spark, rows, "double")).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == {i: (c, min(e, codes.MOST)) for i, c, e in want} and got[0].codebooks_sha256 == digest
    assert got[0].label_error == min(sum(r.error for r in got), codes.MOST)


def test_round_trip(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2000, 2000, 8) / 1024).tolist(), 1) for i in range(300)]
    df = table(spark, rows)
    books, _ = codes.train(df)
    by = {i: v for i, v, _ in rows}
    for r in codes.restored(codes.compress(df).select("vec_id", "code", "error"), books).collect():
        assert round(sum((1024 * (a - b)) ** 2 for a, b in zip(by[r.vec_id], r.vector))) == r.error
