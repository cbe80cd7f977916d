"""Exact dedup against plain Python: filters, snapshots, digests that collide, odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import exact_dedup
from tidewell.llm.exact_dedup import Fuse

ROWS = [
    (1, "a  b", 1), (2, "a\tb", 2), (2, "a\nb", 3), (2, "a b", 4), (3, "a b ", 5), (4, None, 6), (5, "", 7), (6, " ", 8), (7, "\x0b\x0c", 9), (8, "a b", 10), (None, "a b", 11), (None, "only without id", 12),
    (None, "only without id", 13), (9, "A b", 14), (10, "long text " * 50_000, 15), (11, "long\ntext  " * 50_000, 16), (12, "x", 17), (12, "y", 18), (12, "x", 19),
]


def brute(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    members = {}
    for (i, *_), b in zip(rows, body):
        members.setdefault(b, []).append(i)
    out, stays = [], set()
    for (i, *_), b in zip(rows, body):
        keep = min((x for x in members[b] if x is not None), default=None)
        kept = i == keep and b not in stays
        stays |= {b} if kept else set()
        out.append((i, keep, len(members[b]), kept, hashlib.sha256(b.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 100_000])
def test_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
    f = Fuse.build(keys)
    assert f.holds(keys).all() and f.cells.nbytes <= max(2 * n, 200)
    others = rng.integers(1 << 63, 1 << 64, 100_000, np.uint64)
    assert f.holds(others).mean() < 2 / 256


def test_filter_refuses_repeats():
    with pytest.raises(ValueError):
        Fuse.build(np.zeros(2, np.uint64))


@pytest.mark.parametrize("weak", [None, "pmod(xxhash64(body), 3)", "7L"])
@pytest.mark.parametrize("bucket", [exact_dedup.BUCKET, 4])
def test_classes(spark, monkeypatch, weak, bucket):
    monkeypatch.setattr(exact_dedup, "BUCKET", bucket)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, digest long")
    got = exact_dedup.duplicates(docs, digest=weak and F.expr(weak)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_snapshots(spark):
    """A later batch learns what earlier ones have; what it has itself more than once is counted."""
    rows = spark.createDataFrame([(i, d) for i, d in enumerate([5, 5, 6, 7, 8, 8, 8])], "doc_id long, digest long")
    first, known = exact_dedup.arrive(rows, [])
    assert known == [] and {tuple(r) for r in first.collect()} == {(5, 0, 2), (6, 2, 1), (7, 3, 1), (8, 4, 3)}
    old = exact_dedup.snapshot(first)
    later = spark.createDataFrame([(20, 8), (21, 9), (22, 9), (19, 8), (23, 5)], "doc_id long, digest long")
    new, (known,) = exact_dedup.arrive(later, [old])
    assert {tuple(r) for r in new.collect()} == {(9, 21, 2)} and {tuple(r) for r in known.collect()} == {(8, 19, 2), (5, 23, 1)}
    assert old.digests.count() == 4


def test_keep_one(spark):
    docs = spark.createDataFrame([(*r[:2], 0, r[2]) for r in ROWS], "doc_id long, text string, copies long, `a.b` long")
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter(r[0] for r in brute(ROWS) if r[3])
    none = exact_dedup.keep_one(docs.limit(0))
    assert none.count() == 0 and none.columns == docs.columns and exact_dedup.duplicates(docs.limit(0)).count() == 0


def test_hot_copies(spark):
    """A third of all rows is one text: counted before the shuffle, and looked up by broadcast."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 700}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    assert sorted(map(tuple, exact_dedup.duplicates(docs).collect()), key=str) == brute(rows)
