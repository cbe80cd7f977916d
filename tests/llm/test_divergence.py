"""The source divergence audit against plain Python, in one block and in many."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    ("en", "a", "Red red blue, GREEN 1 2 red-blue"), ("en", "a", "red blue yellow"), ("en", "b", "blue blue red green"), ("en", "b", None), ("en", None, "green Übung übung red"),
    ("en", "c", ""), ("en", "c", "12 34 !!"), (None, "a", "one two three"), (None, None, "one two"), ("", "x", "one One ONE"), ("de", "solo", "wort wort Wort"), ("de", "solo", "wort"), ("de", "solo", "wort das"),
    ("fr", "p", "mot rare"), ("fr", "q", "autre"), ("en", "d", "blue " * 50_000 + "red"),
]


def brute(rows, least=3, ranks=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        having = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in having.items() if n >= least]
        groups = defaultdict(Counter)
        for d in docs:
            if d[0] == lang:
                groups[d[1]].update(t for t in d[2] if t in set(kept))
        total = sum(groups.values(), Counter())

        def share(c, t):
            return 1 + 1_000_000_000 * (c[t] + 1) // (c.total() + len(kept))

        for s, c in groups.items():
            f = {o: sum((share(c, t) - share(x, t)) ** 2 // share(x, t) for t in kept) for o, x in groups.items() if o != s}
            g = {t: (share(c, t) - share(total, t)) ** 2 // share(total, t) for t in kept if c[t] and share(c, t) > share(total, t)}
            for part, values, most in (("pair", f, len(f)), ("term", g, ranks)):
                best = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(best)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, source, 1, 2) for i, (lang, source, text) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, value long")


def audited(df, **more):
    return sorted(tuple(r) for r in divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize(("cells", "held"), [(divergence.CELLS, divergence.HELD), (6, 5)])
def test_audit(spark, monkeypatch, cells, held):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "HELD", held)
    assert audited(table(spark, ROWS)) == brute(ROWS)
    assert audited(table(spark, ROWS * 2), least_docs=4, ranks=2) == brute(ROWS * 2, 4, 2)
    assert audited(table(spark, ROWS).limit(0)) == []


def test_many_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 500)
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        words = rng.zipf(1.3, 60) % 700
        rows.append((["en", "de"][i % 7 == 0], f"s{rng.integers(0, 9) if i % 3 else 0}", " ".join(f"w{chr(97 + w % 26)}{chr(97 + w // 26)}" for w in words)))
    assert audited(table(spark, rows), ranks=20) == brute(rows, ranks=20)


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    for top in (10, 10**6, 9 * 10**15):
        total = rng.integers(1, top, 200)
        count = (rng.random(200) * total).astype(np.int64).clip(0, total - 1)
        assert divergence.shares(count, total).tolist() == [1 + 1_000_000_000 * (c + 1) // t for c, t in zip(count.tolist(), total.tolist())]
