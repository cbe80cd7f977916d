import random
import re

from tidewell.llm.license_texts import APACHE_NOTICE, MIT, TEMPLATES
from tidewell.llm.licenses import license_scan


def norm(text):
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_finds_planted_and_only_them(spark, docs_schema):
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(300)]
    rows, want = [], set()
    for i in range(120):
        words = rng.choices(filler, k=rng.randint(0, 400))
        if i % 3 == 0:
            name, text = TEMPLATES[i // 3 % len(TEMPLATES)]
            at = rng.randint(0, len(words))
            words[at:at] = text.split()
            want.add((i, name))
        rows.append((i, " ".join(words), "en", "s", 1))
    got = {(r.doc_id, r.license_id): r for r in license_scan(spark.createDataFrame(rows, docs_schema)).collect()}
    assert want <= set(got) and all(r.containment >= 0.8 for r in got.values())
    for i, name in got:  # what else is found holds a template of that license as well
        mine = shingles(norm(rows[i][1]))
        assert any(n == name and len(shingles(norm(t)) & mine) >= 0.8 * len(shingles(norm(t))) for n, t in TEMPLATES)
    for (i, name), r in got.items():
        if (i, name) in want and name == "GPL-3.0":
            assert norm(rows[i][1])[r.word + 0 :][:30].count("gnu") >= 1 or "spdx" in norm(rows[i][1])


def test_near_copy_and_odd_rows(spark):
    text = APACHE_NOTICE.replace("express", "expressed")
    rows = [(1, text, 0.5), (2, None, 0.5), (3, "", 0.5), (4, "a b", 0.5), (1, text, 0.5), (5, "Released under the MIT License. " * 3000, 0.5), (None, "Licensed under CC BY-NC 4.0.", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, containment double")
    got = sorted(((r.doc_id, r.license_id) for r in license_scan(df).collect()), key=str)
    assert got == [(1, "Apache-2.0"), (1, "Apache-2.0"), (5, "MIT"), (None, "CC-BY-NC-4.0")]
    assert license_scan(df.limit(0)).collect() == []
    assert license_scan(df, []).collect() == []


def test_short_notices(spark):
    rows = [
        (1, "w " * 40 + "(c) 2020. ALL  rights\nreserved."), (2, "all rights are reserved"), (3, "All rights reserved. " * 50), (4, "// SPDX-License-Identifier: MIT"), (5, "rights reserved"), (6, None),
        (7, "Released under the MIT License. All rights reserved."), (8, "X y all rights reserved"), (8, "X y all rights reserved"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.license_id, r.containment, r.word) for r in license_scan(df).collect())
    reserved = "All-rights-reserved"
    assert got == [(1, reserved, 1.0, 42), (3, reserved, 1.0, 0), (4, "MIT", 1.0, 0), (7, reserved, 1.0, 5), (7, "MIT", 1.0, 0), (8, reserved, 1.0, 2), (8, reserved, 1.0, 2)]
    own = [("A", "x"), ("B", "X, y"), ("B", "w w"), ("C", "..."), ("D", "reserved rights")]
    got = sorted((r.doc_id, r.license_id, r.word) for r in license_scan(df, own).collect())
    assert got == [(1, "B", 0), (8, "A", 0), (8, "A", 0), (8, "B", 0), (8, "B", 0)]


def brute(text, templates):
    """(license, containment, word) of the best window of each template, over all windows: no bands, no hashes."""
    words = norm(text)
    marks = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    best = {}
    for name, template in templates:
        t = norm(template)
        own = shingles(t)
        n = len(own)
        if not t:
            continue
        if not own:
            found = [(1.0, -i) for i in range(len(words) - len(t) + 1) if words[i : i + len(t)] == t]
        else:
            step = max(1, n // 8)
            around = lambda k: set(marks[max(0, (k - 1) * step) : max(0, (k - 1) * step) + n + (2 if k else 1) * step])
            found = [(len(own & around(k)) / n, -k * step) for k in range((len(marks) - 1) // step + 1)] if marks else []
        found = [x for x in found if x[0] >= 0.8]
        if found:
            best[name] = max([*found, *([best[name]] if name in best else [])])
    return {(name, c, -w) for name, (c, w) in best.items()}


def test_against_all_windows(spark, docs_schema):
    """Templates with words changed, left out and put in, whole or in part: what the scan finds is what all windows give, but for a few that bands miss."""
    rng = random.Random(8)
    filler = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(260):
        words = rng.choices(filler, k=rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 1)] = rng.choices(filler, k=rng.randint(0, 2))
            lost = rng.choice([0, 0, rng.randint(0, len(t) // 4)])
            at = rng.randint(0, len(words))
            words[at:at] = t[lost:] if rng.random() < 0.5 else t[: len(t) - lost]
        rows.append((i, " ".join(words), "en", "s", 1))
    want = {(i, *x) for i, text, *_ in rows for x in brute(text, TEMPLATES)}
    got = {(r.doc_id, r.license_id, r.containment, r.word) for r in license_scan(spark.createDataFrame(rows, docs_schema)).collect()}
    assert len(want) > 150
    assert {x[:2] for x in got} <= {x[:2] for x in want}
    assert len({x[:2] for x in got}) >= 0.98 * len({x[:2] for x in want}) and len(got & want) >= 0.95 * len(want)


def test_whole_texts(spark):
    rows = [(1, "Copyright 2024 A\n\n" + MIT), (2, MIT.replace('"Software"', "Software")), (3, MIT[: len(MIT) // 3])]
    got = {(r.doc_id, r.license_id): r.containment for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, "MIT"] == 1.0 and got[2, "MIT"] == 1.0
    whole = [("whole", MIT)]
    assert [r.doc_id for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string"), whole).orderBy("doc_id").collect()] == [1, 2]
