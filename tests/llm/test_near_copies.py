import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import near_copies


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def components(rows):
    root = {r[0]: r[0] for r in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {r[0]: shingles(r[1]) for r in rows}
    for a in sorted(sets):
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in root}


def planted():
    """Copies with edits at their ends or in their middle, a bucket over PAIRWISE of one family and one of strangers, odd rows."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(900)]
    texts = [None, "", " \n", "a b c", "A  b c", "a b c d e f"]
    for size in (12, 40, 90, 250):
        for _ in range(4):
            base = rng.choices(words, k=size)
            texts.append(" ".join(base))
            for cut in (1, size // 20, size // 11, size // 8, size // 5):
                texts += [" ".join(base[: size - cut] + rng.choices(words, k=cut)), " ".join(base[cut:])]
    base = rng.choices(words, k=60)
    texts += [" ".join(base[: 60 - i % 14] + rng.choices(words, k=i % 14)) for i in range(70)]
    texts += [" ".join(base[:20] + rng.choices(words, k=3)) for _ in range(50)]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_all_near_copies_and_only_them(spark, docs_schema):
    rows = planted()
    want = components(rows)
    assert len(set(want.values())) < len(rows) - 60
    docs = spark.createDataFrame(rows, docs_schema)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_every_way_gives_the_same(spark, docs_schema, monkeypatch):
    """Hot shingles in parts, further rounds for texts without a link, and large buckets held against each other in parts."""
    rows = planted()
    want = components(rows)
    docs = spark.createDataFrame(rows, docs_schema)
    for changed in ({"HOT": 10_000, "SINGLES": 2, "GROUP": 16, "BLOCK": 16}, {"SINGLES": 0}, {"BLOCK": 3}, {"COUNTERS": 1 << 12}):
        for name, value in changed.items():
            monkeypatch.setattr(near_copies, name, value)
        assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want


def test_counts_bound_what_sets_share():
    rng = np.random.default_rng(3)
    for n in (50, 900, 1100, 5000):
        pool = rng.integers(-(2**63), 2**63, 2 * n)
        for kept in (0, n // 2, n - n // 20, n):
            x, y = np.unique(pool[:n]), np.unique(np.concatenate((pool[:kept], pool[n : 2 * n - kept])))
            shared = len(np.intersect1d(x, y))
            a, b = (near_copies.counts(h, near_copies.CELLS) for h in (x, y))
            assert near_copies.most_shared(*(np.frombuffer(c, np.uint16) for c in (a, b))) >= shared
            a, b = (near_copies.counts(h, near_copies.FINE) for h in (x, y))
            if 9 * shared >= 4 * (len(x) + len(y)):
                assert near_copies.finely(a, b, len(x) + len(y)) and near_copies.finely(b"", b, 0)
            elif kept == 0:
                assert not near_copies.finely(a, b, len(x) + len(y))


def test_buckets_pass_in_parts(monkeypatch):
    rng = random.Random(1)
    sizes = [1, 2, 3, 1, 1, 40, 2, 5, 30, 1, 2]
    rows = [(shingle, -1, fp, 9) for shingle, size in enumerate(sizes) for fp in sorted(rng.sample(range(1000), size))]
    want = []
    for shingle in range(len(sizes)):
        own = [fp for s, _, fp, _ in rows if s == shingle]
        if len(own) > 1:
            want += [(shingle, fp, 9, own[0], 9, len(own) > 2) for fp in own if len(own) > 2 or fp != own[0]]
    for group in (100, 7):
        monkeypatch.setattr(near_copies, "GROUP", group)
        for step in (1, 4, 33, 1000):
            batches = [pa.RecordBatch.from_pylist([dict(zip(("shingle", "salt", "fp", "n"), r)) for r in rows[i : i + step]]) for i in range(0, len(rows), step)]
            got = [tuple(r.values()) for b in near_copies.stars(iter(batches)) for r in b.to_pylist()]
            assert got == want


def test_a_bucket_of_many_unlinked_texts(spark):
    """20,000 texts of one bucket that share little more: no part holds over two blocks, and what is dealt grows with the texts, not with their square."""
    k = 20_000
    rng = np.random.default_rng(5)
    rows = []
    for i in range(k):
        first = [7, *(rng.integers(1, 2**62, 4)).tolist(), *(1000 + rng.integers(0, 40, 2)).tolist()]
        rows.append((i, 30, np.bincount(rng.integers(0, near_copies.CELLS, 30), minlength=near_copies.CELLS).astype(np.uint16).tobytes(), first))
    for i in range(0, 200, 2):  # pairs that the counts let pass
        rows[i + 1] = (i + 1, 30, *rows[i][2:])
    nodes = spark.createDataFrame(rows, "fp long, n long, cells binary, first array<long>")
    apart = nodes.select(F.lit(7).cast("long").alias("shingle"), "fp", "n", F.col("fp").alias("root")).cache()
    main = near_copies.mains(apart.groupBy("shingle", "root").agg(F.count("*").alias("c")))
    got = {tuple(sorted(r)) for r in near_copies.across(apart, main, nodes, 8).collect()}
    assert got >= {(i, i + 1) for i in range(0, 200, 2)} and len(got) < 1000
    many = near_copies.with_main(apart, main)
    assert many.filter(F.col("late") > near_copies.BLOCK).count() == k
    per = near_copies.in_blocks(many).groupBy("shingle", "part").count()
    assert per.agg(F.max("count")).first()[0] <= 2.2 * near_copies.BLOCK and per.agg(F.sum("count")).first()[0] <= k * 7


def test_blocks_hold_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 5)
    same = np.full(near_copies.CELLS, 1, np.uint16).tobytes()
    for main in (0, 23):
        rows = [(i, 1, same, 0 if i < main else i, [9]) for i in range(50)]
        nodes = spark.createDataFrame(rows, "fp long, n long, cells binary, root long, first array<long>")
        apart = nodes.select(F.lit(1).cast("long").alias("shingle"), "fp", "n", "root")
        dealt = near_copies.with_main(apart, near_copies.mains(apart.groupBy("shingle", "root").agg(F.count("*").alias("c"))))
        want = {(a, b) for a in range(50) for b in range(a + 1, 50) if rows[a][3] != rows[b][3]}
        for way in (near_copies.in_blocks, near_copies.in_parts):
            got = [tuple(sorted(r)) for r in near_copies.compared(way(dealt), nodes, 4).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_a_pair_counts_in_one_bucket(spark):
    """Texts that need several common shingles are a pair in the bucket of the first of them only, wherever else they meet."""
    same = np.full(near_copies.CELLS, 1, np.uint16).tobytes()
    rows = [(i, 10, same, [5, 3 + i % 2, 8, 6 + i]) for i in range(12)]  # three needed of ten; the last is the next one
    nodes = spark.createDataFrame(rows, "fp long, n long, cells binary, first array<long>")
    got = []
    for shingle in (5, 3, 4, 8):
        apart = spark.createDataFrame([(shingle, r[0], 10, r[0]) for r in rows if shingle in r[3]], "shingle long, fp long, n long, root long")
        dealt = near_copies.with_main(apart, near_copies.mains(apart.groupBy("shingle", "root").agg(F.count("*").alias("c"))))
        got.append([tuple(sorted(r)) for r in near_copies.compared(near_copies.in_parts(dealt), nodes, 2).collect()])
    assert sorted(got[0]) == [(a, b) for a in range(12) for b in range(a + 1, 12)] and got[1:] == [[], [], []]


def test_links_of_many_alike_are_no_pairs(spark, docs_schema, monkeypatch):
    """A bucket of 300 texts, all similar, that no link connects yet: rows once for each block, links that connect them all, and none to a stranger."""
    rng = random.Random(3)
    base = rng.choices([f"w{i}" for i in range(900)], k=100)
    rows = [(i, " ".join(base + [f"x{i}"] * (i % 3 + 1)), "en", "s", 0) for i in range(300)] + [(300 + i, " ".join(base[:80] + rng.choices(base, k=20)), "en", "s", 0) for i in range(9)]
    want = components(rows)
    assert len(set(want.values())) == 10
    docs = spark.createDataFrame(rows, docs_schema)
    nodes = near_copies.prefixes(docs, 5, np.zeros(near_copies.COUNTERS, np.uint16)).cache()
    apart = nodes.select(F.lit(7).cast("long").alias("shingle"), "fp", "n", F.col("fp").alias("root"))
    main = near_copies.mains(apart.groupBy("shingle", "root").agg(F.count("*").alias("c")))
    for shingles, blocks in ((near_copies.SHINGLES, 1), (10_000, 4)):
        monkeypatch.setattr(near_copies, "SHINGLES", shingles)
        dealt = near_copies.across(apart, main, nodes, 4, deal=True).cache()
        assert dealt.count() <= 309 * 2 * blocks
        links = near_copies.decided(dealt, nodes, docs, 5, 4)
        assert links.count() <= 2 * blocks * 309
        found = near_copies.named(nodes.select("doc_id", "text_hash", "fp"), nodes.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")), links)
        assert {r.doc_id: r.component_id for r in found.collect()} == want


def test_small_blocks_give_the_same(spark, docs_schema, monkeypatch):
    rows = planted()
    want = components(rows)
    docs = spark.createDataFrame(rows, docs_schema)
    monkeypatch.setattr(near_copies, "SINGLES", 10_000)
    for changed in ({"SHINGLES": 400}, {"SHINGLES": 1, "BLOCK": 3}):
        for name, value in changed.items():
            monkeypatch.setattr(near_copies, name, value)
        assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want


def test_simhash_finds_first(spark, docs_schema, monkeypatch):
    """Sets whose SimHashes lie three bits or fewer apart are connected by simhash's links before any other step; the sets confirm each."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=400)), "en", "s", 0) for i in range(20)]
    rows += [(20 + i, rows[i % 20][1] + f" x{i}" * (i // 20 + 1), "en", "s", 0) for i in range(60)] + [(80, None, "en", "s", 0), (81, rows[0][1].upper(), "en", "s", 0)]
    docs = spark.createDataFrame(rows, docs_schema)
    seen = []

    def first(pairs, *rest):
        seen.append({(r.a, r.b) for r in pairs.collect()})
        return verified(pairs, *rest)

    verified = near_copies.verified
    monkeypatch.setattr(near_copies, "verified", first)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == components(rows)
    of = {r.fp: r.print for r in near_copies.prefixes(docs, 5, np.zeros(near_copies.COUNTERS, np.uint16)).collect()}
    near = {(a, b) for a in of for b in of if a != b and ((of[a] ^ of[b]) % 2**64).bit_count() <= 3}
    root = {a: a for a in of}

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in seen[0]:
        assert (a, b) in near
        root[top(a)] = top(b)
    assert len(near) >= 60 and all(top(a) == top(b) for a, b in near)
