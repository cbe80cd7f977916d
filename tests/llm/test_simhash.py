import random

from tidewell.llm import simhash
from tidewell.llm.graph import components


def roots_of(n_nodes, edges):
    root = {i: i for i in n_nodes}

    def top(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {i: top(i) for i in n_nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def prints(n):
    """Fingerprints in families: chains of one to four flipped bits, dense balls, and families that share one half."""
    rng = random.Random(9)
    out = set()
    while len(out) < n:
        base = at = rng.getrandbits(64)
        for _ in range(rng.randint(0, 12)):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.add(at)
        if rng.random() < 0.1:
            for _ in range(60):
                out.add(base ^ sum(1 << b for b in rng.sample(range(32), rng.randint(1, 9))))
        if rng.random() < 0.1:
            for _ in range(60):
                out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    return sorted(out)


def test_links_by_every_way(spark, monkeypatch):
    """Whole buckets, buckets dealt out by quarters, and buckets that a sample shows to be hot give the same components."""
    fps = prints(700)
    want = {b: roots_of(fps, [(x, y) for i, x in enumerate(fps) for y in fps[i + 1 :] if (x ^ y).bit_count() <= b]) for b in (1, 3)}
    table = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for bits, group, sample in ((3, simhash.GROUP, 20_000), (3, 4, 20_000), (3, 20, 300), (1, 4, 100)):
        monkeypatch.setattr(simhash, "SAMPLE", sample)
        edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(table, bits, group).collect()]
        assert all((x ^ y).bit_count() > 0 for x, y in edges)
        assert roots_of(fps, edges) == want[bits]


def test_hot_buckets_are_seen(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SAMPLE", 1000)
    rng = random.Random(4)
    fps = {rng.getrandbits(31) for _ in range(600)} | {rng.getrandbits(63) for _ in range(600)}
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    hot = {r.bucket for r in simhash.hot_buckets(table, len(fps), 100).collect()}
    assert {b >> 32 for b in hot} == set(range(32)) and all(b % 2**32 == 0 for b in hot)  # the upper half, which is zero in one family


def test_components_by_every_way(spark):
    """Random graphs, a path, and a star with most of all edges; nodes joined by broadcast, and by shuffle with hot nodes broadcast."""
    rng = random.Random(2)
    nodes = list(range(3000))
    edges = [(rng.randrange(1000), rng.randrange(1000)) for _ in range(500)] + [(i, i + 1) for i in range(1000, 1100)] + [(1500, i) for i in range(1501, 2900)] + [(2999, i) for i in range(2700, 2999)]
    edges += [(5, 5), (5, 7), (7, 5)]
    df = spark.createDataFrame([(a, b) for a, b in edges], "a long, b long")
    want = roots_of(nodes, edges)
    in_edges = {x for a, b in edges if a != b for x in (a, b)}
    for whole in (100_000, 0):
        got = {r.node: r.root for r in components(df, whole).collect()}
        assert all(want[n] == r for n, r in got.items()) and in_edges - set(want.values()) <= set(got)
    assert components(df.limit(0)).count() == 0
