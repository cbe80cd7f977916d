"""The registered queries against brute force on whole small tables, and the operators on odd rows."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import decontaminate, langid, lines, mixing, quality, sharding, simhash, tokens
from tidewell.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "lorem ipsum dolor sit amet " * 40_000
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "a b c d e f", None, "a", 9), (4, "a b c d e f", "en", "a", None), (4, "a b c d e f", "en", "a", 1),
    (5, LONG, "en", "b", 5), (6, "\n \t\n", "en", "b", 5), (7, "Ünïcode ÀÉ  x", "fr", "c", 5), (None, "some text here", "en", "a", 1),
]


@pytest.fixture(scope="module")
def table():
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM read_parquet('{SF_DIR}/documents.parquet')").fetchall() if os.path.isdir(SF_DIR) else []
    return {r[0]: r for r in rows}


def found(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}


@pytest.fixture
def odd(spark, docs_schema):
    names = docs_schema + ", size long, shard int, words long"  # names that operators might use
    return spark.createDataFrame([(*r, 7, 7, 7) for r in ODD], names)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.fetchall(), key=str)


@needs_tables
def test_shards(spark, table):
    got = found(spark, "op3_shards")
    assert got.keys() == table.keys()
    slots = defaultdict(list)
    for i, r in got.items():
        data = (table[i][1] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(40)]
    assert max(counts) - min(counts) <= 1


def fingerprint(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


@needs_tables
def test_simhash(spark, table):
    got = found(spark, "op4_simhash")
    prints = {i: fingerprint(r[1]) for i, r in table.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == components(prints)


@needs_tables
def test_tokens(spark, table):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    for i, r in found(spark, "op6_tokens").items():
        text = table[i][1] or ""
        n = len(model.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def targets(total):
    """Targets of sources by the words that they have."""
    sources = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), 1.5 * sum(total.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * total[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= over
    return target


@needs_tables
def test_mix(spark, table):
    got = found(spark, "op7_mix")
    size = {i: len(WORD.findall(r[1] or "")) for i, r in table.items()}
    total = Counter()
    for i, n in size.items():
        total[table[i][3]] += n
    target = targets(total)
    taken = Counter()
    for i, r in got.items():
        assert r.size == size[i] and r.source_size == total[table[i][3]] and r.taken <= 2 * size[i]
        assert r.target == pytest.approx(target[table[i][3]], rel=1e-9)
        taken[table[i][3]] += r.taken
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 600
    again = found(spark, "op7_mix")
    assert {i: r.taken for i, r in got.items()} == {i: r.taken for i, r in again.items()}


@needs_tables
def test_language(spark, table):
    got = found(spark, "op9_language")
    good = [table[i][2] == r.lang_pred for i, r in got.items() if r.held_out and table[i][2] is not None]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    assert sum(good) >= 0.85 * len(good)


def near_copies(texts):
    """Least id of each text's component under links of five-word shingle sets with a Jaccard similarity of 0.8 or more."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(ASCII_LOWER))
        sets[i] = {" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def cut(text, windows):
    """Words (of decontamination) of a text, and which of them lie in a window."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(ASCII_LOWER))
    hit = [False] * len(words)
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit[i : i + n] = [True] * n
    return words, hit


@needs_tables
def test_pipeline(spark, table):
    """Near copies and benchmark passages by brute force; language, the mix and the shards by their laws."""
    docs = corpus_pipeline.docs_of(spark, SF_DIR)
    items = duckdb.sql(f"SELECT text FROM read_parquet('{SF_DIR}/benchmark.parquet')").fetchall()
    kept = {r.doc_id: r for r in corpus_pipeline.language(spark, docs, SF_DIR).collect()}
    assert len(kept) >= 0.7 * len(table)
    one = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(list(kept.values()), docs.schema), SF_DIR)
    want = set(near_copies({i: r.text for i, r in kept.items()}).values())
    assert sorted(r.doc_id for r in one.collect()) == sorted(want) and one.columns == docs.columns
    windows = set()
    for (text,) in items:
        w, _ = cut(text, set())
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    left = {}
    for r in one.collect():
        words, hit = cut(r.text, windows)
        if sum(hit) <= 0.5 * len(words):
            left[r.doc_id] = [w for w, h in zip(words, hit) if not h]
    clean = corpus_pipeline.benchmarks(spark, one, SF_DIR)
    assert {r.doc_id: cut(r.text, set())[0] for r in clean.collect()} == left and clean.columns == docs.columns
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in clean.collect()}
    size = {i: len(WORD.findall(t or "")) for i, t in texts.items()}
    taken = Counter()
    for r in out:
        words = WORD.findall(r.text)
        taken[r.doc_id] += len(words)
        assert words == WORD.findall(texts[r.doc_id]) or set(words) <= set(WORD.findall(texts[r.doc_id]))
    assert all(n <= 2 * size[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.02)
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.get(k, 0) for k in range(40)) <= 1


def test_quality_odd(spark, odd):
    long = next(r for r in quality.quality_verdicts(odd).collect() if r.doc_id == 5)
    assert (long.n_words, long.n_repeat_words, long.base_failed) == (200_000, 200_000, True)
    short = [(i, t and t[:3000], *more) for i, t, *more in ODD]  # the SQL's time grows with the square of a text's words
    rows = quality.quality_verdicts(odd.withColumn("text", F.substring("text", 1, 3000)))
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", short)
    want = con.execute(ORACLE_SQL["op1_quality"])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r) for r in rows.select(columns).collect()))) == sorted(map(str, want.fetchall()))


def test_shards_odd(spark, odd):
    rows = sharding.assign_shards(odd.drop("shard"), ["source", "lang", "n_chars"], 4).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [2, 2, 2, 3]


def test_simhash_odd(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == "0" * 16 and by[2].component_id == by[6].component_id == 1 and by[3].component_id == by[4].component_id == 3


def test_mix_odd(spark, odd):
    rows = mixing.mix_summary(odd).collect()
    words = [len(WORD.findall(r[1] or "")) for r in ODD]
    total = Counter({r[3]: 0 for r in ODD})
    for r, n in zip(ODD, words):
        total[r[3]] += n
    target = targets(total)
    source = {(r[0], n): r[3] for r, n in zip(ODD, words)}
    assert sorted(((r.doc_id, r.size) for r in rows), key=str) == sorted(((r[0], n) for r, n in zip(ODD, words)), key=str)
    taken = Counter()
    for r in rows:
        s = source[r.doc_id, r.size]
        assert r.taken <= 2 * r.size and r.source_size == total[s] and r.target == pytest.approx(target[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 600 for s in target)


def test_decontaminate_odd(spark, odd):
    items = spark.createDataFrame([(1, "A b"), (2, None), (3, ""), (3, "lorem Ipsum dolor")], "item_id long, text string")
    by = {r.doc_id: r for r in decontaminate.contamination_summary(odd, items).collect()}
    assert by[3].n_hit == 2 and by[5].n_hit == 3 * 40_000 and by[1].n_words == 0 and not by[7].contaminated
    assert by[3].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert decontaminate.decontaminate(odd, items).columns == odd.columns
    assert decontaminate.contamination_summary(odd, items.limit(0)).filter("contaminated").count() == 0


def test_language_odd(spark, odd):
    by = {r.doc_id: r for r in langid.identify(odd, langid.train(odd)).collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[6].lang_pred == "und"


def test_lines_odd(spark, docs_schema):
    common = "this very common line has over forty code points in it"
    rows = [(i, f"  {common.upper()}\nown {i}\n{common}", "en", "s", 1) for i in range(6)] + [(None, common, "en", "s", 1), (9, None, "en", "s", 1)]
    by = {r.doc_id: r for r in lines.line_summary(spark.createDataFrame(rows, docs_schema)).collect()}
    assert by[0].n_dropped == 2 and by[0].kept_sha256 == hashlib.sha256(b"own 0").hexdigest()
    assert by[5].n_dropped == 0 and (by[9].n_lines, by[9].n_dropped) == (1, 0)


def test_tokens_odd(spark, odd):
    import public_tokenizers

    rows = tokens.token_counts(odd, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(rows) == len(ODD) and all(r.n_tokens == 0 for r in rows if r.doc_id in (1, 2))


def test_empty(spark, docs_schema):
    none = spark.createDataFrame([], docs_schema)
    assert quality.quality_verdicts(none).count() == simhash.near_duplicates(none).count() == mixing.mix_summary(none).count() == lines.line_summary(none).count() == 0
    assert sharding.assign_shards(none, ["source", "lang", "n_chars"], 4).count() == 0
    assert langid.identify(none, langid.train(none)).count() == 0
