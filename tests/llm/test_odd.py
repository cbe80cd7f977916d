"""Every pipeline stage and operator on nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from tidewell.llm import chat, decontaminate, langid, licenses, lines, mixing, near_copies, quality, sharding, simhash, tokens

CLASH = ["tw_n", "tw_rank", "TW_hash", "text_hash", "size", "shard_", "slot_", "copy", "n_alike", "k", "parts", "spans", "items", "lost", "bits", "at", "word", "row", "a.b", "fp", "component_id"]
EN = "the cat sat on the mat and then it went to the old house by the river "
DE = "der hund lief durch den wald und fand dort einen alten knochen unter dem baum "
ROWS = [
    (1, EN * 3 + "one", "en", "a", 9),
    (1, EN * 3 + "one", "en", "a", 9),
    (1, EN * 3 + "one", None, "a", None),
    (2, None, "en", "a", 0),
    (3, "", "de", None, 0),
    (4, " \n\t ", "de", None, 3),
    (5, DE * 4 + "zwei", "de", None, 7),
    (None, DE * 2 + "drei vier", "de", "b", 7),
    (None, DE * 2 + "drei vier", "de", "b", 7),
    (6, EN * 20_000, "en", "c", 1),
    (7, "Größe ÀÉ maß straße über öl", None, "c", 5),
    (8, "12345 67890 !!!", "en", "c", 5),
]


def table(spark, rows, clash=True):
    extra = CLASH if clash else []
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, *range(len(extra))) for r in rows], schema + "".join(f", `{c}` long" for c in extra))
    return df


def bench(spark, rows=((1, "the cat sat on the mat and then it went to the old"), (None, "der hund lief durch den wald und fand dort einen"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


@pytest.fixture
def stage(spark, tmp_path):
    bench(spark, [(1, "some words that no document of these has at all in it")]).write.parquet(str(tmp_path / "benchmark.parquet"))
    return lambda name: lambda docs: dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_names(spark, stage, name):
    docs = table(spark, ROWS)
    out = stage(name)(docs)
    assert [c for c in out.columns if c not in ("shard", "slot")] == docs.columns
    got = out.select(*(f"`{c}`" for c in CLASH)).collect()
    assert got and all(list(r) == list(range(len(CLASH))) for r in got)
    none = stage(name)(docs.limit(0))
    assert none.columns == out.columns and none.count() == 0


def test_language_stage(spark, stage):
    got = Counter(r.doc_id for r in stage("op9_language")(table(spark, ROWS)).collect())
    assert got[1] == 3 and got[5] == 1 and got[None] == 2 and got[6] == 1 and not got.keys() & {2, 3, 4, 8}


def test_near_copies_stage(spark, stage):
    docs = table(spark, ROWS)
    assert Counter(r.doc_id for r in stage("op4_simhash")(docs).collect()) == Counter([1, 2, 5, 7, 8])  # 6 repeats what 1 has; null texts and those without words are alike; so are the two without id and 5
    assert simhash.keep_one(docs).columns == docs.columns and near_copies.keep_one(docs.filter("doc_id is null")).count() == 1


def test_decontamination_stage(spark):
    docs = table(spark, ROWS)
    got = {}
    for r in decontaminate.decontaminate(docs, bench(spark), max_coverage=0.7).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {i: len(x) for i, x in got.items()} == {2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, None: 2}
    assert got[2][0].text is None and got[3][0].text == "" and got[4][0].text == " \n\t " and got[7][0].n_chars == 5
    assert "hund" not in got[5][0].text and got[5][0].n_chars == len(got[5][0].text)
    assert decontaminate.decontaminate(docs, bench(spark).limit(0)).count() == len(ROWS)


def test_many_automata_find_what_one_does(spark, monkeypatch):
    rows = [(i, f"w{i} " + EN * (i % 3) + f"x{i} y{i} " + DE * (i % 2) + f"common tail number {i % 4} with a few more words to be long enough", "en", "s", 0) for i in range(60)]
    docs = table(spark, rows + ROWS, clash=False)
    items = bench(spark, [(i, f"common tail number {i % 4} with a few more words to be long enough") for i in range(9)] + [(20, EN * 30), (21, DE), (None, "x17 y17"), (22, "to be"), (23, None)])
    want = sorted(map(str, decontaminate.contamination(docs, items).collect()))
    clean = sorted(map(str, decontaminate.decontaminate(docs, items, max_coverage=0.9).collect()))
    monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", 60)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 25)
    assert len(decontaminate.automata(items, 10)) > 5
    assert sorted(map(str, decontaminate.contamination(docs, items).collect())) == want
    assert sorted(map(str, decontaminate.decontaminate(docs, items, max_coverage=0.9).collect())) == clean
    by = {r.doc_id: r for r in decontaminate.contamination_summary(docs, items).collect()}
    assert by[17].n_items == 6 and by[17].items_sha256 == hashlib.sha256(b"1,20,21,22,5").hexdigest()  # and the one without an id


def test_mix_stage(spark):
    docs = table(spark, ROWS)
    out = mixing.mixed_documents(docs).collect()
    taken, words = Counter(), Counter()
    for i, text, *_ in ROWS:
        words[i] += len((text or "").split())
    for r in out:
        taken[r.doc_id] += len(r.text.split())
        assert len(r.text) == r.n_chars or r.text in {t for _, t, *_ in ROWS}
    assert not taken.keys() & {2, 3, 4} and all(n <= 2 * words[i] for i, n in taken.items())
    summary = Counter()
    for r in mixing.mix_summary(docs).collect():
        summary[r.doc_id] += r.taken
    assert taken == +summary
    again = mixing.mixed_documents(docs).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_many_alike_rows_share_the_mix(spark):
    rows = [(1, "a b c d e f g", "en", "a", 3)] * 40 + [(i, f"x{i} y z", "en", "b", 3) for i in range(40)]
    recipe = mixing.Recipe(block=4)
    docs = table(spark, rows, clash=False)
    want = Counter()
    for r in mixing.mix_summary(docs, recipe).collect():
        want[r.doc_id] += r.taken
    got = Counter()
    for r in mixing.mixed_documents(docs, recipe).collect():
        got[r.doc_id] += len(r.text.split())
    assert got == +want and 0 < got[1] <= 2 * 7 * 40


def test_mix_grows_with_the_corpus():
    small, large = mixing.sized(mixing.Recipe(), 1000), mixing.sized(mixing.Recipe(), 10**13)
    assert (small.block, small.shards) == (64, 64) and large.block == 4096 and large.shards == 15 * 10**12 // 4096 // 100_000


def test_shards_are_written_and_pruned(spark, tmp_path):
    out = sharding.assign_shards(table(spark, ROWS), ["source", "lang", "n_chars"], 4)
    ranges = {r.shard: r for r in sharding.shard_ranges(out, ["n_chars"]).collect()}
    rows = out.collect()
    for s, r in ranges.items():
        own = [x.n_chars for x in rows if x.shard == s and x.n_chars is not None]
        assert (r.n_rows, r.min_n_chars, r.max_n_chars) == (sum(x.shard == s for x in rows), min(own, default=None), max(own, default=None))
    path = str(tmp_path / "shards")
    sharding.write_shards(out, path, 4)
    back = spark.read.parquet(path)
    assert Counter(r.shard for r in back.collect()) == Counter(r.shard for r in rows)
    assert all([r.slot for r in spark.read.parquet(f"{path}/shard={s}").collect()] == list(range(ranges[s].n_rows)) for s in ranges)


def test_long_common_prefixes_are_told_apart(spark):
    rows = [(i, "t", "en", f"https://www.example.com/site/{i % 37:02}", i) for i in range(1000)]
    out = sharding.assign_shards(table(spark, rows), ["source"], 10)
    ranges = sorted((r.min_source, r.max_source) for r in sharding.shard_ranges(out, ["source"]).collect())
    assert all(int(b[-2:]) - int(a[-2:]) <= 6 for a, b in ranges) and len(set(ranges)) == 10


def test_curve_visits_neighbours():
    """Each step of the curve goes to a cell beside the last one, and it meets every cell once."""
    import numpy as np

    for bits, d in ((3, 2), (2, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        at = sharding.hilbert_index(cells, bits)
        assert sorted(at.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(1) == 1).all()


def test_bad_host_is_rejected(spark):
    """A host whose documents mostly fail takes the others with it; a host of one failed document is shrunk towards all."""
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "too short" if i % 10 else good, "en", "bad", 0) for i in range(200)] + [(1000 + i, f"{good} {i}", "en", f"h{i % 9}", 0) for i in range(900)] + [(5000, "short", "en", "new", 0), (5001, None, "en", None, 0)]
    got = {r.doc_id: r for r in quality.quality_verdicts(table(spark, rows)).collect()}
    assert {r.host_rejected for i, r in got.items() if i < 200} == {True} and not any(r.kept for i, r in got.items() if i < 200)
    assert not got[0].base_failed and all(r.kept for i, r in got.items() if 1000 <= i < 5000)
    assert got[5000].base_failed and not got[5000].kept and got[5001].base_failed


def test_lines_with_clashing_names(spark):
    common = "this very common line has over forty code points in it"
    rows = [(i, f"own {i}\n{common}", "en", "s", 1) for i in range(6)] * 30 + [(None, common, "en", "s", 1), (9, None, "en", "s", 1), (10, "", "en", "s", 1)]
    docs = table(spark, rows)
    out = lines.drop_common_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out.collect()}
    assert out.count() == len(rows) and got[0] == ("own 0", 2, 1) and got[5] == (f"own 5\n{common}", 2, 0) and got[None] == ("", 1, 1) and got[9] == (None, 1, 0) and got[10] == ("", 1, 0)


def test_rare_labels_are_not_learned(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de", "s", 0) for i in range(40)] + [(100 + i, "qq zz", f"dirt{i}", "s", 0) for i in range(30)]
    docs = table(spark, rows)
    assert langid.train(docs, most_languages=2).languages == ["de", "en"]
    assert len(langid.train(docs, most_languages=20).languages) == 20
    got = {r.lang_pred for r in langid.identify(docs, langid.train(docs, most_languages=2)).collect()}
    assert got == {"de", "en"}


def test_no_pre_token_is_shuffled(spark, monkeypatch):
    import public_tokenizers

    docs = table(spark, ROWS)
    out = tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    seen = []
    real = type(docs).toLocalIterator
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda self, *a: seen.append(self._jdf.queryExecution().executedPlan().toString()) or real(self, *a))
    table_of = tokens.frequent_lengths(docs, public_tokenizers.path("piece_bpe_32k.model"), size=50)
    assert seen and "Exchange" not in seen[0] and 0 < len(table_of) <= 50
    assert tokens.token_counts(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_operators_leave_other_columns_out(spark):
    docs = table(spark, ROWS)
    for out in (quality.quality_verdicts(docs), licenses.license_scan(docs), simhash.near_duplicates(docs), decontaminate.contamination_summary(docs, bench(spark)), mixing.mix_summary(docs), langid.identify(docs, langid.train(docs)), lines.line_summary(docs)):
        assert "tw_n" not in out.columns and out.count() in (0, len(ROWS))
    talk = spark.createDataFrame([(1, 0, "user", "a", 5)], "conv_id long, turn long, role string, text string, tw_rank long")
    assert chat.link_quotes(talk).count() == 1
