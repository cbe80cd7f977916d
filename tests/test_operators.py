"""Merges, the store, runs, export, WARC, feeds and HTML on small fixtures."""

import gzip
import io
import json
import random
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.functions.feeds import raw_feed
from tidewell.functions.html import extract
from tidewell.operators import merge, runs
from tidewell.operators.catalog import Catalog
from tidewell.operators.export import export_rows, json_lines, stream_json_lines
from tidewell.sources import collectors, files, warc  # noqa: F401

RECORD = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <http://h/%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"


def record(i, body=b"<html><title>T</title>x y</html>"):
    content = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    return RECORD % (i, len(content), content)


def greedy(rows):
    """Row by row, as unique keys on both columns would take them."""
    a, b, out = set(), set(), []
    for i, x, y in rows:
        if x not in a and y not in b:
            out.append((i, x, y))
            a |= {x} - {None}
            b |= {y} - {None}
    return out


def test_two_unique_keys(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([*range(12), None]), rng.choice([*range(12), None])) for i in range(80)]
    for r in (rows, [(0, 1, 1), (1, 2, 1), (2, 1, 2), (3, 2, 2)]):
        batch = spark.createDataFrame(r, f"{merge.ORDINAL} long, a int, b int").selectExpr("*", f"{merge.ORDINAL} i")
        got = merge.insert_ignore(None, batch, [["a"], ["b"]]).appended.select("i", "a", "b").collect()
        assert sorted(map(tuple, got)) == greedy(r)


def test_fail_policy(spark):
    one = spark.createDataFrame([(1,), (None,), (None,)], "id int")
    assert merge.insert_fail(None, one, [["id"]]).appended.count() == 3
    with pytest.raises(ValueError):
        merge.insert_fail(one, one, [["id"]])


def test_ignore_counts_and_batches(spark, tmp_path):
    store = Catalog(spark, str(tmp_path))
    assert store.init() == 7 and store.init() == 0
    assert [(r.version, r.name) for r in store.table("_migrations").orderBy("version").collect()][::6] == [(1, "meta"), (7, "landed_files")]
    rows = spark.range(2500).selectExpr("id % 2000 as seq", "'p' as payload", f"id as {merge.ORDINAL}")
    assert store.commit({"test_records": rows}, {"test": "{}"}, ("s", 0))["test_records"] == {"fetched": 2500, "inserted": 2000, "duplicates": 500}
    assert store.commit({"test_records": rows}, batch=("s", 0)) == {}
    assert store.commit({"test_records": rows}, batch=("s", 1))["test_records"]["inserted"] == 0
    assert store.table("test_records").count() == 2000 and store.state("test") == "{}"
    store.clear_state("test")
    assert store.state("test") == ""


def test_a_merge_reads_only_folders_that_hold_its_keys(spark, tmp_path):
    """New keys are merged though all data files are gone; a known key needs its own folder alone."""
    store = Catalog(spark, str(tmp_path))
    rows = lambda ids: spark.createDataFrame([(i, None if n is None else f"o/{n}") for i, n in ids], "id long, full_name string")
    for k in range(3):
        store.commit({"github_repositories": rows([(100 * k + i, 100 * k + i) for i in range(50)] + [(None, None)])})
    first, second, third = store.manifest().tables["github_repositories"]
    hidden = [f for name in (first, third) for f in (tmp_path / name).glob("part-*")]
    for f in hidden:
        f.rename(f.with_suffix(".hidden"))
    m = store.manifest()
    batch = rows([(900, 900), (901, 901), (None, None)])
    assert store._meeting("github_repositories", batch, m) == []
    assert store.commit({"github_repositories": batch})["github_repositories"]["inserted"] == 3
    both = rows([(110, 990), (991, 111), (992, 992), (992, 993)])  # keys of the second folder: one by id, one by name
    assert store._meeting("github_repositories", both, store.manifest()) == [second]
    assert store.commit({"github_repositories": both})["github_repositories"] == {"fetched": 4, "inserted": 1, "duplicates": 3}
    for f in hidden:
        f.with_suffix(".hidden").rename(f)
    assert store.table("github_repositories").count() == 3 * 51 + 3 + 1
    store.compact("github_repositories")
    assert store.commit({"github_repositories": both})["github_repositories"]["inserted"] == 0


def test_replaced_rows_are_noted_not_rewritten(spark, tmp_path, monkeypatch):
    store = Catalog(spark, str(tmp_path))
    rows = lambda pairs: spark.createDataFrame([(u, t) for u, t in pairs], "url string, title string")
    want = {f"u{i}": "old" for i in range(200)} | {None: "no key"}
    store.commit({"rss_feeds": rows(want.items())})
    (first,) = store.manifest().tables["rss_feeds"]
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / first).iterdir()}
    monkeypatch.setattr("tidewell.operators.catalog.MOST_NOTES", 3)
    for turn in range(6):
        change = {f"u{turn}": f"new {turn}", f"u{turn + 1}": f"newer {turn}", f"v{turn}": "added"}
        counts = store.commit({"rss_feeds": rows([*change.items(), (f"v{turn}", "added")])})
        assert counts["rss_feeds"] == {"fetched": 4, "inserted": 3, "duplicates": 0}
        want |= change
        m = store.manifest()
        assert first in m.tables["rss_feeds"] and len(m.gone["rss_feeds"]) <= 3
        assert {r.url: r.title for r in store.table("rss_feeds").collect()} == want and store.table("rss_feeds").count() == len(want)
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / first).iterdir()} == files
    store.compact("rss_feeds")
    assert "rss_feeds" not in store.manifest().gone and len(store.manifest().tables["rss_feeds"]) == 1
    assert {r.url: r.title for r in store.table("rss_feeds").collect()} == want


def test_runs(spark, tmp_path):
    store = Catalog(spark, str(tmp_path))
    assert runs.run(store, "test", {"count": 100})["records"] == 100
    assert runs.run(store, "test", {"count": 100})["records"] == 100
    assert runs.run(store, "test", {"count": 1000}, max_records=250)["records"] == 250
    assert runs.run(store, "test", {"count": 100}, resume=False)["duplicates"] == 100
    assert store.table("test_records").count() == 450
    assert runs.run(store, "rss", {"path": str(tmp_path / "none")})["status"] == "failed"
    assert store.table("_errors").count() == 1
    latest = {r.source: r for r in runs.status(store).collect()}
    assert latest["test"].id == 4 and json.loads(latest["test"].state)["seq"] == 100


def test_a_run_stands_as_running_until_it_ends(spark, tmp_path, monkeypatch):
    store = Catalog(spark, str(tmp_path))
    seen = []

    def interrupted(ctx):
        seen.append([(r.id, r.source, r.status, r.finished_at) for r in store.table("_runs").collect()])
        raise KeyboardInterrupt
        yield

    monkeypatch.setitem(runs.SOURCES, "test", (interrupted, "stops"))
    row = runs.run(store, "test")
    assert seen == [[(1, "test", "running", None)]] and row["status"] == "cancelled"
    assert [(r.status, r.finished_at is None) for r in store.table("_runs").collect()] == [("cancelled", False)]
    assert store.state("test") == "" and store.start_run("rss", row["started_at"]) == 2


def test_zipped_events(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    line = lambda i: "\t".join([str(i)] + [""] * 58 + ["20260202154500", "http://h"])
    with zipfile.ZipFile(landed / "20260202154500.export.CSV.zip", "w") as z:
        z.writestr("a.csv", "\n".join([*(line(i) for i in range(50)), "", "short\trow"]))
    store = Catalog(spark, str(tmp_path / "store"))
    assert runs.run(store, "gdelt", {"path": str(landed)})["status"] == "completed"
    rows = store.table("gdelt_events").collect()
    assert len(rows) == 50 and rows[0].actor1_code is None and str(rows[0].date_added_at) == "2026-02-02 15:45:00"
    assert store.table("gdelt_files").count() == 1
    assert runs.run(store, "gdelt", {"path": str(landed)})["records"] == 0


def test_feeds_run(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.xml").write_text("<feed><title>F</title><entry><id>1</id><link rel='self' href='http://s'/><link href='http://a'/><category term='x'/><updated>2026-02-02</updated></entry></feed>")
    (landed / "b.xml").write_text("no feed")
    store = Catalog(spark, str(tmp_path / "store"))
    assert runs.run(store, "rss", {"path": str(landed)})["errors"] == 1
    (item,) = store.table("rss_items").collect()
    assert (item.guid, item.url, item.categories) == ("1", "http://a", "x") and str(item.updated_at) == "2026-02-02 00:00:00"
    assert runs.run(store, "rss", {"path": str(landed)})["records"] == 0


def test_feed_text():
    assert raw_feed("<?xml version='1.0' encoding='ISO-8859-1'?><rss><channel><title>é</title></channel></rss>".encode("latin-1"))["channel"]["title"] == "é"
    assert raw_feed(b"<?xml version='1.0' encoding='koi8-r'?><rss/>")["error"]
    assert raw_feed(None)["error"] and raw_feed(b"")["error"]
    loose = raw_feed(b"<rss version=2.0><channel><title>a<br>b</title><item><title>x<b>y</title></item></channel></rss>")
    assert (loose["error"], loose["channel"]["title"], loose["items"][0]["title"]) == (None, "a", "x")
    assert all(raw_feed(x)["error"] for x in (b"<rss><channel><title>x", b"<a></b></a>", b"no feed"))
    assert raw_feed(b"<rss><channel><title>a & b&nbsp;<![CDATA[<c>]]></title></channel></rss>")["channel"]["title"] == "a & b\xa0<c>"


def test_warc_and_pages(spark, tmp_path):
    parts = [gzip.compress(record(i)) for i in range(5)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(parts))
    spark.dataSource.register(warc.WarcSource)
    rows = spark.read.format("warc").option("paths", str(path)).load().collect()
    assert [r.target_uri for r in rows] == [f"http://h/{i}" for i in range(5)] and rows[0].type == "response"
    targets = [(i, "C", "u", "s", "d", "a.warc.gz" if i < 4 else "gone.gz", sum(map(len, parts[:i])), len(parts[i])) for i in range(5)]
    df = spark.createDataFrame(targets, "index_id long, crawl string, url string, stamp string, digest string, filename string, offset long, length long")
    pages = sorted(warc.page_rows(warc.fetch_records(df, str(tmp_path)), store_text=True).collect(), key=lambda r: r.index_id)
    assert [r.title for r in pages] == ["T"] * 4 + [None] and pages[0].text == "x y" and pages[4].error
    with pytest.raises(warc.MalformedRecord):
        list(warc.records(io.BytesIO(b"junk\r\n")))


def test_bad_archives_are_rows(spark, tmp_path):
    """A negative length, a record cut off in plain and in gzip, junk: the records before it, then an error; the other archives go on."""
    good = b"".join(record(i) for i in range(3))
    bad = {"a.warc": good, "b.warc": good + b"WARC/1.0\r\nContent-Length: -1\r\n\r\n" + good, "c.warc": good + record(9)[:-60], "d.warc.gz": gzip.compress(good)[:-12], "e.warc": b"junk\r\n", "f.warc": b""}
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
    spark.dataSource.register(warc.WarcSource)
    rows = spark.read.format("warc").option("paths", ",".join(str(tmp_path / n) for n in [*bad, "gone.warc"])).load().collect()
    whole, errors = {}, {}
    for r in rows:
        of = errors if r.error else whole
        of.setdefault(r.path.rpartition("/")[2], []).append(r.error or r.target_uri)
    assert {n: len(x) for n, x in whole.items() if n != "d.warc.gz"} == {"a.warc": 3, "b.warc": 3, "c.warc": 3} and {n: len(x) for n, x in errors.items()} == dict.fromkeys(("b.warc", "c.warc", "d.warc.gz", "e.warc", "gone.warc"), 1)
    assert "-1" in errors["b.warc"][0] and "cut off" in errors["c.warc"][0]


def test_pages_are_fetched_by_several_tasks(spark, tmp_path, monkeypatch):
    targets, at = [], 0
    for k in range(40):
        parts = [gzip.compress(record(100 * k + i, b"<title>%d</title>" % (100 * k + i))) for i in range(5)]
        (tmp_path / f"{k}.warc.gz").write_bytes(b"".join(parts))
        targets += [(100 * k + i, "C", "u", "s", "d", f"{k}.warc.gz", sum(map(len, parts[:i])), len(parts[i]) if (k, i) != (7, 2) else 20) for i in range(5)]
    df = spark.createDataFrame(targets, "index_id long, crawl string, url string, stamp string, digest string, filename string, offset long, length long")
    fetched = warc.fetch_records(df, str(tmp_path), 4)
    assert fetched.groupBy(F.spark_partition_id()).count().count() == 4
    pages = warc.page_rows(fetched).collect()
    assert len(pages) == 200 and [p.index_id for p in pages if p.error] == [702]
    assert all(p.title == str(p.index_id) for p in pages if not p.error)
    some = pd.DataFrame([(f, o, 10) for f, o in (("a", 0), ("a", 50), ("a", 200_000), ("b", 200_010), ("b", 200_015))], columns=["filename", "offset", "length"])
    assert [[(t.filename, t.offset) for t in run] for run in warc.spans(some)] == [[("a", 0), ("a", 50)], [("a", 200_000)], [("b", 200_010), ("b", 200_015)]]


def test_crawl_index_run(spark, tmp_path):
    lines = [f'com,x)/{i} 20260202154500 {{"url": "http://x/{i}", "status": "200"}}' for i in range(20)] + ["broken"]
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "cdx-00000.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    store = Catalog(spark, str(tmp_path / "store"))
    options = {"crawl": "C", "index": str(landed)}
    assert runs.run(store, "commoncrawl", options)["status"] == "completed"
    assert store.table("commoncrawl_index").count() == 20
    assert store.table("commoncrawl_shards").first().lines == 21
    assert runs.run(store, "commoncrawl", options)["records"] == 0


def test_html():
    page = extract("<html lang=en><meta property='og:title' content='O'><link rel=Canonical href='/c'><a href='/a#f'>A <b>b</b></a><a href='#x'>no</a><script>s</script><p>é x", "http://h/p")
    assert (page["title"], page["language"], page["canonical"]) == ("O", "en", "http://h/c")
    assert page["links"] == [{"href": "http://h/a", "rel": "", "text": "A b"}]
    assert page["text"] == "A b no é x" and page["text_length"] == 12
    assert extract(None) is None and extract("")["text_length"] == 0


def test_export(spark, tmp_path):
    rows = spark.createDataFrame([(1, float("nan"), b"\xff", '{"b": 1, "a": 2}'), (2, 1.5, b"ok", None)], "id int, d double, raw binary, j string")
    out = [json.loads(r.value) for r in json_lines(rows, detect_json=True).collect()]
    assert out == [{"id": 1, "d": None, "raw": {"$base64": "/w=="}, "j": {"b": 1, "a": 2}}, {"id": 2, "d": 1.5, "raw": "ok", "j": None}]
    plan = json_lines(rows, detect_json=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    odd = spark.sql("""select 1.50 as dec, date'2026-02-02' as day, timestamp'2026-02-02 15:45:00.25' as at, timestamp_ntz'2026-02-02 15:45:00' as local, float(0.5) as f, array(double('inf'), 1.0D) as xs, map(1, double('nan')) as m,
        named_struct('b', X'ff', 'n', cast(null as double)) as s, '{"z": [1, 2.5, "t"], "a": {"k": null}}' as j, '[1, ' as broken, 'x' as t, '"q"' as q, cast(null as string) as n, cast(null as binary) as nb""")
    (line,) = json_lines(odd, detect_json=True).collect()
    assert json.loads(line.value) == {"dec": "1.50", "day": "2026-02-02", "at": "2026-02-02 15:45:00.250000+00:00", "local": "2026-02-02 15:45:00", "f": 0.5, "xs": [None, 1.0], "m": {"1": None}, "s": {"b": {"$base64": "/w=="}, "n": None},
                                      "j": {"z": [1, 2.5, "t"], "a": {"k": None}}, "broken": "[1, ", "t": "x", "q": '"q"', "n": None, "nb": None}
    path = str(tmp_path / "o.jsonl.gz")
    assert stream_json_lines(json_lines(rows.select("id")), path) == 2
    assert gzip.open(path, "rt").read().count("\n") == 2
    rows.createOrReplaceTempView("exported")
    assert export_rows(spark, table="exported", where="id > 1").count() == 1 and export_rows(spark, query="select 1 as x", limit=0).count() == 0
    for bad in ({"table": "a;b"}, {"table": "missing"}, {}, {"query": "select 1 as x, 2 as x"}):
        with pytest.raises(ValueError):
            export_rows(spark, **bad)


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from tidewell.__main__ import main

    settings = tmp_path / "c.yaml"
    settings.write_text("sources:\n  test:\n    count: 5\n  rss:\n    enabled: false\n")
    common = ["--store", str(tmp_path / "store"), "--config", str(settings)]
    assert main([*common, "init"]) == 0 and main([*common, "run", "all"]) == 0 and main([*common, "run", "nothing"]) == 2
    assert main([*common, "export", "--table", "test_records", "--order-by", "seq", "--limit", "2"]) == 0
    assert main([*common, "export", "--query", "select max(seq) as m from test_records"]) == 0 and main([*common, "export", "--table", "none"]) == 2
    assert main([*common, "status"]) == 0 and main([*common, "sources"]) == 0
    assert main([*common, "run", "test", "--since", "soon"]) == 2 and main([*common, "export", "--query", "select nothing"]) == 2
    monkeypatch.setitem(runs.SOURCES, "test", (lambda ctx: (_ for _ in ()).throw(KeyboardInterrupt), "stops"))
    assert main([*common, "run", "test", "rss"]) == 130
    out = capsys.readouterr().out
    assert "test: completed, 5 rows" in out and '{"m":4}' in out and "rss\tdisabled" in out


def test_keys_apart_are_not_read(spark, tmp_path):
    store = Catalog(spark, str(tmp_path))
    for _ in range(2):
        runs.run(store, "test", {"count": 10})
    m = store.manifest()
    first, second = m.tables["test_records"]
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("seq"))
    assert store._apart("test_records", rows(20, 30), m) == {first, second} and store._apart("test_records", rows(5, 9), m) == {second}
    assert store._meeting("test_records", rows(9, 12), m) == [first, second]
    assert runs.run(store, "test", {"count": 15}, resume=False)["duplicates"] == 15 and store.table("test_records").count() == 20


def test_keys_are_hashed_once(spark, tmp_path, monkeypatch):
    """New rows' keys are read once for all that is asked of them; rows that aren't all added leave no hashes behind."""
    store, hashed = Catalog(spark, str(tmp_path)), []
    monkeypatch.setattr(Catalog, "_hashes", lambda self, rows, name, of=Catalog._hashes: hashed.append(name) or of(self, rows, name))
    rows = lambda urls: spark.createDataFrame([("C", u, "s") for u in urls], "crawl string, surt string, stamp string")
    for urls in (["a", "z", None], ["b", "y"]):
        hashed.clear()
        assert store.commit({"commoncrawl_index": rows(urls)})["commoncrawl_index"]["inserted"] == len(urls) and hashed == ["commoncrawl_index"]
    assert store.commit({"commoncrawl_index": rows(["b", "c", "c", None])})["commoncrawl_index"] == {"fetched": 4, "inserted": 2, "duplicates": 2}
    m = store.manifest()
    assert {f"{tmp_path}/{x}" for x in m.keys.values()} == {str(x) for x in (tmp_path / "commoncrawl_index").glob("keys-*")}
    assert [spark.read.parquet(f"{tmp_path}/{m.keys[x]}").select("folder").distinct().collect() for x in m.tables["commoncrawl_index"]] == [[(x,)] for x in m.tables["commoncrawl_index"]]
    assert store.table("commoncrawl_index").count() == 7
