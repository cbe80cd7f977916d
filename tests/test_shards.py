"""Gzip shards by ranges, and runs batch by batch: nothing lost, nothing twice, wherever a run stops."""

import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import runs
from tidewell.operators.catalog import Catalog
from tidewell.sources import collectors, shards
from tidewell.streaming.incremental import merge_stream


def members(data, rng, most):
    """data as gzip members of random sizes; a line may go over several."""
    out, at = [], 0
    while at < len(data):
        n = rng.randint(1, most)
        out.append(gzip.compress(data[at : at + n], rng.choice([0, 1, 9])))
        at += n
    return b"".join(out)


def lines_of(blob, most, path="x"):
    got = []
    f = io.BytesIO(blob)
    for path, lo, hi, size in shards.cut(path, len(blob), 0, most):
        got += [x for at, block in shards.blocks(f, lo, hi, size) for x in shards.batch_of(path, at, block).column(2).to_pylist()]
    return got


@pytest.mark.parametrize("seed", range(12))
def test_each_line_once(seed):
    rng = random.Random(seed)
    lines = [rng.choice(["", "x" * rng.randint(0, 300), f"line {i} é", shards.MAGIC.decode("latin-1") * 3]) for i in range(300)]
    end = rng.choice(["\n", "\r\n"])
    data = (end.join(lines) + (end if seed % 2 else "")).encode()
    want = data.decode().split("\n")
    want = [x.removesuffix("\r") for x in (want[:-1] if not want[-1] else want)]
    blob = members(data, rng, rng.choice([7, 200, 5000, 10**6])) + (b"\0" * 50 if seed == 3 else b"")
    for most in (1, 37, 1000, 10**7):
        assert lines_of(blob, most) == want


def test_aligned_members_and_stored_copies():
    """Members that end with a line; a stored member that holds a gzip file's bytes, whose members aren't the shard's."""
    inner = gzip.compress(b"not a line\n")
    parts = [b"a\nb\n", inner.hex().encode() + b"\n", b"\xff" + inner.replace(b"\n", b"_") + b"\n", b"last"]
    blob = b"".join(gzip.compress(p, 0) for p in parts)
    want = b"".join(parts).decode(errors="replace").split("\n")
    for most in (5, 20, 1000):
        assert lines_of(blob, most) == want  # what follows the inner one is no member
    assert lines_of(b"", 10) == [] and lines_of(gzip.compress(b""), 10) == []


def test_cut_off_and_broken(tmp_path):
    good = [gzip.compress(f"line {i}\n".encode() * 50) for i in range(20)]
    path = tmp_path / "s.gz"

    def read(blob, most):
        path.write_bytes(blob)
        out = [b for r in shards.cut(str(path), len(blob), 0, most) for b in shards.read_ranges(shards.Ranges([r]))]
        return [x for b in out for x in b.column(2).to_pylist() if x is not None], [x for b in out for x in b.column(3).to_pylist() if x]

    whole = b"".join(good)
    for most in (10, 100, 10**6):
        lines, errors = read(whole[:-9], most)
        assert len(lines) >= 950 and any("cut off" in e for e in errors)
        lines, errors = read(whole + b"junk", most)
        assert len(lines) == 1000 and errors
        at = len(b"".join(good[:5])) + 14
        lines, errors = read(whole[:at] + b"\xff\xff\xff" + whole[at + 3 :], most)
        assert errors and len(lines) >= 250


def test_small_members_make_few_batches(tmp_path):
    """Many members of two lines: few batches of rows and few reads, each line with its member's byte, the lines before a break too."""
    parts = [gzip.compress(f"a{i}\nb{i} é\r\n".encode()) for i in range(2000)]
    path = tmp_path / "s.gz"
    path.write_bytes(b"".join(parts))
    part = shards.Ranges(shards.cut(str(path), path.stat().st_size))
    got = list(shards.read_ranges(part))
    assert len(got) == 1
    at = [sum(map(len, parts[:i])) for i in range(0, 2000, 500)]
    assert [r["at"] for r in got[0].to_pylist()[::1000]] == at
    assert got[0].column(2).to_pylist() == [x for i in range(2000) for x in (f"a{i}", f"b{i} é")]
    path.write_bytes(b"".join(parts) + b"junk")
    got = list(shards.read_ranges(part))
    assert [b.num_rows for b in got] == [4000, 1] and got[1].column(3)[0].as_py()
    assert max(b.nbytes for b in got) < 2 * shards.TOGETHER


def test_tasks_share_a_shard(spark, tmp_path):
    blob = b"".join(gzip.compress("".join(f"l{i} {j}\n" for j in range(100)).encode()) for i in range(40))
    (tmp_path / "a.gz").write_bytes(blob)
    spark.dataSource.register(shards.Cdx)
    rows = spark.read.format("cdx").option("path", str(tmp_path / "a.gz")).option("range_bytes", len(blob) // 5).load()
    assert rows.rdd.getNumPartitions() >= 5
    assert sorted(r.value for r in rows.collect()) == sorted(f"l{i} {j}" for i in range(40) for j in range(100))
    assert rows.groupBy(F.spark_partition_id()).count().count() >= 4


def index(tmp_path, n=4, each=300):
    folder = tmp_path / "index"
    folder.mkdir()
    for k in range(n):
        lines = [f'com,x)/{k}/{i:05} 20260202154500 {{"url": "http://x/{k}/{i}", "status": "200"}}\n' for i in range(each)] + ["broken\n"]
        (folder / f"cdx-{k:05}.gz").write_bytes(b"".join(gzip.compress("".join(lines[i : i + 20]).encode()) for i in range(0, len(lines), 20)))
    return folder


def test_index_goes_on_inside_a_shard(spark, tmp_path):
    folder = index(tmp_path)
    bytes_of = sum(f.stat().st_size for f in folder.iterdir())
    store = Catalog(spark, str(tmp_path / "store"))
    options = {"crawl": "C", "index": str(folder), "batch_bytes": bytes_of // 6, "range_bytes": 300}
    collect, batches = runs.SOURCES["commoncrawl"][0], []

    def stopped(ctx):
        for i, b in enumerate(collect(ctx)):
            batches.append(b.state)
            yield b
            if i == 1:
                raise KeyboardInterrupt

    with pytest.MonkeyPatch.context() as mp:
        mp.setitem(runs.SOURCES, "commoncrawl", (stopped, ""))
        row = runs.run(store, "commoncrawl", options)
    assert row["status"] == "cancelled" and row["records"] == store.table("commoncrawl_index").count() + store.table("commoncrawl_shards").count() > 0
    assert json.loads(store.state("commoncrawl")) == batches[-1] and batches[-1]["open"]["byte"] > 0
    first = row["records"]
    row = runs.run(store, "commoncrawl", options)
    assert row["status"] == "completed" and row["records"] + first == 4 * 300 + 4 and row["duplicates"] == 0
    assert {(r.shard, r.lines) for r in store.table("commoncrawl_shards").collect()} == {(f"cdx-{k:05}", 301) for k in range(4)}
    found = store.table("commoncrawl_index").agg(F.countDistinct("url"), F.countDistinct("id"), F.min("id")).first()
    assert found[0] == found[1] == 1200 and found[2] >= 1 and "open" not in json.loads(store.state("commoncrawl"))


def test_a_shard_that_breaks(spark, tmp_path):
    folder = index(tmp_path, 3)
    whole = (folder / "cdx-00001.gz").read_bytes()
    (folder / "cdx-00001.gz").write_bytes(whole[:-20])
    store = Catalog(spark, str(tmp_path / "store"))
    row = runs.run(store, "commoncrawl", {"crawl": "C", "index": str(folder)})
    assert row["status"] == "failed" and store.table("_errors").filter("context like 'ingest %cdx-00001.gz'").count() == 1
    assert [r.shard for r in store.table("commoncrawl_shards").collect()] == ["cdx-00000"] and store.table("commoncrawl_index").count() >= 880
    (folder / "cdx-00001.gz").write_bytes(whole)
    assert runs.run(store, "commoncrawl", {"crawl": "C", "index": str(folder)})["status"] == "completed"
    assert store.table("commoncrawl_index").count() == 900 and {r.lines for r in store.table("commoncrawl_shards").collect()} == {301}


def test_stream_of_shards(spark, tmp_path):
    from tidewell.sources import files

    folder = index(tmp_path, 2)
    store = Catalog(spark, str(tmp_path / "store"))
    spark.dataSource.register(shards.Cdx)

    def drain():
        lines = spark.readStream.format("cdx").option("path", str(folder)).option("range_bytes", 500).load()
        query = merge_stream(files.cdx_rows(lines.filter("error is null"), "C"), store, "commoncrawl_index", str(tmp_path / "checkpoint"), "cdx")
        assert query.awaitTermination(120)
        return store.table("commoncrawl_index").count(), store.manifest().number

    assert drain()[0] == 600
    number = store.manifest().number
    assert drain() == (600, number)
    (folder / "cdx-00000a.gz").write_bytes((folder / "cdx-00001.gz").read_bytes())
    late = "".join(f'com,y)/{i} 20260202154500 {{"url": "http://y/{i}"}}\n' for i in range(50))
    (folder / "cdx-00000b.gz").write_bytes(gzip.compress(late.encode()))
    assert drain()[0] == 650
    fetched = spark.read.parquet(*(f"{store.base}/{x}" for x in store.manifest().tables["commoncrawl_index"]))
    assert fetched.count() == fetched.select("url").distinct().count() == 650


def test_budget_loses_nothing(spark, tmp_path):
    landed = tmp_path / "feeds"
    landed.mkdir()
    for k in range(2):
        (landed / f"{k}.xml").write_text(f"<rss><channel><title>{k}</title>{''.join(f'<item><guid>{k}-{i}</guid></item>' for i in range(3))}</channel></rss>")
    store = Catalog(spark, str(tmp_path / "store"))
    seen = []
    for _ in range(9):
        row = runs.run(store, "rss", {"path": str(landed)}, max_records=2)
        seen.append(row["records"])
        assert row["status"] == "completed" and row["records"] <= 2 + 2
    assert store.table("rss_items").count() == 6 and sum(seen[:3]) == 6 and store.table("_landed_files").count() == 0
    assert runs.run(store, "rss", {"path": str(landed)})["status"] == "completed" and store.table("_landed_files").count() == 2
    assert runs.run(store, "test", {"count": 1000, "batch": 100}, max_records=250)["records"] == 250 and json.loads(store.state("test")) == {"seq": 250}
    assert runs.run(store, "test", {"count": 750, "batch": 100})["duplicates"] == 0
    assert store.table("test_records").agg(F.count("*"), F.max("seq")).first() == (1000, 999)


def test_failed_run_keeps_its_batches(spark, tmp_path, monkeypatch):
    store = Catalog(spark, str(tmp_path))
    collect = runs.SOURCES["test"][0]

    def failing(ctx):
        yield from (b for b, _ in zip(collect(ctx), range(2)))
        raise OSError("gone")

    monkeypatch.setitem(runs.SOURCES, "test", (failing, ""))
    row = runs.run(store, "test", {"count": 100, "batch": 10})
    assert (row["status"], row["records"], row["errors"]) == ("failed", 20, 1) and json.loads(store.state("test")) == {"seq": 20}


def snapshots(folder, name, ids):
    (folder / "snapshots").mkdir(exist_ok=True)
    nodes = [{"databaseId": i, "nameWithOwner": f"o/{i}", "stargazerCount": i} for i in ids]
    (folder / "snapshots" / f"{name}.json").write_text(json.dumps({"ids": ids, "data": {"nodes": nodes}}))


def test_every_answer_is_kept(spark, tmp_path):
    folder = tmp_path / "landed"
    (folder / "repositories").mkdir(parents=True)
    (folder / "repositories" / "a.json").write_text(json.dumps([{"id": i, "node_id": f"N{i}", "full_name": f"o/{i}"} for i in range(1, 9)]))
    for k in range(4):  # they land for the same run as their repositories, more of them than are asked for at once
        snapshots(folder, f"p{k}", [2 * k + 1, 2 * k + 2])
    store = Catalog(spark, str(tmp_path / "store"))
    options = {"path": str(folder), "detail_batch": 3, "batch_files": 1}
    assert runs.run(store, "github", options)["records"] == 16
    assert store.table("github_repository_snapshots").count() == 8
    assert runs.run(store, "github", options)["records"] == 0 and json.loads(store.state("github"))["details_cursor"] == 0


def test_pages_read_only_folders_beyond_the_cursor(spark, tmp_path):
    store = Catalog(spark, str(tmp_path))
    rows = lambda k, n: spark.range(n).selectExpr("'C' as crawl", f"concat('s{k}-', id) as surt", f"concat('u{k}-', id) as url", "'t' as stamp", "200L as status", "'text/html' as mime", "1L as length", "0L as offset", "'f' as filename")
    for k in range(4):
        store.commit({"commoncrawl_index": rows(k, 50)})
    ctx = runs.Context(spark, store, {}, runs.Options({"page_batch": 30}))
    cursor, urls = 0, []
    for turn in range(7):
        got = collectors.next_pages(ctx, cursor)
        page = got.orderBy("id").collect()
        urls += [r.url for r in page]
        cursor = page[-1].id
        m = store.manifest()
        assert len(m.reaching("commoncrawl_index", "id", cursor)) == 4 - 30 * (turn + 1) // 50 or turn == 6
    assert len(urls) == len(set(urls)) == 200 and [u.split("-")[0] for u in urls] == sorted(u.split("-")[0] for u in urls)
    assert store.manifest().reaching("commoncrawl_index", "id", cursor) == [] and collectors.next_pages(ctx, cursor).count() == 0
    store.compact("commoncrawl_index")
    assert store.table("commoncrawl_index").agg(F.countDistinct("id")).first()[0] == 200 and len(store.manifest().reaching("commoncrawl_index", "id", 1)) == 1


def test_many_files_few_commits(spark, tmp_path):
    landed = tmp_path / "feeds"
    landed.mkdir()
    for k in range(20):
        (landed / f"{k:02}.xml").write_text(f"<rss><channel><title>{k}</title><item><guid>{k}</guid></item></channel></rss>")
    store = Catalog(spark, str(tmp_path / "store"))
    row = runs.run(store, "rss", {"path": str(landed), "batch_files": 1})
    assert (row["status"], row["records"], row["requests"], store.table("_landed_files").count()) == ("completed", 40, 20, 20)
    assert store.manifest().number <= 2 + 16  # its start and end, and batches
