"""Sources over landed files: each reads what it hasn't read yet and says where it came to.

Files that were read are known by path and time (table _landed_files), so a file is read whenever it lands, and again
when it changes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.feeds import feed_errors, feed_heads, feed_items, feed_rows
from tidewell.operators.merge import ORDINAL, with_ordinal
from tidewell.operators.options import stamp_flag
from tidewell.operators.runs import Batch, Context, register
from tidewell.operators.sweeps import contiguous_cursor, file_refs, not_collected, page_targets, refresh_targets, select_files
from tidewell.sources import files, shards, warc

LANDED = "source string, path string, modified timestamp, bytes long"
#: Batches of the files that wait, at most, where `batch_files` would give more; files that are listed at once.
BATCHES, LISTED = 16, 100_000


def listed(ctx: Context, path: str) -> DataFrame:
    """path, modified and bytes of the files of a folder.  Contents aren't read."""
    found = ctx.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def there(ctx: Context, path: str) -> bool:
    at = ctx.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(ctx.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def unread(ctx: Context, source: str, path: str, size: int, named: DataFrame | None = None, most: int | None = None) -> Iterator[tuple[list[str], DataFrame]]:
    """A folder's files that the source hasn't read, in order and in batches, and a batch's rows of _landed_files; at most `most` files.

    A batch has `size` files, or a BATCHES-th of those that wait if that is more: a commit costs the same whatever it holds.
    The folder is listed once for LISTED files, and again after them for what has landed since.  named: a column `name`; other files aren't read.
    """
    while most is None or most > 0:
        seen = ctx.catalog.table("_landed_files").filter(F.col("source") == source)
        new = listed(ctx, path).join(seen, ["path", "modified"], "left_anti")
        if named is not None:
            new = new.join(named, last_part("path") == named["name"], "left_semi")
        rows = new.orderBy("path").limit(LISTED if most is None else min(most, LISTED)).select(F.lit(source).alias("source"), "path", "modified", "bytes").collect()
        if not rows:
            return
        n = max(size, -(-len(rows) // BATCHES))
        for at in range(0, len(rows), n):
            some = rows[at : at + n]
            yield [r.path for r in some], ctx.spark.createDataFrame(some, LANDED)
        most = None if most is None else most - len(rows)


def last_part(c: str) -> Column:
    return F.element_at(F.split(F.col(c), "/"), -1)


def pages_of(ctx: Context, paths: list[str]) -> DataFrame:
    """value (all of a text file) and path."""
    return ctx.spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))


def together(parts: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, parts) if parts else None


@register("test", "synthetic records")
def test_records(ctx: Context) -> Iterator[Batch]:
    """options count and batch (records of a batch)."""
    seq, left = ctx.state.get("seq", 0), ctx.options.whole("count", 1000)
    while left > 0:
        n = ctx.budget.at_most(min(left, ctx.options.whole("batch", 1_000_000)))
        yield Batch({"test_records": files.synthetic(ctx.spark, seq, n).withColumn(ORDINAL, F.col("seq"))}, {"seq": seq + n})
        seq, left = seq + n, left - n


@register("rss", "syndication feeds")
def feeds(ctx: Context) -> Iterator[Batch]:
    """options path (landed feeds), feeds and feeds_file (which of them to read, by file name; all without these), batch_files."""
    named = None
    if "feeds" in ctx.options or "feeds_file" in ctx.options:
        named = files.feed_list(ctx.spark, ctx.options.texts("feeds"), ctx.options.text("feeds_file")).select(last_part("url").alias("name"))
    for paths, landed in unread(ctx, "rss", ctx.options.text("path"), ctx.options.whole("batch_files", 1000), named):
        content = ctx.spark.read.format("binaryFile").load(paths).select(F.col("path").alias("url"), "content")
        parsed = ctx.catalog.stage(feed_rows(content))
        now = F.lit(ctx.started).cast("timestamp")
        heads = feed_heads(parsed).withColumns({"last_status": F.lit(200), "last_fetched_at": now, "updated_at": now})
        yield Batch({"rss_feeds": heads, "rss_items": feed_items(parsed)}, ctx.state, feed_errors(parsed), {"_landed_files": landed})


@register("gdelt", "events and mentions of news, from zipped tables")
def gdelt(ctx: Context) -> Iterator[Batch]:
    """options path (landed zips), list (a file list: its order of files, by name), kinds, max_files, since, until, batch_files.

    What was collected is known by file, so no cursor can skip one.  A file that can't be read, or that the list names and
    that hasn't landed, is an error; the others go on, and it is tried again by the next run.
    """
    found = listed(ctx, ctx.options.text("path")).select(F.col("path").alias("url"), "modified", "bytes")
    refs = file_refs(found).join(found, "url")
    missing = None
    if "list" in ctx.options:
        named = file_refs(files.file_list(ctx.spark, ctx.options.text("list"))).select("name", F.col("url").alias("listed")).distinct()
        named = named.join(refs, "name", "left")
        missing = named.filter("url is null").select(F.lit("not landed").alias("error"), F.concat(F.lit("download "), F.col("listed")).alias("context"))
        refs = named.filter("url is not null").select(*refs.columns)
    kinds = ctx.options.texts("kinds") or ["export", "mentions"]
    since, until = (stamp_flag(ctx.options.text(k)) for k in ("since", "until"))
    last, most = ctx.state.get("last_stamp", ""), ctx.options.whole("max_files")
    if missing is not None:
        yield Batch({}, {"last_stamp": last}, missing)
    taken, tried = 0, None  # the last file of the batch before: a bad one isn't tried twice by a run
    while True:
        n = ctx.options.whole("batch_files", 200)
        n = min(n, most - taken) if most else n
        todo = select_files(not_collected(refs, ctx.catalog.table("gdelt_files")), kinds, "", since, until)
        if tried:
            todo = todo.filter(F.struct("stamp", "kind", "url") > F.struct(*map(F.lit, tried)))
        rows = todo.limit(n).collect() if n else []
        if not rows:
            return
        taken, tried = taken + len(rows), (rows[-1].stamp, rows[-1].kind, rows[-1].url)
        todo = ctx.spark.createDataFrame(rows, todo.schema)
        out, errors, counted = {}, [], []
        for kind, table, parse in (("export", "gdelt_events", files.event_rows), ("mentions", "gdelt_mentions", files.mention_rows)):
            names = [r.url for r in rows if r.kind == kind]
            if names:
                lines = ctx.catalog.stage(files.zip_lines(ctx.spark, names))
                out[table] = parse(lines)
                errors.append(files.line_errors(lines))
                bad = lines.filter("error is not null").select(F.col("source_file").alias("url"))
                of = out[table].groupBy(F.col("source_file").alias("url")).agg(F.count("*").alias("rows"))
                counted.append(todo.filter(F.col("kind") == kind).join(bad, "url", "left_anti").join(of, "url", "left"))
        done = ctx.catalog.stage(together(counted))
        last = max(last, done.agg(F.max("stamp")).first()[0] or "")
        marks = {
            "gdelt_files": done.select("url", "kind", "stamp", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes"),
            "_landed_files": done.select(F.lit("gdelt").alias("source"), F.col("url").alias("path"), "modified", "bytes"),
        }
        yield Batch(out, {"last_stamp": last}, together(errors), marks)


@register("github", "repositories, events and snapshots, from landed API answers")
def github(ctx: Context) -> Iterator[Batch]:
    """options path (folders repositories, events and snapshots of JSON pages), max_pages, event_pages, batch_files, detail_batch, refresh_after (a duration).

    Snapshots answer what detail_targets() asks for: a page of the folder snapshots holds `ids`, as they were asked for, and
    `data`; each valid answer is kept, whenever it lands.  The cursor goes on to the last repository before the first one
    without an answer, and back to 0 when none are left.
    """
    base, state = ctx.options.text("path"), dict(ctx.state)
    have = {n for n in ("repositories", "events", "snapshots") if there(ctx, f"{base}/{n}")}
    if not have:
        raise ValueError(f"nothing has landed in {base}")
    state |= {"repositories_since": state.get("repositories_since", 0), "details_cursor": state.get("details_cursor", 0)}
    files_of_batch = ctx.options.whole("batch_files", 1000)
    for name, cap, table, parse, schema in (("repositories", "max_pages", "github_repositories", files.repository_rows, files.REPOSITORY), ("events", "event_pages", "github_events", files.host_event_rows, files.EVENT)):
        for paths, landed in unread(ctx, "github", f"{base}/{name}", files_of_batch, most=ctx.options.whole(cap) or None) if name in have else ():
            pages = pages_of(ctx, paths)
            rows = ctx.catalog.stage(parse(pages))
            if name == "repositories":
                state["repositories_since"] = max(state["repositories_since"], rows.agg(F.max("id")).first()[0] or 0)
            yield Batch({table: rows}, dict(state), files.page_errors(pages, files.array_of(schema)), {"_landed_files": landed})
    none_left = "snapshots" in have and detail_targets(ctx, state["details_cursor"]).isEmpty()
    for paths, landed in unread(ctx, "github", f"{base}/snapshots", files_of_batch) if "snapshots" in have else ():
        pages = pages_of(ctx, paths)
        answers = pages.select(F.from_json("value", "ids array<long>")["ids"].alias("ids"), "value")
        known = ctx.catalog.table("github_repositories").select(F.col("id").alias("repository_id"))
        rows = files.snapshot_rows(answers, F.lit(ctx.started).cast("timestamp")).join(known, "repository_id", "left_semi")
        asked = answers.filter("ids is not null").select(F.explode("ids").alias("id")).distinct().withColumn("answered", F.lit(True))
        cursor = state["details_cursor"]
        seen = ctx.catalog.stage(detail_targets(ctx, cursor).select("id").join(asked, "id", "left"))
        state["details_cursor"] = max(cursor, contiguous_cursor(seen, "id", F.col("answered").isNull(), cursor).first()[0])
        yield Batch({"github_repository_snapshots": rows}, dict(state), files.page_errors(pages, "ids array<long>"), {"_landed_files": landed})
    if none_left:
        state["details_cursor"] = 0
    yield Batch({}, state)


def detail_targets(ctx: Context, after: int) -> DataFrame:
    """id and node_id of the repositories whose snapshots are asked for next."""
    known = ctx.catalog.table("github_repositories").filter("node_id <> ''").select("id", "node_id")
    cutoff = F.lit(ctx.started).cast("timestamp") - F.make_dt_interval(secs=F.lit(ctx.options.seconds("refresh_after", 7 * 86400.0)))
    return refresh_targets(known, ctx.catalog.table("github_repository_snapshots"), "id", "repository_id", "observed_at", cutoff, after, ctx.options.whole("detail_batch", 1000))


@register("commoncrawl", "crawl index shards and pages")
def commoncrawl(ctx: Context) -> Iterator[Batch]:
    """options crawl (or latest), crawls (landed list), index (landed shards), max_shards, batch_bytes, range_bytes, warc (base of archives; pages of index rows without one), page_mime, page_batch, store_text, text_limit, collect_links.

    A shard is read once, by name; a run goes on from inside of one, at the byte that `open` in the state has.  Pages go on from a
    cursor: up to the last one before the first that failed, and from the start again when none are left.
    """
    state, crawl = dict(ctx.state), ctx.options.text("crawl")
    if "crawls" in ctx.options:
        crawls = files.read_crawls(ctx.spark, ctx.options.text("crawls"))
        if crawl.lower() in ("", "latest"):
            newest = crawls.filter("at = 0").first()
            if newest is None:
                raise ValueError("the list of crawls is empty")
            crawl = newest.id
            yield Batch({"commoncrawl_crawls": crawls.drop("at")}, dict(state))
    if crawl != state.get("crawl", crawl):
        state.pop("shard", None)
        state.pop("open", None)
    state["crawl"] = crawl
    if "index" in ctx.options:
        yield from index_batches(ctx, crawl, state)
    if "warc" in ctx.options:
        yield page_batch(ctx, state)
    yield Batch({}, dict(state))


def index_batches(ctx: Context, crawl: str, state: dict[str, Any]) -> Iterator[Batch]:
    """Shards of a crawl in order of their names, in batches of about batch_bytes compressed bytes, each cut into ranges that tasks read.

    A batch ends anywhere in a shard; `open` says where, and how many lines came before.  A range that doesn't unpack is an error of its
    shard: the lines that could be read are kept, the run ends as failed, and the next one reads the shard again from where the batch began.
    """
    most, size, each = ctx.options.whole("max_shards"), ctx.options.whole("batch_bytes", 1 << 30), ctx.options.whole("range_bytes", shards.RANGE)
    ctx.spark.dataSource.register(shards.Cdx)
    finished = 0
    while not most or finished < most:
        done = ctx.catalog.table("commoncrawl_shards").filter(F.col("crawl") == crawl).select("shard")
        new = listed(ctx, ctx.options.text("index")).withColumn("shard", files.shard_of(F.col("path"))).join(done, "shard", "left_anti")
        found = new.orderBy("shard").limit(min(most - finished, 1000) if most else 1000).collect()
        if not found:
            return
        ranges, began, left = [], {}, size
        for r in found:
            opened = state.get("open", {}) if state.get("open", {}).get("shard") == r.shard else {}
            began[r.path] = opened.get("lines", 0)
            of = shards.cut(r.path, r.bytes, opened.get("byte", 0), each)[: max(-(-left // each), 0)]
            ranges += of
            left -= sum(x[2] - x[1] for x in of)
            if left <= 0:
                break
        lines = ctx.spark.read.format("cdx").option("ranges", json.dumps(ranges)).option("range_bytes", each).load()
        staged = ctx.catalog.stage(with_ordinal(files.cdx_fields(lines, crawl, "path", "error")))
        counts = staged.groupBy("path").agg(F.count(F.when(F.col("error").isNull(), 1)).alias("lines"), F.min("error").alias("error")).collect()
        counted = {r.path: r for r in counts}
        end = {x[0]: x[2] for x in ranges}
        ends, open_shard, failed = [], {}, None
        for r in found:
            if r.path not in end and r.bytes:
                break
            n = began[r.path] + (counted[r.path].lines if r.path in counted else 0)
            at = end.get(r.path, 0)
            if r.path in counted and (failed := counted[r.path].error):
                open_shard = state.get("open", {}) if state.get("open", {}).get("shard") == r.shard else {}
                break
            if at < r.bytes:
                open_shard = {"shard": r.shard, "byte": at, "lines": n}
                break
            ends.append((crawl, r.shard, n, r.bytes, r.path, r.modified))
        state |= {"shard": max([state.get("shard", ""), *(e[1] for e in ends)])} if ends else {}
        state.pop("open", None)
        if open_shard:
            state["open"] = open_shard
        rows = ctx.spark.createDataFrame(ends, "crawl string, shard string, lines long, bytes long, path string, modified timestamp")
        marks = {"commoncrawl_shards": rows.select("crawl", "shard", "lines", F.lit(0).alias("bytes"), F.lit(ctx.started).cast("timestamp").alias("completed_at")), "_landed_files": rows.select(F.lit("commoncrawl").alias("source"), "path", "modified", "bytes")}
        errors = staged.filter("error is not null").select("error", F.concat(F.lit("ingest "), F.col("path")).alias("context"))
        yield Batch({"commoncrawl_index": staged.filter("good").drop("good", "path", "error")}, dict(state), errors, marks, frozenset({"commoncrawl_index"}))
        if failed:
            raise ValueError(f"a shard can't be read: {failed}")
        finished += len(ends)


def page_batch(ctx: Context, state: dict[str, Any]) -> Batch:
    """Pages of the next page_batch index rows that have none."""
    cursor = state.get("pages_cursor", 0)
    targets = next_pages(ctx, cursor)
    pages = warc.page_rows(warc.fetch_records(targets.withColumnRenamed("id", "index_id"), ctx.options.text("warc")), ctx.options.flag("store_text"), ctx.options.whole("text_limit", 4096), ctx.options.flag("collect_links", True))
    pages = ctx.catalog.stage(pages)
    errors = pages.filter("error is not null").select("error", F.concat(F.lit("warc "), F.col("url")).alias("context"))
    state["pages_cursor"] = 0 if pages.isEmpty() else contiguous_cursor(pages, "index_id", F.col("error").isNotNull(), cursor).first()[0]
    return Batch({"commoncrawl_pages": pages.filter("error is null").drop("error")}, dict(state), errors)


def next_pages(ctx: Context, cursor: int) -> DataFrame:
    """The next page_batch targets after a cursor, written once.

    Ids rise from commit to commit, so the index is read folder by folder from the cursor on, until one has enough; of the
    pages only folders that reach beyond the cursor are looked at.
    """
    mime, most = ctx.options.text("page_mime", "text/html"), ctx.options.whole("page_batch", 500)
    m = ctx.catalog.manifest()
    pages = ctx.catalog.folders("commoncrawl_pages", m.reaching("commoncrawl_pages", "index_id", cursor)).filter(F.col("index_id") > cursor)
    found, n = [], 0
    for folder in m.reaching("commoncrawl_index", "id", cursor):
        some = ctx.catalog.stage(page_targets(ctx.catalog.folders("commoncrawl_index", [folder]), pages, mime, cursor, most - n))
        found.append(some)
        n += some.count()
        if n >= most:
            break
    return together(found) if found else page_targets(ctx.catalog.table("commoncrawl_index"), pages, mime, cursor, most)
