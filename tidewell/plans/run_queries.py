"""Queries that run sources and streams in pieces: budgets, interrupts, shards read from inside, streams drained twice, the command line."""

from __future__ import annotations

import contextlib
import io
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.catalog import Catalog
from tidewell.operators.export import json_lines
from tidewell.operators.runs import SOURCES, Batch, Context, run
from tidewell.plans.queries import SEEN, query, store_of, t
from tidewell.plans.source_queries import facts, gzipped, land, numbered
from tidewell.sources import files, shards
from tidewell.streaming.incremental import landed_parquet, merge_stream


def named(rows: DataFrame, kind: str, name: str, value: str = "cast(null as string)") -> DataFrame:
    return rows.selectExpr(f"'{kind}' as kind", f"cast({name} as string) as name", f"{value} as value")


@contextlib.contextmanager
def interrupted(source: str, after: int) -> Iterator[None]:
    """The source is interrupted once it has been asked for so many batches and one more."""
    collect, about = SOURCES[source]

    def stopping(ctx: Context) -> Iterator[Batch]:
        for i, batch in enumerate(collect(ctx)):
            if i == after:
                raise KeyboardInterrupt
            yield batch

    SOURCES[source] = (stopping, about)
    try:
        yield
    finally:
        SOURCES[source] = (collect, about)


# --- budgets and batches --------------------------------------------------------------------------------------------------------


@query("""
SELECT 'item' AS kind, n_nationkey::VARCHAR AS name, NULL::VARCHAR AS value FROM nation
UNION ALL SELECT 'record', unnest(range((SELECT count(*) FROM events)))::VARCHAR, NULL
UNION ALL SELECT 'repository', (s_suppkey + 1)::VARCHAR, NULL FROM supplier
UNION ALL VALUES ('rss', '1', '7 rows, 0 read'), ('rss', '2', '7 rows, 0 read'), ('rss', '3', '7 rows, 0 read'), ('rss', '4', '7 rows, 0 read'), ('rss', '6', '0 rows, 5 read')
UNION ALL SELECT 'rss', '5', count(*) - 23 + 5 || ' rows, 5 read' FROM nation
UNION ALL SELECT 'test', k, n // 3 || ' rows, 0 duplicates' FROM (SELECT count(*) AS n FROM events), (VALUES ('1'), ('2')) v(k) UNION ALL SELECT 'test', '3', count(*) - 2 * (count(*) // 3) || ' rows, 0 duplicates' FROM events
UNION ALL SELECT 'github', '1', count(*) // 2 || ' rows' FROM supplier UNION ALL SELECT 'github', '2', count(*) - count(*) // 2 || ' rows' FROM supplier
""")
def budget_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that a budget stops in the middle of a batch: the next ones go on, and in the end all rows are there, none of them read for nothing."""
    store = store_of(spark)
    nation = t(spark, sf_dir, "nation")
    item = F.concat(F.lit("<item><guid>"), "n_nationkey", F.lit("</guid></item>"))
    feed = nation.groupBy("n_regionkey").agg(F.concat(F.lit("<rss version='2.0'><channel><title>r</title>"), F.array_join(F.sort_array(F.collect_list(item)), ""), F.lit("</channel></rss>")).alias("data"))
    land(feed.select(F.concat(F.lit("feeds/"), "n_regionkey", F.lit(".xml")).alias("name"), F.lit(0).alias("at"), "data"), f"{store.base}/landed")
    out = []
    for k in range(1, 7):
        row = run(store, "rss", {"path": f"{store.base}/landed/feeds"}, max_records=7)
        out.append(("rss", k, f"{row['records']} rows, {store.table('_landed_files').count()} read"))
    n = t(spark, sf_dir, "events").count()
    for k, most in ((1, n // 3), (2, n // 3), (3, 0)):
        row = run(store, "test", {"count": n if most else n - 2 * (n // 3), "batch": n // 5 + 1}, max_records=most)
        out.append(("test", k, f"{row['records']} rows, {row['duplicates']} duplicates"))
    supplier = t(spark, sf_dir, "supplier").select("s_suppkey")
    half = supplier.count() // 2
    repositories(numbered(supplier, "s_suppkey", 40), f"{store.base}/landed")
    for k, most in ((1, half), (2, 0)):
        out.append(("github", k, f"{run(store, 'github', {'path': f'{store.base}/landed'}, max_records=most)['records']} rows"))
    parts = [named(store.table("rss_items"), "item", "guid"), named(store.table("test_records"), "record", "seq"), named(store.table("github_repositories"), "repository", "id")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(facts(spark, out))


def repositories(rows: DataFrame, folder: str) -> None:
    """Pages of repositories of rows (chunk, pos, s_suppkey), one for each chunk."""
    repo = F.struct(F.col("s_suppkey").alias("at"), (F.col("s_suppkey") + 1).alias("id"), F.concat(F.lit("N"), "s_suppkey").alias("node_id"), F.concat(F.lit("o/"), "s_suppkey").alias("full_name"))
    of = rows.groupBy("chunk").agg(F.to_json(F.array_sort(F.collect_list(repo))).alias("data"))
    land(of.select(F.format_string("repositories/%06d.json", "chunk").alias("name"), F.lit(0).alias("at"), "data"), folder)


@query("""
SELECT 'snapshot' AS kind, (s_suppkey + 1)::VARCHAR AS name, ((s_suppkey + 1) * 2)::VARCHAR AS value FROM supplier
UNION ALL SELECT 'run', '1', 'completed, ' || 2 * count(*) || ' rows' FROM supplier
UNION ALL VALUES ('run', '2', 'completed, 0 rows'), ('cursor', '2', '0'), ('late', '3', '1 rows')
""")
def snapshots_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that land for the same run as their repositories, more of them than are asked for at once, pages of nine in batches of two; one is answered again when it is stale."""
    store = store_of(spark)
    supplier = t(spark, sf_dir, "supplier").select("s_suppkey")
    repositories(numbered(supplier, "s_suppkey", 40), f"{store.base}/landed")
    node = F.struct(F.col("s_suppkey").alias("at"), (F.col("s_suppkey") + 1).alias("databaseId"), F.concat(F.lit("o/"), "s_suppkey").alias("nameWithOwner"), ((F.col("s_suppkey") + 1) * 2).alias("stargazerCount"))
    of = numbered(supplier, "s_suppkey", 9).groupBy("chunk").agg(F.array_sort(F.collect_list(node)).alias("n"))
    value = F.to_json(F.struct(F.col("n.databaseId").alias("ids"), F.struct(F.col("n").alias("nodes")).alias("data"))).alias("data")
    land(of.select(F.format_string("snapshots/%06d.json", "chunk").alias("name"), F.lit(0).alias("at"), value), f"{store.base}/landed")
    given = {"path": f"{store.base}/landed", "detail_batch": 7, "batch_files": 2}
    out = []
    for k in (1, 2):
        row = run(store, "github", given)
        out.append(("run", k, f"{row['status']}, {row['records']} rows"))
    out.append(("cursor", 2, json.loads(store.state("github"))["details_cursor"]))
    before = store.table("github_repository_snapshots").count()
    land(of.filter("chunk = 0").select(F.lit("snapshots/late.json").alias("name"), F.lit(0).alias("at"), F.to_json(F.struct(F.slice("n.databaseId", 1, 1).alias("ids"), F.struct(F.slice("n", 1, 1).alias("nodes")).alias("data"))).alias("data")), f"{store.base}/landed")
    run(store, "github", given)
    out.append(("late", 3, f"{store.table('github_repository_snapshots').count() - before} rows"))
    once = store.table("github_repository_snapshots").select("repository_id", "stars").distinct()
    return named(once, "snapshot", "repository_id", "cast(stars as string)").unionByName(facts(spark, out))


@query("""
SELECT 'run' AS kind, k::VARCHAR AS name, least(40, greatest(count(*) - 40 * (k - 1), 0)) || ' repositories, ' || least(25, greatest(25 - 10 * (k - 1), 0), 10) || ' events' AS value FROM supplier, (SELECT unnest(range(1, 5)) AS k) GROUP BY k
""")
def page_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """max_pages and event_pages: a page of 40 repositories and two of five events a run, in order."""
    store = store_of(spark)
    repositories(numbered(t(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", 40), f"{store.base}/landed")
    event = numbered(t(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey", 5).select("chunk", "pos", F.struct(F.concat(F.lit("e"), "n_nationkey").alias("id"), F.lit("Push").alias("type")).alias("e"))
    land(event.groupBy("chunk").agg(F.to_json(F.collect_list("e")).alias("data")).select(F.format_string("events/%06d.json", "chunk").alias("name"), F.lit(0).alias("at"), "data"), f"{store.base}/landed")
    out, had = [], (0, 0)
    for k in range(1, 5):
        run(store, "github", {"path": f"{store.base}/landed", "max_pages": 1, "event_pages": 2})
        have = (store.table("github_repositories").count(), store.table("github_events").count())
        out.append(("run", k, f"{have[0] - had[0]} repositories, {have[1] - had[1]} events"))
        had = have
    return facts(spark, out)


# --- index shards -----------------------------------------------------------------------------------------------------------------


def index_shards(orders: DataFrame, folder: str) -> None:
    """Three shards of a crawl index with a line for each order, in gzip members of up to 20."""

    def line(key: Column) -> Column:
        return F.concat(F.format_string("org,example)/%012d 20260202154500 ", key), F.lit('{"url":"http://example.org/'), key, F.lit('","mime":"text/html","status":"200"}\n'))

    rows = orders.select((F.col("o_orderkey") % 3).alias("shard"), F.floor(F.col("o_orderkey") / 60).alias("block"), "o_orderkey")
    member = rows.groupBy("shard", "block").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))  # keys are shuffled, lines are made after
    member = member.select("shard", "block", F.array_join(F.transform("keys", line), "").alias("text"))
    land(member.select(files.shard_name(F.col("shard")).alias("name"), F.col("block").alias("at"), gzipped(F.encode("text", "UTF-8")).alias("data")), folder)


@query("""
SELECT 'row' AS kind, o_orderkey::VARCHAR AS name, NULL::VARCHAR AS value FROM orders
UNION ALL SELECT 'shard', 'cdx-0000' || o_orderkey % 3, count(*)::VARCHAR FROM orders GROUP BY o_orderkey % 3
UNION ALL VALUES ('run', '1', 'cancelled'), ('stored', '1', 'some rows, all of them counted'), ('cursor', '1', 'inside a shard'), ('run', '2', 'completed, no duplicates'), ('run', '3', 'completed, no rows'), ('tasks', 'of a shard', '4 or more')
""")
def shard_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of three shards in batches of a quarter of its bytes: interrupted after the second, gone on with from inside a shard, each line once."""
    store = store_of(spark)
    folder = f"{store.base}/landed/index"
    index_shards(t(spark, sf_dir, "orders"), folder)
    sizes = {r.path: r.length for r in spark.read.format("binaryFile").load(folder).select("path", "length").collect()}
    total = sum(sizes.values())
    given = {"crawl": "C", "index": folder, "batch_bytes": total // 4, "range_bytes": total // 40 + 1}
    with interrupted("commoncrawl", 2):
        row = run(store, "commoncrawl", given)
    n, m = store.table("commoncrawl_index").count(), store.table("commoncrawl_shards").count()
    out = [("run", 1, row["status"]), ("stored", 1, "some rows, all of them counted" if 0 < n == row["records"] - m else f"{n} of {row['records']}")]
    out.append(("cursor", 1, "inside a shard" if json.loads(store.state("commoncrawl")).get("open", {}).get("byte", 0) > 0 else "between shards"))
    for k in (2, 3):
        row = run(store, "commoncrawl", given)
        out.append(("run", k, f"{row['status']}, {'no duplicates' if k == 2 and not row['duplicates'] else 'no rows' if not row['records'] else 'some'}"))
    path, size = max(sizes.items(), key=lambda x: x[1])
    tasks = spark.read.format("cdx").option("path", path).option("range_bytes", size // 6).load().groupBy(F.spark_partition_id()).count().count()
    out.append(("tasks", "of a shard", "4 or more" if tasks >= 4 else tasks))
    rows = named(store.table("commoncrawl_index"), "row", "regexp_extract(url, '([0-9]+)$', 1)")
    done = named(store.table("commoncrawl_shards"), "shard", "shard", "cast(lines as string)")
    return rows.unionByName(done).unionByName(facts(spark, out))


@query("""
SELECT 'row' AS kind, o_orderkey::VARCHAR AS name, (CASE WHEN o_orderkey % 3 < 2 THEN 1 ELSE 2 END)::VARCHAR AS value FROM orders
UNION ALL SELECT 'drain', '1', count(*)::VARCHAR FROM orders WHERE o_orderkey % 3 < 2 UNION ALL SELECT 'drain', '2', count(*)::VARCHAR FROM orders UNION ALL SELECT 'drain', '3', count(*)::VARCHAR FROM orders
""")
def stream_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of shards through the data source, drained when two have landed, when the third has, and once more: no row twice, with the drain that stored it."""
    store = store_of(spark)
    folder = f"{store.base}/landed"
    orders = t(spark, sf_dir, "orders").select("o_orderkey")
    spark.dataSource.register(shards.Cdx)
    out = []
    for k in (1, 2, 3):
        if k < 3:
            index_shards(orders.filter((F.col("o_orderkey") % 3 == 2) == (k == 2)), folder)
        lines = spark.readStream.format("cdx").option("path", folder).option("range_bytes", 1 << 16).load()
        rows = files.cdx_rows(lines.filter("error is null"), "C").withColumn("run_id", F.lit(k))
        merge_stream(rows, store, "commoncrawl_index", f"{store.base}/checkpoint", "cdx").awaitTermination()
        out.append(("drain", k, store.table("commoncrawl_index").count()))
    return named(store.table("commoncrawl_index"), "row", "regexp_extract(url, '([0-9]+)$', 1)", "cast(run_id as string)").unionByName(facts(spark, out))


@query("SELECT 'pair' AS kind, user_id::VARCHAR AS name, event_type AS value FROM (SELECT DISTINCT user_id, event_type FROM events) UNION ALL VALUES ('batches', 'of two files', '4 or more')")
def paced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that goes on at a pace, two files a batch at most, until what has landed is in the table; then it is stopped."""
    store = store_of(spark, SEEN)
    events = t(spark, sf_dir, "events").select("user_id", "event_type")
    events.repartition(8, F.hash("user_id", "event_type")).write.parquet(f"{store.base}/landed")
    query_ = merge_stream(landed_parquet(spark, f"{store.base}/landed", "user_id long, event_type string", files=2), store, "seen", f"{store.base}/checkpoint", "paced", seconds=1)
    try:
        query_.processAllAvailable()
    finally:
        query_.stop()
    batches = store.manifest().batches["paced"] + 1
    return named(store.table("seen"), "pair", "user_id", "event_type").unionByName(facts(spark, [("batches", "of two files", "4 or more" if batches >= 4 else batches)]))


# --- the command line ----------------------------------------------------------------------------------------------------------------


def command(store: Catalog, *args: str) -> tuple[int, str]:
    """Exit code of a command and what it printed."""
    from tidewell.__main__ import main

    said = io.StringIO()
    with contextlib.redirect_stdout(said), contextlib.redirect_stderr(io.StringIO()):
        return main(["--store", store.base, *args]), said.getvalue()


@query("""
WITH c(k, line) AS (VALUES (0, '0 version'), (1, '2 run nothing'), (2, '2 run test --since soon'), (3, '1 run rss'), (4, '0 run test'), (5, '2 export --table none'), (6, '2 export --query select nothing'), (7, '0 export --query select count(*) as n from test_records'), (8, '130 run test rss'))
SELECT n_nationkey, line FROM nation JOIN c ON n_nationkey % 9 = k
""")
def exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What commands return, each for the nations of a remainder: 0, 1 for a failed source, 2 for what can't be asked, 130 after an interrupt."""
    store = store_of(spark)
    out = []
    for k, args in enumerate((["version"], ["run", "nothing"], ["run", "test", "--since", "soon"], ["run", "rss"], ["run", "test"], ["export", "--table", "none"], ["export", "--query", "select nothing"], ["export", "--query", "select count(*) as n from test_records"], ["run", "test", "rss"])):
        with interrupted("test", 0) if k == 8 else contextlib.nullcontext():
            out.append((k, f"{command(store, *args)[0]} {' '.join(args)}"))
    codes = spark.createDataFrame(out, "k long, line string")
    return t(spark, sf_dir, "nation").join(F.broadcast(codes), F.col("n_nationkey") % 9 == F.col("k")).select("n_nationkey", "line")


@query("""
WITH c AS (SELECT count(*) AS n FROM customer)
SELECT * FROM (VALUES ('1 run', 1, 0), ('2 run', 1, 0), ('3 run --no-resume', 0, 1), ('4 run', 0, 1), ('5 run --reset', 0, 1), ('6 run --no-resume --max-records', 0, 1), ('7 run', 0, 1), ('8 run', 1, 0)) v(command, rows, duplicates)
""".replace("SELECT * FROM", "SELECT command, rows * n AS rows, duplicates * n AS duplicates FROM c,"))
def resume_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of as many records as there are customers: resumed, from the start without their state, and from the start for good; what is there already is a duplicate."""
    store, n = store_of(spark), t(spark, sf_dir, "customer").count()
    out = []
    for k, flags in enumerate(([], [], ["--no-resume"], [], ["--reset"], ["--no-resume", "--max-records", str(n)], [], []), 1):
        if "--reset" in flags:
            store.clear_state("test")
        most = n if "--max-records" in flags else 0
        row = run(store, "test", {"count": n}, most, "--no-resume" not in flags)
        out.append((" ".join([f"{k} run", *(f for f in flags if not f.isdigit())]), row["records"], row["duplicates"]))
    return spark.createDataFrame(out, "command string, rows long, duplicates long")


@query("""
SELECT '{"p_partkey":' || p_partkey || ',"j":{"name":"' || p_brand || '","sizes":[' || p_size || ',null]},"kept":"[1, 2]"}' AS value FROM part
UNION ALL SELECT 'not JSON: ' || count(*) FROM part WHERE p_partkey % 5 = 0
""")
def json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named as JSON are values in the lines, others stay text; a text that isn't JSON ends a strict export and stays text in one that only looks for JSON."""
    part = t(spark, sf_dir, "part")
    j = F.format_string('{"name": "%s", "sizes": [%d, null]}', "p_brand", "p_size")
    good = json_lines(part.select("p_partkey", j.alias("j"), F.lit("[1, 2]").alias("kept")), ["j"])
    bad = part.select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit("{broken")).otherwise(j).alias("j"))
    kept = json_lines(bad, detect_json=True).filter(F.col("value").contains('"{broken"')).count()
    try:
        json_lines(bad, ["j"]).write.format("noop").mode("overwrite").save()
        said = "no error"
    except Exception as e:
        said = f"not JSON: {kept}" if "not JSON" in str(e) else str(e)
    return good.unionByName(spark.createDataFrame([(said,)], "value string"))
