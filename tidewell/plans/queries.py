"""Queries over the driver's tables that apply the library's operators, each with the SQL it should agree with.

A query's SQL is None where SQL can't express it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import feeds, scalars
from tidewell.functions.html import extract_html
from tidewell.operators import merge, sweeps
from tidewell.operators.catalog import Catalog
from tidewell.operators.export import export_rows, json_lines
from tidewell.operators.runs import run
from tidewell.plans.schemas import TABLES, Table
from tidewell.plans.shared import shared_dir
from tidewell.sources import collectors, files, warc
from tidewell.streaming.incremental import landed_parquet, merge_stream

assert collectors  # registers the sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
#: Tables that delegated SQL may name.
NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only_amp(html: str) -> Column:
    """html in which `&amp;` is the only character reference, as the SQL of queries on pages has it: any other & is escaped, so parsers keep it as it stands."""
    return F.regexp_replace(html, "&(?!amp;)", "&amp;")


# --- merges -----------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, source, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1 OR text IS NULL")
def insert_ignore_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = t(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.sha2("text", 256).alias("key"), F.col("doc_id").alias(merge.ORDINAL))
    return merge.insert_ignore(None, batch, [["key"]]).appended.drop("key")


@query("""
SELECT doc_id, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
  WHERE doc_id % 2 = 1 AND (text IS NULL OR text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL)))
WHERE rn = 1 OR text IS NULL
""")
def insert_ignore_against_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("key"), F.col("doc_id").alias(merge.ORDINAL))
    return merge.insert_ignore(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), [["key"]]).appended.drop("key")


@query("SELECT p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1")
def insert_ignore_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = t(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_partkey").alias(merge.ORDINAL))
    return merge.insert_ignore(None, batch, [["p_partkey"], ["p_name"]]).appended


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def insert_replace_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias(merge.ORDINAL))
    return merge.insert_replace(None, batch, [["user_id"]]).appended


@query("SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN 'changed' ELSE c_mktsegment END AS segment FROM customer")
def insert_replace_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), "c_nationkey")
    batch = rows.filter("c_nationkey = 5").withColumn("segment", F.lit("changed"))
    out = merge.insert_replace(rows.drop("c_nationkey"), batch.drop("c_nationkey"), [["c_custkey"]])
    return out.kept.unionByName(out.appended)


@query("SELECT r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT n_nationkey + 1000, n_name FROM nation")
def insert_fail_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    batch = t(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1000).alias("id"), F.col("n_name").alias("name"))
    out = merge.insert_fail(target, batch, [["id"]])
    return out.kept.unionByName(out.appended)


@query("""
SELECT c_custkey, o_orderkey, k FROM (
  SELECT c_custkey, o_orderkey, o_orderkey % 100 AS k, row_number() OVER (PARTITION BY o_orderkey % 100 ORDER BY c_custkey, o_orderkey) AS rn
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey)
WHERE rn = 1 OR k IS NULL
""")
def ignore_null_keys_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    batch = rows.select("c_custkey", "o_orderkey", (F.col("o_orderkey") % 100).alias("k"), F.struct("c_custkey", "o_orderkey").alias(merge.ORDINAL))
    return merge.insert_ignore(None, batch, [["k"]]).appended


@query("SELECT count(*) AS fetched, count(DISTINCT text) AS inserted, count(*) - count(DISTINCT text) AS duplicates FROM documents WHERE text IS NOT NULL")
def duplicate_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = t(spark, sf_dir, "documents").filter("text is not null").select(F.sha2("text", 256).alias("key"))
    return merge.accounting(batch, merge.insert_ignore(None, batch, [["key"]]).appended)


# --- targets, budgets and cursors -------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 10 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) ORDER BY o_orderkey LIMIT 100")
def anti_join_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return sweeps.keyset_page(todo.select("o_orderkey", "o_custkey"), "o_orderkey", 10, 100)


@query("""
SELECT page_id AS id, url FROM pages
WHERE page_id % 5 <> 0 AND page_id % 3 <> 0 AND page_id % 4 <> 0 AND page_id % 7 <> 0 AND page_id > 3 ORDER BY page_id LIMIT 256
""")
def index_page_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    index = t(spark, sf_dir, "pages").select(
        i.alias("id"), "url", F.when(i % 5 == 0, 404).otherwise(200).alias("status"), F.when(i % 3 == 0, "image/png").when(i % 3 == 1, "TEXT/html").otherwise("text/html; x").alias("mime"),
        F.when(i % 7 != 0, F.lit("a.warc.gz")).alias("filename"), F.lit(10).alias("length"), F.lit(0).alias("offset"),
    )
    done = t(spark, sf_dir, "pages").filter("page_id % 4 = 0").select(i.alias("index_id"))
    return sweeps.page_targets(index, done, after=3).select("id", "url")


@query("SELECT c_custkey FROM customer WHERE c_custkey > 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate > TIMESTAMP '2001-01-01') ORDER BY c_custkey LIMIT 1000")
def anti_join_refresh_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = F.lit("2001-01-01").cast("timestamp_ntz")
    return sweeps.refresh_targets(t(spark, sf_dir, "customer").select("c_custkey"), t(spark, sf_dir, "orders"), "c_custkey", "o_custkey", "o_orderdate", cutoff)


@query("""
SELECT e.event_type AS source, e.event_id AS id, e.user_id, coalesce(s.state, '') AS state
FROM events e JOIN (SELECT event_type, max(event_id) AS id FROM events GROUP BY event_type) m ON e.event_type = m.event_type AND e.event_id = m.id
LEFT JOIN (SELECT event_type, 'seen ' || count(*) AS state FROM events WHERE event_type < 'p' GROUP BY event_type) s ON s.event_type = e.event_type
""")
def latest_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = t(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("id"), "user_id")
    states = runs.filter("source < 'p'").groupBy("source").agg(F.concat(F.lit("seen "), F.count("*").cast("string")).alias("state"))
    return sweeps.latest_runs(runs, states)


def _landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, ".export.CSV").when(F.col("event_id") % 3 == 1, ".MENTIONS.csv").otherwise(".other")
    url = F.concat(F.lit("http://host/"), F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyyMMddHHmmss"), kind, F.lit(".zip"))
    return t(spark, sf_dir, "events").select("event_id", url.alias("url"))


_FILES = """
WITH f AS (
  SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, CASE event_id % 3 WHEN 0 THEN 'export' WHEN 1 THEN 'mentions' ELSE '' END AS kind,
    strftime(ts, '%Y%m%d%H%M%S') || CASE event_id % 3 WHEN 0 THEN '.export.CSV' WHEN 1 THEN '.MENTIONS.csv' ELSE '.other' END || '.zip' AS name,
    'http://host/' || user_id || '/' AS base FROM events)
"""


@query(_FILES + "SELECT base || name AS url, name, kind, stamp FROM f")
def file_ref_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.file_refs(_landed_files(spark, sf_dir))


@query(_FILES + "SELECT base || name AS url, name, kind, stamp FROM f WHERE kind IN ('export', 'mentions') AND stamp > '20240102000000' AND stamp <= '20240110000000' ORDER BY stamp, kind, url LIMIT 500")
def ordered_file_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = sweeps.file_refs(_landed_files(spark, sf_dir))
    return sweeps.select_files(refs, [" Export", "MENTIONS "], "20240102000000", None, "20240110000000", 500)


@query(_FILES + "SELECT base || name AS url, kind FROM f WHERE base || name NOT IN (SELECT base || name FROM f WHERE event_id % 10 < 4)")
def already_collected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed_files(spark, sf_dir)
    return sweeps.not_collected(sweeps.file_refs(landed), landed.filter("event_id % 10 < 4")).select("url", "kind")


@query("""
SELECT chunk, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS chunk FROM orders) GROUP BY chunk
""")
def chunk_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sweeps.chunks(t(spark, sf_dir, "orders"), "o_orderkey", 100)
    return c.select("chunk", F.size("ids").cast("long").alias("n"), F.array_min("ids").alias("first_id"), F.array_max("ids").alias("last_id"))


@query("SELECT coalesce(max(o_orderkey), 0) AS cursor FROM orders WHERE o_orderkey < (SELECT coalesce(min(o_orderkey), 9223372036854775807) FROM orders WHERE o_totalprice > 450000)")
def contiguous_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.contiguous_cursor(t(spark, sf_dir, "orders"), "o_orderkey", F.col("o_totalprice") > 450000)


@query("SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 250")
def record_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.budget(t(spark, sf_dir, "events"), ["ts", "event_id"], 250).select("event_id", "user_id")


@query("""
SELECT event_type, records, bytes, round(records / 60.0, 6) AS records_s, round(bytes / 60.0 / 1048576.0, 6) AS mb_s
FROM (SELECT event_type, count(*) AS records, sum(length(props))::BIGINT AS bytes FROM events GROUP BY event_type)
""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("records"), F.sum(F.length("props")).alias("bytes"))
    out = sweeps.throughput(runs, F.lit(60.0))
    return out.select("event_type", "records", "bytes", F.round("records_s", 6).alias("records_s"), F.round("mb_s", 6).alias("mb_s"))


# --- normalisers ------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE date_trunc('second', o_orderdate) END AS at FROM orders")
def stamp14_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    broken = F.when(F.col("o_orderkey") % 10 == 3, F.concat(stamp, F.lit("0"))).otherwise(stamp)
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.stamp_time(broken).cast("timestamp_ntz").alias("at"))


_NUMBER = "CASE p_partkey % 6 WHEN 0 THEN ' ' || p_size || ' ' WHEN 1 THEN '+' || p_size WHEN 2 THEN p_size || 'x' WHEN 3 THEN '-' || p_size || '.5' WHEN 4 THEN p_size || 'e3' ELSE '' END"


@query(f"""
SELECT p_partkey, CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN try_cast(trim(x) AS BIGINT) END AS i,
  CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN try_cast(x AS BIGINT) END AS untrimmed,
  CASE WHEN trim(x) LIKE '%x' THEN NULL ELSE try_cast(trim(x) AS DOUBLE) END AS d
FROM (SELECT p_partkey, {_NUMBER} AS x FROM part)
""")
def try_int_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "part").select("p_partkey", F.expr(_NUMBER).alias("x"))
    return rows.select("p_partkey", scalars.int64("x").alias("i"), scalars.int64("x", trim=False).alias("untrimmed"), scalars.float64("x").alias("d"))


_BLANKS = "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN ' ' || p_name ELSE NULL END"


@query(f"""
SELECT p_partkey, nullif(trim(x), '') AS blank, nullif(x, '') AS empty, CASE WHEN trim(x) <> '' THEN x ELSE p_brand END AS non_blank,
  coalesce(nullif(x, ''), p_brand) AS non_empty, (p_partkey % 2 = 0)::INTEGER AS flag, CASE WHEN p_size - 20 >= 0 THEN p_size - 20 END AS size
FROM (SELECT *, {_BLANKS} AS x FROM part)
""")
def blank_and_empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "part").withColumn("x", F.expr(_BLANKS))
    return rows.select(
        "p_partkey", scalars.blank_to_null("x").alias("blank"), scalars.empty_to_null("x").alias("empty"), scalars.first_non_blank("x", "p_brand").alias("non_blank"),
        scalars.first_non_empty("x", "p_brand").alias("non_empty"), scalars.bool_int(F.col("p_partkey") % 2 == 0).alias("flag"), scalars.at_least_zero(F.col("p_size") - 20).alias("size"),
    )


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(r"""
SELECT doc_id, coalesce(sum(strlen(w) + 1), 0)::BIGINT AS text_length
FROM (SELECT doc_id, unnest(CASE WHEN coalesce(text, '') = '' THEN [''] ELSE string_split_regex(text, '[\s\x0B\x{85}\x{A0}\p{Z}]+') END) AS w FROM documents) WHERE w <> '' GROUP BY doc_id
""")
def text_byte_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").filter(F.col("text").rlike(r"(?U)\S")).select("doc_id", scalars.words_length("text").alias("text_length"))


@query("SELECT seq, 'synthetic record ' || seq AS payload, sha256('synthetic record ' || seq) AS hash FROM (SELECT unnest(range(50, 50 + (SELECT count(*) FROM events))) AS seq)")
def sha256_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many records as there are events."""
    return files.synthetic(spark, 50, t(spark, sf_dir, "events").count())


@query("SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS topics FROM part GROUP BY p_brand")
def array_join_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.struct(F.struct(F.col("p_type").alias("name")).alias("topic"))
    return t(spark, sf_dir, "part").groupBy("p_brand").agg(scalars.topic_names(F.sort_array(F.collect_set(node))).alias("topics"))


@query("""
SELECT o_orderkey, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0) ELSE printf('%.1f MB', n / 1048576.0) END AS size,
  printf('%02d:%02d:%02d', n // 3600, n // 60 % 60, n % 60) AS clock, format('{:,}', n) AS thousands
FROM (SELECT o_orderkey, (o_orderkey * 37) AS n FROM orders)
""")
def display_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") * 37
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.byte_size(n).alias("size"), scalars.clock(n).alias("clock"), scalars.thousands(n).alias("thousands"))


@query("SELECT o_orderkey, date_trunc('second', o_orderdate) AS rfc1123, date_trunc('second', o_orderdate) AS rfc3339, date_trunc('day', o_orderdate) AS day, NULL::TIMESTAMP AS junk FROM orders")
def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate")
    text = {
        "rfc1123": F.concat(F.lit("Mon, "), F.date_format(at, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000")), "rfc3339": F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        "day": F.date_format(at, "yyyy-MM-dd"), "junk": F.lit("soon"),
    }
    return t(spark, sf_dir, "orders").select("o_orderkey", *(scalars.parse_time(x).cast("timestamp_ntz").alias(n) for n, x in text.items()))


@query(r"""
SELECT url, trim(regexp_replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '&amp;', '&'), '\s+', ' ', 'g')) AS title,
  nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS language, len(regexp_extract_all(html, '<a href="[^"#]'))::INTEGER AS link_count
FROM pages
""")
def html_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = t(spark, sf_dir, "pages").select("url", extract_html(only_amp("html"), "url").alias("d"))
    return doc.select("url", F.col("d.title").alias("title"), scalars.empty_to_null("d.language").alias("language"), F.size("d.links").alias("link_count"))


# --- readers ----------------------------------------------------------------------------------------------------------


def _crawl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id").cast("string")
    meta = F.to_json(F.struct("url", F.lit("text/html").alias("mime"), F.lit("200").alias("status"), i.alias("length"), i.alias("offset"), F.lit("f.gz").alias("filename")))
    blob = F.when(F.col("page_id") % 9 == 0, F.lit("no json")).otherwise(meta)
    return t(spark, sf_dir, "pages").select(F.concat_ws(" ", F.concat(F.lit("com,x)/"), i), F.lit("20260202154500"), blob).alias("value"))


@query("""
SELECT 'C' AS crawl, 'com,x)/' || page_id AS surt, url, '20260202154500' AS stamp, TIMESTAMP '2026-02-02 15:45:00' AS fetched_at, 200::BIGINT AS status,
  'text/html' AS mime, page_id AS length, page_id AS "offset", 'f.gz' AS filename
FROM pages WHERE page_id % 9 <> 0
""")
def cdx_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.cdx_rows(_crawl_lines(spark, sf_dir), "C")
    return rows.select("crawl", "surt", "url", "stamp", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "status", "mime", "length", "offset", "filename")


def _tab_separated(fields: dict[int, Column], n: int) -> Column:
    return F.concat_ws("\t", *(F.coalesce(fields.get(i, F.lit("")).cast("string"), F.lit("")) for i in range(n)))


@query("""
SELECT event_id AS global_event_id, user_id AS day, NULL::VARCHAR AS actor1_code, event_type AS event_code, value AS goldstein_scale,
  date_trunc('second', ts) AS date_added_at, 'http://h/' || event_id AS source_url, 'f.zip' AS source_file
FROM events WHERE event_id % 11 <> 0
""")
def tsv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    cols = {0: e, 1: F.col("user_id"), 5: F.lit("  "), 26: F.col("event_type"), 30: F.col("value"), 59: F.date_format("ts", "yyyyMMddHHmmss"), 60: F.concat(F.lit("http://h/"), e.cast("string"))}
    line = F.when(e % 11 == 0, _tab_separated(cols, 40)).otherwise(_tab_separated(cols, 61))
    rows = files.event_rows(t(spark, sf_dir, "events").select(F.lit("f.zip").alias("source_file"), line.alias("line")))
    return rows.select("global_event_id", "day", "actor1_code", "event_code", "goldstein_scale", F.col("date_added_at").cast("timestamp_ntz").alias("date_added_at"), "source_url", "source_file")


@query("SELECT event_id AS global_event_id, date_trunc('second', ts) AS mention_time_at, event_type AS mention_identifier, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS sentence_id, value AS mention_doc_tone FROM events WHERE event_id % 7 <> 0")
def tsv_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    cols = {0: e, 2: F.date_format("ts", "yyyyMMddHHmmss"), 5: F.when(e % 7 != 0, F.col("event_type")), 6: F.when(e % 5 != 0, F.col("user_id")), 13: F.col("value")}
    rows = files.mention_rows(t(spark, sf_dir, "events").select(F.lit("f.zip").alias("source_file"), _tab_separated(cols, 14).alias("line")))
    return rows.select("global_event_id", F.col("mention_time_at").cast("timestamp_ntz").alias("mention_time_at"), "mention_identifier", "sentence_id", "mention_doc_tone")


@query("SELECT c_custkey AS id, 'n' || c_nationkey || '/' || c_name AS full_name, c_name AS name, 'n' || c_nationkey AS owner, (c_custkey % 2)::INTEGER AS fork FROM customer")
def repository_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    repo = F.struct(F.col("c_custkey").alias("id"), F.concat(owner, F.lit("/"), F.col("c_name")).alias("full_name"), F.col("c_name").alias("name"), F.struct(owner.alias("login")).alias("owner"), (F.col("c_custkey") % 2 == 1).alias("fork"))
    pages = t(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 100)).agg(F.to_json(F.collect_list(repo)).alias("value"))
    return files.repository_rows(pages).select("id", "full_name", "name", "owner", "fork")


@query("SELECT event_id::VARCHAR AS id, event_type AS type, user_id AS actor_id, 1::INTEGER AS public, props AS payload FROM events WHERE event_id % 13 <> 0")
def host_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    event = F.struct(F.when(e % 13 == 0, "").otherwise(e.cast("string")).alias("id"), F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("actor"), F.lit(True).alias("public"), F.col("props").alias("payload"))
    pages = t(spark, sf_dir, "events").groupBy(F.floor(e / 100)).agg(F.to_json(F.collect_list(event)).alias("value"))
    return files.host_event_rows(pages).select("id", "type", "actor_id", "public", "payload")


@query("SELECT s_suppkey + 1 AS repository_id, s_nationkey::BIGINT AS stars, 0::BIGINT AS forks, 'a,b' AS topics, 0::INTEGER AS archived FROM supplier WHERE (s_suppkey + 1) % 5 <> 1")
def snapshot_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") + 1
    topics = F.array(*(F.struct(F.struct(F.lit(x).alias("name")).alias("topic")) for x in "ab"))
    node = F.struct(F.when(k % 2 == 0, k).otherwise(0).alias("databaseId"), F.when(k % 5 == 1, "").otherwise(F.col("s_name")).alias("nameWithOwner"), F.col("s_nationkey").alias("stargazerCount"), F.struct(topics.alias("nodes")).alias("repositoryTopics"))
    both = F.sort_array(F.collect_list(F.struct(k.alias("k"), node.alias("node"))))
    answers = t(spark, sf_dir, "supplier").groupBy(F.floor(k / 100)).agg(both.alias("b")).select(F.col("b.k").alias("ids"), F.to_json(F.struct(F.struct(F.col("b.node").alias("nodes")).alias("data"))).alias("value"))
    return files.snapshot_rows(answers, F.current_timestamp()).select("repository_id", "stars", "forks", "topics", "archived")


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for each region with an item for each nation; nation 3 has no guid and no link."""
    k = F.col("n_nationkey").cast("string")
    guid = F.when(F.col("n_nationkey") != 3, F.concat(F.lit("<link>http://h/"), k, F.lit("</link>"))).otherwise(F.lit(""))
    item = F.concat(F.lit("<item><title>&nbsp;"), F.col("n_name"), F.lit("</title>"), guid, F.lit("<dc:creator>C &amp; D</dc:creator><category>x</category><category> y </category><pubDate>Mon, 02 Feb 2026 10:45:00 -0500</pubDate></item>"))
    items = t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(item)), "").alias("items"))
    rows = t(spark, sf_dir, "region").join(items, F.col("r_regionkey") == F.col("n_regionkey"))
    xml = F.concat(F.lit("<rss version='2.0'><channel><title>"), F.col("r_name"), F.lit("</title><language>en</language>"), F.col("items"), F.lit("</channel></rss>"))
    return rows.select(F.col("r_name").alias("url"), xml.cast("binary").alias("content"))


@query("""
SELECT r_name AS feed, 'http://h/' || n_nationkey AS guid, n_name AS title, 'C & D' AS author, 'x, y' AS categories, TIMESTAMP '2026-02-02 15:45:00' AS published_at
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3
""")
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.feed_items(feeds.feed_rows(_feeds(spark, sf_dir)))
    return rows.select("feed", "guid", "title", "author", "categories", F.col("published_at").cast("timestamp_ntz").alias("published_at"))


@query("SELECT r_name AS url, r_name AS title, 'en' AS language, count(*) AS item_count FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def feed_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_heads(feeds.feed_rows(_feeds(spark, sf_dir))).select("url", "title", "language", "item_count")


@query("""
SELECT page_id, CASE WHEN page_id % 6 <> 0 THEN 200 END::INTEGER AS status, CASE WHEN page_id % 6 <> 0 THEN 'text/html' END AS content_type,
  CASE WHEN page_id % 6 <> 0 THEN strlen(html) END::BIGINT AS body_bytes, page_id % 6 = 0 AS failed
FROM pages
""")
def http_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), F.col("html")).cast("binary")
    rows = t(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 6 == 0, "request").otherwise("response").alias("type"), content.alias("content"))
    h = warc.with_responses(rows)
    return h.select("page_id", F.col("http.status").alias("status"), F.col("http.content_type").alias("content_type"), F.octet_length("http.body").cast("long").alias("body_bytes"), F.col("http.error").isNotNull().alias("failed"))


@query("""SELECT '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '","none":null}' AS value FROM region""")
def export_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines(t(spark, sf_dir, "region").withColumn("none", F.lit(None).cast("string")))


# --- runs and streams -------------------------------------------------------------------------------------------------


def store_of(spark: SparkSession, tables: dict[str, Table] = TABLES) -> Catalog:
    return Catalog(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", tables)


@query("SELECT seq, sha256('synthetic record ' || seq) AS hash, (1 + seq // n)::BIGINT AS run_id FROM (SELECT unnest(range(2 * n)) AS seq, n FROM (SELECT count(*) AS n FROM orders))")
def run_and_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, each of as many records as there are orders."""
    store, n = store_of(spark), t(spark, sf_dir, "orders").count()
    for _ in range(2):
        run(store, "test", {"count": n})
    return store.table("test_records").select("seq", "hash", "run_id")


SEEN = {"seen": Table("seen", "user_id long, event_type string", [["user_id", "event_type"]], "ignore")}


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = store_of(spark, SEEN)
    events = t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for part in ("event_id % 3 <> 0", "event_id % 3 = 0", "false"):  # each run takes what landed since the last
        events.filter(part).drop("event_id").write.mode("append").parquet(f"{store.base}/landed")
        rows = landed_parquet(spark, f"{store.base}/landed", "user_id long, event_type string")
        merge_stream(rows, store, "seen", f"{store.base}/_checkpoint", f"seen-{uuid.uuid4().hex}").awaitTermination()
    return store.table("seen")


# --- any SQL over the tables ------------------------------------------------------------------------------------------

# The same text runs on both engines.
DELEGATED = {
    "g_join_inner": "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "g_join_left": "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "g_join_right": "SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 200000) o RIGHT JOIN customer ON o_custkey = c_custkey",
    "g_join_full": "SELECT a.p_partkey AS a, b.p_partkey AS b FROM (SELECT p_partkey FROM part WHERE p_size < 20) a FULL JOIN (SELECT p_partkey FROM part WHERE p_size > 10) b ON a.p_partkey = b.p_partkey",
    "g_join_semi": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)",
    "g_join_anti": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "g_join_in": "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "g_join_theta": "SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "g_join_self": "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey",
    "g_group_having": "SELECT o_custkey, count(*) AS n, CAST(round(sum(o_totalprice), 2) AS DECIMAL(18, 2)) AS total FROM orders GROUP BY o_custkey HAVING count(*) > 10",
    "g_count_distinct": "SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "g_pricing_summary": "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS qty, round(avg(l_discount), 6) AS discount, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n "
    "FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus",
    "g_aggregate_filter": "SELECT event_type, count(*) FILTER (WHERE value > 50) AS large, count(*) FILTER (WHERE user_id < 20) AS early FROM events GROUP BY event_type",
    "g_rollup": "SELECT r_name, n_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY ROLLUP (r_name, n_name)",
    "g_window_rank": "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS rn, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS r, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS dr FROM orders",
    "g_window_lag": "SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events",
    "g_window_frame": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS n, first_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f FROM events",
    "g_window_ntile": "SELECT n_nationkey, CAST(ntile(4) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS BIGINT) AS q, cume_dist() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS c FROM nation",
    "g_union": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "g_union_all": "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region",
    "g_intersect": "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "g_except": "SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
    "g_recursive_cte": "WITH RECURSIVE t(k, n) AS (SELECT n_nationkey, 1 FROM nation UNION ALL SELECT k, n + 1 FROM t WHERE n < 20) SELECT k, n, n * n AS sq FROM t",
    "g_cte": "WITH big AS (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY o_custkey) SELECT c_name, top FROM big JOIN customer ON c_custkey = o_custkey",
    "g_case_like": "SELECT p_partkey, CASE WHEN p_type LIKE '%A%' THEN 'has a' WHEN p_size BETWEEN 1 AND 10 THEN 'small' ELSE coalesce(nullif(p_brand, 'Brand#11'), 'eleven') END AS c FROM part",
    "g_date_trunc": "SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY date_trunc('month', o_orderdate)",
    "g_strings": "SELECT n_nationkey, upper(n_name) AS u, lower(n_name) AS l, substr(n_name, 2, 3) AS s, CAST(length(n_name) AS BIGINT) AS n, replace(n_name, 'A', '_') AS r, concat(n_name, '!') AS c FROM nation",
    "g_order_limit_offset": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10",
    "g_scalar_subquery": "SELECT s_suppkey FROM supplier WHERE s_acctbal > (SELECT avg(s_acctbal) FROM supplier)",
    "g_natural_values": "SELECT k, label, n_name FROM (VALUES (1, 'one'), (2, 'two')) v(k, label) JOIN nation ON n_nationkey = k",
}


def _delegated(sql: str) -> Query:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        for name in NAMES:
            t(spark, sf_dir, name).createOrReplaceTempView(name)
        return export_rows(spark, query=sql)

    return rows


QUERIES |= {name: _delegated(sql) for name, sql in DELEGATED.items()}
ORACLE_SQL |= DELEGATED


@query("SELECT * FROM customer WHERE c_nationkey IN (3, 7) ORDER BY c_custkey LIMIT 20")
def export_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return export_rows(spark, table="customer", where="c_nationkey IN (3, 7)", order_by="c_custkey", limit=20)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to metadata, one row for each URL: scan, HTML extraction, normalisers and an insert-or-ignore merge."""
    doc = t(spark, sf_dir, "pages").select("page_id", "url", extract_html("html", "url").alias("d"))
    rows = doc.select(
        scalars.empty_to_null("url").alias("url"), scalars.empty_to_null("d.title").alias("title"), scalars.empty_to_null("d.language").alias("language"),
        F.size("d.links").alias("link_count"), F.col("d.text_length").alias("text_length"), F.col("page_id").alias(merge.ORDINAL),
    )
    return merge.insert_ignore(None, rows, [["url"]]).appended


def reruns_agree(make: Callable[[], DataFrame]) -> bool:
    """Whether two evaluations have the same rows, by a hash that ignores their order."""
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return digest(make()) == digest(make())
