"""Readers of landed files: each gives a typed DataFrame."""

from __future__ import annotations

import io
import math
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.scalars import BLANKS, bool_int, empty_to_null, int64, stamp_time, topic_names, trim_u

# Places of the columns in the tab-separated event files.  n: integer, d: double, t: text, s: 14-digit stamp as well.
EVENT_FIELDS = 61
EVENTS = [
    ("global_event_id", 0, "n"), ("day", 1, "n"), ("month_year", 2, "n"), ("year", 3, "n"), ("fraction_date", 4, "d"), ("actor1_code", 5, "t"), ("actor1_name", 6, "t"), ("actor1_country", 7, "t"),
    ("actor1_known_group", 8, "t"), ("actor1_type1", 12, "t"), ("actor2_code", 15, "t"), ("actor2_name", 16, "t"), ("actor2_country", 17, "t"), ("actor2_known_group", 18, "t"), ("actor2_type1", 22, "t"),
    ("is_root_event", 25, "n"), ("event_code", 26, "t"), ("event_base_code", 27, "t"), ("event_root_code", 28, "t"), ("quad_class", 29, "n"), ("goldstein_scale", 30, "d"), ("num_mentions", 31, "n"),
    ("num_sources", 32, "n"), ("num_articles", 33, "n"), ("avg_tone", 34, "d"), ("actor1_geo_country", 37, "t"), ("actor1_geo_lat", 40, "d"), ("actor1_geo_long", 41, "d"), ("actor2_geo_country", 45, "t"),
    ("actor2_geo_lat", 48, "d"), ("actor2_geo_long", 49, "d"), ("action_geo_type", 51, "n"), ("action_geo_fullname", 52, "t"), ("action_geo_country", 53, "t"), ("action_geo_adm1", 54, "t"),
    ("action_geo_lat", 56, "d"), ("action_geo_long", 57, "d"), ("action_geo_feature_id", 58, "t"), ("date_added", 59, "n"), ("date_added_at", 59, "s"), ("source_url", 60, "t"),
]
MENTION_FIELDS = 14
MENTIONS = [
    ("global_event_id", 0, "n"), ("event_time_date", 1, "n"), ("mention_time_date", 2, "n"), ("mention_time_at", 2, "s"), ("mention_type", 3, "n"), ("mention_source_name", 4, "t"), ("mention_identifier", 5, "t"),
    ("sentence_id", 6, "n"), ("in_raw_text", 10, "n"), ("confidence", 11, "n"), ("mention_doc_len", 12, "n"), ("mention_doc_tone", 13, "d"),
]
#: Lines longer than this (bytes) are errors of the file.
TSV_LINE = 16 << 20


def faults(z: zipfile.ZipFile) -> str | None:
    """What is wrong with an archive: a member that doesn't unpack or fails its checksum, or a line that is too long; None for a good one.

    All is unpacked once, a piece at a time.
    """
    for member in z.infolist():
        with z.open(member) as f:
            open_line = 0
            while part := f.read(1 << 20):
                *ended, rest = part.split(b"\n")
                if max(open_line + len(ended[0]) if ended else open_line + len(rest), *map(len, ended), len(rest)) > TSV_LINE:
                    return f"a line of over {TSV_LINE} bytes"
                open_line = len(rest) if ended else open_line + len(rest)
    return None


def zip_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file, line and error for all members of zip files; empty lines are left out.

    A file that can't be read, or with a line of over TSV_LINE bytes, gives one row, with error and no line, and no others.
    Archives are read member by member, line by line.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    names = ["source_file", "line", "error"]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                wrong = None
                try:
                    z = zipfile.ZipFile(io.BytesIO(data.as_py()))
                    wrong = faults(z)
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError, ValueError) as e:
                    wrong = f"{type(e).__name__}: {e}"
                if wrong:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([None], pa.string()), pa.array([wrong])], names=names)
                    continue
                for member in z.infolist():
                    with z.open(member) as f:
                        while part := f.readlines(4 << 20):
                            rows = [x.rstrip(b"\r\n").decode(errors="replace") for x in part if x.strip()]
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(rows, pa.string()), pa.nulls(len(rows), pa.string())], names=names)

    return files.mapInArrow(lines, "source_file string, line string, error string")


def line_errors(lines: DataFrame) -> DataFrame:
    """error and context (the file) of the files of zip_lines() that can't be read."""
    return lines.filter("error is not null").select("error", F.concat(F.lit("ingest "), F.col("source_file")).alias("context"))


WHOLE, NUMBER = "^[+-]?[0-9]+$", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL = re.compile(r"(?i)([+-]?)(inf|infinity|nan)")
#: Types of the kinds of fields, for Spark and for Arrow.
KINDS = {"n": ("long", pa.int64()), "d": ("double", pa.float64()), "t": ("string", pa.string()), "s": ("timestamp", pa.timestamp("us", "UTC"))}


def mended(x: pa.Array, at: pa.Array, found: pa.Array, parse: Callable[[str], Any]) -> pa.Array:
    """found with what parse gives for the few texts of x that `at` (booleans) names."""
    if not pc.any(at).as_py():
        return found
    return pc.replace_with_mask(found, at, pa.array([parse(v) for v in x.filter(at).to_pylist()], found.type))


def whole_field(x: pa.Array) -> pa.Array:
    """Base-10 integers of 64 bits; null for other texts."""
    good = pc.match_substring_regex(x, WHOLE)
    plain = pc.and_(good, pc.and_(pc.less(pc.binary_length(x), 19), pc.invert(pc.starts_with(x, "+"))))
    out = pc.if_else(plain, x, None).cast(pa.int64())
    return mended(x, pc.and_(good, pc.invert(plain)), out, lambda v: n if -(1 << 63) <= (n := int(v)) < 1 << 63 else None)


def double_field(x: pa.Array) -> pa.Array:
    """Decimal or exponent numbers, inf, infinity and nan; null for other texts and for what overflows."""
    good = pc.match_substring_regex(x, NUMBER)
    plain = pc.and_(good, pc.invert(pc.starts_with(x, "+")))
    out = pc.if_else(plain, x, None).cast(pa.float64())
    out = pc.if_else(pc.is_finite(out), out, None)
    out = mended(x, pc.and_(good, pc.invert(plain)), out, lambda v: n if math.isfinite(n := float(v)) else None)
    return mended(x, pc.and_(pc.invert(good), pc.match_substring_regex(x, "(?i)(inf|nan)")), out, lambda v: float(v) if SPECIAL.fullmatch(v) else None)


def stamp_field(x: pa.Array) -> pa.Array:
    """Exactly YYYYMMDDHHMMSS as a time; null for other texts and for what is no time."""
    good = pc.match_substring_regex(x, "^[0-9]{14}$")
    v = pc.if_else(good, x, None).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    part = [v // 10**10, v // 10**8 % 100, v // 10**6 % 100, v // 10**4 % 100, v // 100 % 100, v % 100]
    year, month, day, hour, minute, second = part
    good = pc.fill_null(good, False).to_numpy(zero_copy_only=False) & (month > 0) & (month < 13) & (day > 0) & (hour < 24) & (minute < 60) & (second < 60)
    first = (np.where(good, year - 1970, 0).astype("datetime64[Y]").astype("datetime64[M]") + np.where(good, month - 1, 0)).astype("datetime64[D]")
    days = first + np.where(good, day - 1, 0)
    good &= days.astype("datetime64[M]") == first.astype("datetime64[M]")
    micros = days.astype("datetime64[us]").astype(np.int64) + ((hour * 60 + minute) * 60 + second) * 1_000_000
    return pa.array(micros, pa.int64(), mask=~good).cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))


def text_field(x: pa.Array) -> pa.Array:
    return pc.if_else(pc.equal(x, ""), None, x)


PARSERS = {"n": whole_field, "d": double_field, "t": text_field, "s": stamp_field}


def typed_lines(lines: DataFrame, layout: list[tuple[str, int, str]], n: int, needed: list[str]) -> DataFrame:
    """The layout's columns of lines (source_file, line) with n tab-separated fields or more, each field trimmed, and source_file; rows with a null in a needed column are left out.

    Fields are parsed a column at a time over a batch of lines.  (As one projection of column expressions the generated method is too
    large for the JVM to compile.)
    """
    kept = [i for i, (name, _, _) in enumerate(layout) if name in needed]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields = pc.split_pattern(b.column(1), "\t")
            fits = pc.fill_null(pc.greater_equal(pc.list_value_length(fields), n), False)
            fields, source = fields.filter(fits), b.column(0).filter(fits)
            flat, start = fields.flatten(), fields.offsets.to_numpy()[:-1] - (fields.offsets[0].as_py() if len(fields) else 0)
            trimmed: dict[int, pa.Array] = {}
            for _, i, _ in layout:
                if i not in trimmed:
                    trimmed[i] = pc.utf8_trim(flat.take(pa.array(start + i)), characters=BLANKS)
            out = [PARSERS[kind](trimmed[i]) for _, i, kind in layout]
            rows = pa.RecordBatch.from_arrays([*out, source], names=[*(name for name, _, _ in layout), "source_file"])
            good = pa.array(np.ones(rows.num_rows, bool))
            for k in kept:
                good = pc.and_(good, pc.is_valid(out[k]))
            yield rows.filter(good)

    schema = ", ".join([*(f"{name} {KINDS[kind][0]}" for name, _, kind in layout), "source_file string"])
    return lines.select("source_file", "line").mapInArrow(parse, schema)


def event_rows(lines: DataFrame) -> DataFrame:
    """Events of lines (source_file, line): at least 61 fields and a whole-number id."""
    return typed_lines(lines, EVENTS, EVENT_FIELDS, ["global_event_id"])


def mention_rows(lines: DataFrame) -> DataFrame:
    """Mentions of lines: at least 14 fields, a whole-number id and an identifier."""
    return typed_lines(lines, MENTIONS, MENTION_FIELDS, ["global_event_id", "mention_identifier"])


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """url of each line whose last field ends in .zip."""
    last = F.element_at(F.split(trim_u("value"), r"\s+"), -1)
    return spark.read.text(path).select(last.alias("url")).filter(F.col("url").endswith(".zip"))


def feed_list(spark: SparkSession, inline: list[str], path: str | None = None) -> DataFrame:
    """url and at: a list's URLs, then a file's, trimmed, without blank lines and comments, each once where it comes first."""
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(inline)], "at long, url string")
    if path:
        later = spark.read.text(path).select((F.monotonically_increasing_id() + len(inline)).alias("at"), F.col("value").alias("url"))
        rows = rows.unionByName(later)
    rows = rows.withColumn("url", trim_u("url")).filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    return rows.groupBy("url").agg(F.min("at").alias("at")).orderBy("at")


CDX_META = "url string, mime string, `mime-detected` string, status string, digest string, length string, offset string, filename string, charset string, languages string, redirect string"


def cdx_fields(lines: DataFrame, crawl: str, *kept: str) -> DataFrame:
    """Index rows of all lines (column value: 'surt stamp {json}'), with good: whether a line has JSON and a URL; lines of any length count."""
    parts = F.split("value", " ", 3)
    rows = lines.select(F.get(parts, F.lit(0)).alias("surt"), F.get(parts, F.lit(1)).alias("stamp"), F.get(parts, F.lit(2)).alias("blob"), *kept)
    rows = rows.withColumn("m", F.from_json(F.when(F.col("blob").startswith("{"), F.col("blob")), CDX_META, {"maxStringLen": str((1 << 31) - 1)}))
    n = lambda c: int64(F.col(f"m.{c}"), trim=False).alias(c)
    t = lambda c, a=None: empty_to_null(F.col(f"m.`{c}`")).alias(a or c)
    good = F.coalesce(F.col("m.url") != "", F.lit(False)).alias("good")
    return rows.select(F.lit(crawl).alias("crawl"), "surt", F.col("m.url").alias("url"), "stamp", stamp_time("stamp").alias("fetched_at"), n("status"), t("mime"), t("mime-detected", "mime_detected"), t("charset"), t("languages"), t("digest"), n("length"), n("offset"), t("filename"), good, *kept)


def cdx_rows(lines: DataFrame, crawl: str) -> DataFrame:
    """Index rows of lines; those without JSON or without a URL are left out."""
    return cdx_fields(lines, crawl).filter("good").drop("good")


def shard_of(path: Column) -> Column:
    """A shard's name from its file's path."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.gz$", "")


def shard_name(n: Column) -> Column:
    """The file name of a crawl's n-th index shard."""
    return F.format_string("cdx-%05d.gz", n)


def read_crawls(spark: SparkSession, path: str) -> DataFrame:
    """Crawls of a JSON list, with their place in it: 0 is the newest."""
    schema = "array<struct<id:string,name:string,`cdx-api`:string,`from`:string,`to`:string>>"
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", schema)).alias("at", "c"))
    return rows.select("at", "c.id", "c.name", F.col("c.cdx-api").alias("cdx_api"), F.col("c.from").alias("from_at"), F.col("c.to").alias("to_at"))


REPOSITORY = "id long, node_id string, name string, full_name string, description string, fork boolean, html_url string, url string, owner struct<id:long,login:string,type:string>"
EVENT = "id string, type string, actor struct<id:long,login:string>, repo struct<id:long,name:string>, org struct<login:string>, public boolean, created_at string, payload string"
NODE = (
    "struct<databaseId:long,nameWithOwner:string,stargazerCount:long,forkCount:long,watchers:struct<totalCount:long>,issues:struct<totalCount:long>,diskUsage:long,primaryLanguage:struct<name:string>,"
    "defaultBranchRef:struct<name:string>,licenseInfo:struct<spdxId:string>,repositoryTopics:struct<nodes:array<struct<topic:struct<name:string>>>>,isArchived:boolean,createdAt:string,updatedAt:string,pushedAt:string>"
)


def page_errors(pages: DataFrame, schema: str) -> DataFrame:
    """error and context (column path) of JSON pages (column value) that aren't what the schema says."""
    return pages.filter(F.from_json("value", schema).isNull() & F.col("value").isNotNull()).select(F.lit("malformed JSON page").alias("error"), F.col("path").alias("context"))


def repository_rows(json: DataFrame) -> DataFrame:
    """Repositories of JSON pages (column value: an array)."""
    r = json.select(F.explode(F.from_json("value", array_of(REPOSITORY))).alias("r"))
    t = lambda c, a: empty_to_null(F.col(f"r.{c}")).alias(a)
    return r.select(F.col("r.id").alias("id"), t("node_id", "node_id"), F.col("r.full_name").alias("full_name"), t("name", "name"), t("owner.login", "owner"), F.col("r.owner.id").alias("owner_id"), t("owner.type", "owner_type"), t("description", "description"), bool_int("r.fork").alias("fork"), t("html_url", "html_url"), t("url", "api_url"))


def array_of(ddl: str) -> str:
    return T.ArrayType(T.StructType.fromDDL(ddl)).simpleString()


def host_event_rows(json: DataFrame, payload: bool = True) -> DataFrame:
    """Events of JSON pages; those without an id are left out; payload stays raw JSON."""
    e = json.select(F.explode(F.from_json("value", array_of(EVENT))).alias("e")).filter("e.id <> ''")
    t = lambda c, a: empty_to_null(F.col(f"e.{c}")).alias(a)
    return e.select(F.col("e.id").alias("id"), t("type", "type"), F.col("e.actor.id").alias("actor_id"), t("actor.login", "actor_login"), F.col("e.repo.id").alias("repo_id"), t("repo.name", "repo_name"), t("org.login", "org_login"), bool_int("e.public").alias("public"), t("created_at", "created_at"), (F.col("e.payload") if payload else F.lit(None).cast("string")).alias("payload"))


def snapshot_rows(json: DataFrame, observed_at: Column) -> DataFrame:
    """Snapshots of batch answers (value: JSON with data.nodes; ids: the ids asked for, by place).  Nodes without id or name are left out."""
    nodes = json.select("ids", F.from_json("value", f"data struct<nodes:array<{NODE}>>").alias("j")).select("ids", F.posexplode("j.data.nodes").alias("at", "n"))
    key = F.coalesce(F.nullif(F.col("n.databaseId"), F.lit(0)), F.get("ids", F.col("at")))
    rows = nodes.withColumn("repository_id", key.cast("long")).filter("repository_id is not null and repository_id <> 0 and n.nameWithOwner <> ''")
    t = lambda c, a: empty_to_null(F.col(f"n.{c}")).alias(a)
    z = lambda c, a: F.coalesce(F.col(f"n.{c}"), F.lit(0)).alias(a)
    return rows.select(
        "repository_id", observed_at.alias("observed_at"), z("stargazerCount", "stars"), z("forkCount", "forks"), z("watchers.totalCount", "watchers"), z("issues.totalCount", "open_issues"), F.col("n.diskUsage").alias("size_kb"),
        t("primaryLanguage.name", "language"), t("defaultBranchRef.name", "default_branch"), topic_names("n.repositoryTopics.nodes").alias("topics"), t("licenseInfo.spdxId", "license"), bool_int("n.isArchived").alias("archived"),
        t("createdAt", "created_at"), t("updatedAt", "updated_at"), t("pushedAt", "pushed_at"),
    )


def synthetic(spark: SparkSession, start: int, count: int) -> DataFrame:
    """Test records seq, payload and hash (SHA-256 of the payload)."""
    rows = spark.range(start, start + count).select(F.col("id").alias("seq"), F.concat(F.lit("synthetic record "), F.col("id").cast("string")).alias("payload"))
    return rows.withColumn("hash", F.sha2("payload", 256))
