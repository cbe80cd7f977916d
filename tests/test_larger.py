"""Queries on rows that the driver's smallest tables lack: character references in titles; and what tasks hold at once."""

import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_queries import SF_DIR, TABLES, table
from tidewell.plans import run_queries, source_queries  # noqa: F401
from tidewell.plans.queries import ORACLE_SQL, QUERIES
from tidewell.sources import warc

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def agrees(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{folder}/{t}.parquet') else ''}')")
    df = QUERIES[name](spark, str(folder))
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert table(df.collect(), df.columns) == table(found.fetchall(), columns)


def tables_with(spark, folder, **changed):
    for t in TABLES:
        if t in changed:
            changed[t].write.parquet(f"{folder}/{t}.parquet")
        else:
            os.symlink(f"{SF_DIR}/{t}.parquet", f"{folder}/{t}.parquet")
    return folder


@pytest.mark.parametrize("name", ["html_metadata", "crawl_runs"])
def test_references_in_titles(spark, tmp_path, name):
    title = F.element_at(F.array(*map(F.lit, ["a &amp;&amp", "token = &quot;1", "&amp;quot; &lt;b", "&amp;amp; & x&"])), (F.col("page_id") % 4 + 1).cast("int"))
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").withColumn("html", F.concat(F.lit('<!DOCTYPE html><html lang="en"><head><title>'), title, F.lit('</title></head><body><a href="/a?b=1&c=2">&copy;</a></body></html>')))
    agrees(spark, tables_with(spark, tmp_path, pages=pages), name)


def test_few_bodies_at_once():
    n = 3 * warc.TOGETHER + 1
    contents = [b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Length: 2\r\n\r\nab", b"no response"] * n
    got = list(warc.responses(iter([(pa.array(["response"] * n), pa.array(contents[:n]))])))
    assert max(map(len, got)) == warc.TOGETHER and sum(map(len, got)) == n
    assert got[0][0].as_py() == {"status": 200, "content_type": "text/plain", "content_length": 2, "body": b"ab", "error": None} and got[0][1]["error"].as_py()
