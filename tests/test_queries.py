"""Each registered core query against its SQL on DuckDB, over the smallest driver tables."""

import datetime
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tidewell.plans import run_queries, source_queries  # noqa: F401  (they register their queries)
from tidewell.plans.queries import ORACLE_SQL, QUERIES, reruns_agree

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return round(float(v), 6) if isinstance(v, (float, Decimal)) else v


def table(rows, columns):
    return sorted(([plain(r[columns.index(c)]) for c in sorted(columns)] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    if name in ORACLE_SQL:
        found = duck.execute(ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert table(rows, df.columns) == table(found.fetchall(), columns)


def test_entry_and_reruns(spark):
    assert entry.entry(spark).count() > 0
    assert reruns_agree(lambda: QUERIES["insert_ignore_first_wins"](spark, SF_DIR))
    assert set(entry.oracle_sql()) <= set(entry.queries())
