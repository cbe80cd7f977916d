"""JSON Lines export of a table or a SQL query."""

from __future__ import annotations

import gzip
import re
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def export_rows(spark: SparkSession, query: str | None = None, table: str | None = None, where: str | None = None, order_by: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a Spark SQL query, or of a table with optional where, order and limit (those apply to tables, limit to both)."""
    if (query is None) == (table is None):
        raise ValueError("give a query or a table")
    if query is not None:
        rows = spark.sql(query)
    else:
        if not NAME.match(table):
            raise ValueError(f"invalid table name {table!r}")
        if not spark.catalog.tableExists(table):
            known = sorted(t.name for t in spark.catalog.listTables())
            raise ValueError(f"no table {table!r}; there are: {', '.join(known) or 'none'}")
        rows = spark.table(f"`{table}`")
        rows = rows.where(where) if where else rows
        rows = spark.sql(f"SELECT * FROM {{rows}} ORDER BY {order_by}", rows=rows) if order_by else rows
    if len(set(rows.columns)) < len(rows.columns):
        raise ValueError("column names repeat")
    return rows if limit is None else rows.limit(limit)


#: Types that to_json() writes as they are.
SIMPLE = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType, T.NullType)


def json_text(name: str, strict: bool) -> Column:
    """A column's JSON text as a value.  Strict: what isn't JSON raises; else only texts of objects and arrays are taken, and others stay text."""
    c = F.col(f"`{name}`")
    value = F.try_parse_json(c)
    if strict:
        wrong = F.concat(F.lit(f"column {name}: not JSON: "), F.substring(c, 1, 80))
        return F.when(c.isNotNull() & value.isNull(), F.raise_error(wrong).cast("variant")).otherwise(value)
    return F.when(F.substring(c, 1, 1).isin("{", "["), F.coalesce(value, c.cast("variant"))).otherwise(c.cast("variant"))


def plain(c: Column, kind: T.DataType) -> Column:
    """A value as JSON can hold it: NaN and infinities are null, bytes text if they are UTF-8, else {"$base64": ...}; dates, times and decimals are text."""
    if isinstance(kind, SIMPLE):
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.abs(c) < F.lit(float("inf")), c)
    if isinstance(kind, T.BinaryType):
        encoded = F.to_variant_object(F.struct(F.base64(c).alias("$base64")))
        return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string").cast("variant")).when(c.isNotNull(), encoded)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zone = "xxx" if isinstance(kind, T.TimestampType) else ""
        whole = F.date_trunc("second", c) == c
        return F.when(whole, F.date_format(c, f"yyyy-MM-dd HH:mm:ss{zone}")).otherwise(F.date_format(c, f"yyyy-MM-dd HH:mm:ss.SSSSSS{zone}"))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: plain(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("key"), plain(e["value"], kind.valueType).alias("value"))))
    return c if isinstance(kind, T.VariantType) else c.cast("string")


def json_lines(rows: DataFrame, json_columns: list[str] = (), detect_json: bool = False) -> DataFrame:
    """Column value: a JSON object for each row, all columns there, nulls too.  Objects of JSON texts have their names in order."""
    columns = []
    for f in rows.schema.fields:
        text = isinstance(f.dataType, T.StringType) and (f.name in json_columns or detect_json)
        columns.append((json_text(f.name, f.name in json_columns) if text else plain(F.col(f"`{f.name}`"), f.dataType)).alias(f.name))
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(lines: DataFrame, path: str, gz: bool = False) -> None:
    """A folder of part files, written by all executors."""
    lines.write.mode("overwrite").text(path, compression="gzip" if gz else "none")


def stream_json_lines(lines: DataFrame, output: str = "-", progress: int = 0) -> int:
    """One file (gzip for .gz) or standard output, a partition at a time through the driver; returns the rows."""
    out = sys.stdout if output == "-" else gzip.open(output, "wt", encoding="utf-8") if output.endswith(".gz") else open(output, "w", encoding="utf-8")
    n = 0
    try:
        for r in lines.toLocalIterator():
            out.write(r.value + "\n")
            n += 1
            if progress and n % progress == 0:
                print(f"{n:,} rows", file=sys.stderr)
    finally:
        if output != "-":
            out.close()
    return n
