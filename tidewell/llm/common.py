"""Helpers that several operators share: tables in the shared folder, ranks, skew-proof lookups."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of ASCII white space: \x20 and \x09-\x0D, which is also what bytes.split() and bytes.strip() use.
SPACE = b" \t\n\x0b\x0c\r"
#: A lookup table of at most so many rows (of a few numbers each) may be broadcast.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  A temporary one only in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """df written once to the shared folder and read again: cuts lineage, survives lost executors.  Inside of scratch() it goes when that ends, unless it is kept."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _scratch and not keep:
        _scratch[-1].append(out)
    return out


_scratch: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Tables that are stored inside are deleted at its end; what is returned must be kept or not read them."""
    _scratch.append([])
    try:
        yield
    finally:
        for table in _scratch.pop():
            discard(table)


def discard(df: DataFrame) -> None:
    """Deletes a stored() table that no later plan reads."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, so that Python objects exist for few rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def arrow_schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


def in_order(df: DataFrame, order: list[Column], weight: str | None = None, label: str = "order") -> DataFrame:
    """df with tw_rank, its rows' number from 0 in this total order, and tw_before, the sum of weight over earlier rows.

    Sorted by range over all executors; no task sees more than its range.  Only one row for each partition (its row count
    and weight) is brought together and broadcast.  Rows that tie in order must be interchangeable.
    """
    spark = df.sparkSession
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("tw_at", at)
    if weight:
        schema = T.StructType([*rows.schema.fields, T.StructField("tw_run", T.LongType())])

        def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for b in batches:
                w = b.column(b.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
                run = np.cumsum(w) - w + total
                total += int(w.sum())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run)], names=[*b.schema.names, "tw_run"])

        rows = rows.mapInArrow(running, schema)
    rows = stored(rows, label)
    part = F.shiftright(F.col("tw_at"), 33)
    of = F.sum(weight) if weight else F.lit(0)
    earlier = Window.orderBy("tw_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(part.cast("long").alias("tw_part")).agg(F.count("*").alias("n"), of.alias("w"))
    starts = starts.select("tw_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"tw_{c}") for c in ("n", "w")))
    out = rows.withColumn("tw_part", part.cast("long")).join(F.broadcast(starts), "tw_part")
    inside = F.col("tw_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = out.withColumn("tw_rank", F.col("tw_n") + inside)
    if weight:
        out = out.withColumn("tw_before", F.col("tw_w") + F.col("tw_run"))
    return out.drop("tw_part", "tw_n", "tw_w", "tw_at", "tw_run")


def look_up(rows: DataFrame, table: DataFrame, key: str, count: str, of: int, whole: int = BROADCAST_ROWS) -> DataFrame:
    """rows left-joined to table on key (null equals null); table has one row for each key, count says how many rows have it.

    Keys with over a thousandth of all `of` rows, so under a thousand of them, are broadcast; the others, none of
    them large, are joined by a shuffle.  A table of at most `whole` rows is broadcast whole.
    """
    if whole and table.limit(whole + 1).count() <= whole:
        return null_safe(rows, F.broadcast(table), [key])
    least = max(of // 1000, 1)
    hot = F.broadcast(table.filter(F.col(count) > least).withColumn("tw_hot", F.lit(True)))
    first = null_safe(rows, hot, [key])
    rest = null_safe(first.filter("tw_hot is null").select(*rows.columns), table.filter(F.col(count) <= least), [key])
    return first.filter("tw_hot").drop("tw_hot").unionByName(rest)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """left joined to right on equal or both-null keys, each kept once."""
    right = right.withColumnsRenamed({k: f"tw_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"tw_{k}")) for k in keys]
    return left.join(right, on, how).drop(*(f"tw_{k}" for k in keys))


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """rows with tw_maybe: false means that key is in no row of wanted.

    The wanted keys set bits of a map, which is broadcast by its words of 64 bits: of one size whatever the input (2 MB).
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    words = wanted.select(place.alias("tw_place")).groupBy(F.expr("tw_place div 64").alias("tw_word")).agg(F.expr("bit_or(shiftleft(1L, cast(tw_place % 64 as int)))").alias("tw_bits"))
    marked = rows.withColumn("tw_place", place).withColumn("tw_word", F.expr("tw_place div 64")).join(F.broadcast(words), "tw_word", "left")
    found = F.coalesce(F.expr("getbit(tw_bits, cast(tw_place % 64 as int)) = 1"), F.lit(False))
    return marked.select(*rows.columns, found.alias("tw_maybe"))


def set_aside(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """df with all columns but `used` named own0, own1, ..., so that no name of an operator meets one of them, and what names them back (with `more` columns)."""
    names = df.columns
    inner = [n if n in used else f"own{i}" for i, n in enumerate(names)]
    return df.toDF(*inner), lambda out, *more: out.select(*inner, *more).toDF(*names, *more)


def docs_of(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
