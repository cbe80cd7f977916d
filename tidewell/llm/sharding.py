"""Sharding along a Hilbert curve: documents alike in several metadata dimensions share files, so min/max pruning works in each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import in_order, set_aside


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (n x d whole numbers below 2**bits).

    Skilling's method: undo the excess rotations from the top bit down, Gray-code, then interleave the bits.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for c in x:
            up = (c & q) != 0
            swap = np.where(up, 0, (x[0] ^ c) & low)
            x[0] ^= np.where(up, low, swap)
            if c is not x[0]:
                c ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    out = np.zeros_like(fix)
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ fix) >> b) & 1)
    return out


def as_number(df: DataFrame, name: str, bits: int) -> tuple[Column, np.ndarray | None]:
    """A column as a double that keeps its order, nulls and NaN first, and its cuts if they are known already.

    Strings are cut where their distinct values, in order and each with the rows that have it, fill another
    2**-bits of all rows; these cuts, fewer than 2**bits, go to the driver, and a string's number is how many of them it reaches.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        per = df.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
        per = in_order(per.filter("value is not null"), [F.col("value")], "n", "values")
        total = max(per.agg(F.sum("n")).first()[0] or 0, 1)
        cell = F.expr(f"(tw_before << {bits}) div {total}")
        cuts = sorted(r.least for r in per.groupBy(cell.alias("cell")).agg(F.min("value").alias("least")).collect())[1:]
        reached = [(F.col(name) >= F.lit(bytes(c) if isinstance(c, bytearray) else c)).cast("int") for c in cuts]
        return F.coalesce(sum(reached, F.lit(0)).cast("double"), F.lit(0.0)), np.arange(len(cuts)) + 0.5
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        v = F.unix_timestamp(F.col(name).cast("timestamp")).cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        v = F.col(name).cast("double")
        v = F.when(~F.isnan(v), v)
    else:
        raise TypeError(f"{name}: no dimension of type {kind.simpleString()}")
    return F.coalesce(v, F.lit(-1.7976931348623157e308)), None


def shard_order(rows: DataFrame, dims: list[str], bits: int = 5) -> DataFrame:
    """rows with tw_curve.  Each dimension is quantised at its quantiles (at most 2**bits - 1 cuts go to the driver)."""
    numbers = {f"tw_d{i}": as_number(rows, d, bits) for i, d in enumerate(dims)}
    rows = rows.withColumns({n: c for n, (c, _) in numbers.items()})
    names = list(numbers)
    open_dims = [n for n, (_, cuts) in numbers.items() if cuts is None]
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = dict(zip(open_dims, rows.approxQuantile(open_dims, at, 0.005))) if open_dims else {}
    cuts = [np.array(sorted(set(found[n]))) if n in found else known for n, (_, known) in numbers.items()]
    schema = T.StructType([*rows.drop(*names).schema.fields, T.StructField("tw_curve", T.LongType())])
    keep = rows.drop(*names).columns

    def curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            cells = [np.searchsorted(c, col[n].to_numpy(zero_copy_only=False), side="right") for n, c in zip(names, cuts)]
            yield pa.RecordBatch.from_arrays([*(col[n] for n in keep), pa.array(hilbert_index(np.stack(cells, 1), bits))], names=[*keep, "tw_curve"])

    return rows.mapInArrow(curve, schema)


def assign_shards(rows: DataFrame, dims: list[str], n_shards: int, bits: int = 5, ties: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """rows with shard (0 to n_shards - 1) and slot (0, 1, ... within its shard): equal runs of rows along the curve.

    Counts differ by one at most ("rows").  Rows in one curve cell are ordered by `ties`; what ties in those too is
    ordered by all its other columns, so a hot cell or a repeated row is cut as any other.  Nulls sort first.
    An empty table gives an empty result; fewer rows than shards leave shards empty.  Columns named shard or slot are
    replaced, others may have any names.
    """
    rows, restore = set_aside(rows.drop("shard", "slot"), *dims, *ties)
    short = [c for c in rows.columns if c not in ties]
    rest = F.xxhash64(*short) if short else F.lit(0)
    rows = shard_order(rows.withColumn("tw_rest", rest), dims, bits)
    ranked = in_order(rows, [F.col("tw_curve"), *map(F.col, ties), F.col("tw_rest")], label="shards")
    n = ranked.count()
    out = ranked.withColumn("shard", F.expr(f"(tw_rank * {n_shards}) div {max(n, 1)}"))
    first = F.expr(f"(shard * {n} + {n_shards - 1}) div {n_shards}")  # the shard's least rank
    out = out.withColumn("slot", F.col("tw_rank") - first).withColumn("shard", F.col("shard").cast("int"))
    return restore(out, "shard", "slot")


def shard_ranges(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Rows and each dimension's least and greatest value for each shard: what a reader prunes files by."""
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))))


def write_shards(sharded: DataFrame, path: str, n_shards: int) -> None:
    """One folder for each shard, rows in slot order; each task writes one shard's run."""
    sharded.repartition(n_shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
