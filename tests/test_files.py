"""Readers of landed files: long lines, and the parsers of fields."""

import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from tidewell.functions import scalars
from tidewell.sources import files


def test_cdx_keeps_long_lines(spark):
    sizes = [3, 9 << 20, 101 << 20]
    url = F.concat(F.lit("http://h/"), F.repeat(F.lit("y"), F.col("n")))
    lines = spark.createDataFrame([(n,) for n in sizes], "n int").select(F.concat(F.lit('h)/ 20260202154500 {"url": "'), url, F.lit('", "status": "200"}')).alias("value"))
    got = files.cdx_rows(lines, "c").select(F.length("url").alias("n"), "status").collect()
    assert sorted((r.n, r.status) for r in got) == [(9 + n, 200) for n in sizes]


def test_fields_as_the_column_functions_have_them(spark):
    """The parsers of whole batches against the scalar functions, and both against Python, on odd and random texts."""
    rng = random.Random(4)
    texts = ["", "0", "-0", "+5", "12", "007", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "+9223372036854775807", "1" * 40, "1.5", "1.", ".5", ".", "+", "-", "+.5e3", "1e5", "1E+400", "-1e400", "1e-400",
             "inf", "-Infinity", "+INF", "nan", "-NaN", "infinit", "0x1", "1_0", "1f", "1d", "é", "1 2", "١٢", "20260202154500", "20260230000000", "20240229235959", "20230229000000", "20260101240000", "00000101000000", "99991231235959", "2026020215450", "2026020215450x", "20261301000000"]
    texts += ["".join(rng.choices("0123456789+-.eE", k=rng.randint(1, 8))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").select("i", scalars.int64("x").alias("n"), scalars.float64("x").alias("d"), scalars.empty_to_null("x").alias("t"), scalars.stamp_time("x").cast("long").alias("s"))
    x = pa.array(texts)
    got = {k: (f(x).cast(pa.timestamp("us")).cast(pa.int64()) if k == "s" else f(x)).to_pylist() for k, f in files.PARSERS.items()}
    for r in rows.collect():
        assert got["n"][r.i] == r.n and got["t"][r.i] == r.t and (got["s"][r.i] and got["s"][r.i] // 1_000_000) == r.s, texts[r.i]
        assert got["d"][r.i] == r.d or math.isnan(got["d"][r.i]) and math.isnan(r.d), texts[r.i]


def test_lines_of_few_and_many_fields(spark):
    lines = spark.createDataFrame([("f", "\t".join(x)) for x in ([" 7 ", "a\xa0", "", "x", "more"], ["8", "b"], ["z", "c", "1", "2"], ["9", " ", "\x0b5", "é"])] + [("f", None), (None, "5\td\te\tf")], "source_file string, line string")
    got = files.typed_lines(lines, [("id", 0, "n"), ("name", 1, "t"), ("again", 0, "t"), ("last", 2, "n")], 4, ["id"])
    assert sorted(map(tuple, got.collect())) == [(5, "d", "5", None, None), (7, "a", "7", None, "f"), (9, None, "9", 5, "f")]
    assert files.event_rows(lines.limit(0)).count() == 0 and files.event_rows(lines.limit(0)).columns[-1] == "source_file"
