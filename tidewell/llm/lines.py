"""Line dedup across documents: lines that many documents share stay in one of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SPACE, chunks, look_up, null_safe, set_aside, stored, utf8

#: Bits of the map that tells which documents may lose lines: 2 MB.
BITS = 1 << 24


def key_of(line: bytes, least: int) -> bytes | None:
    """128-bit hash of a line without outer white space and with A-Z lower-cased, or None if it is shorter than `least` code points."""
    key = line.strip(SPACE)
    if len(key) < least or not key.isascii() and len(key.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, key) of each document's distinct long lines."""
    kept = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, key binary"

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            at, keys = [], []
            for i, text in enumerate(utf8(b.column(1))):
                found = {key_of(x, least) for x in text.split(b"\n")} - {None}
                at += [i] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())], names=["doc_id", "key"])

    return kept.mapInArrow(explode, schema)


def dropped_keys(docs: DataFrame, least: int = 40, most_docs: int = 5) -> DataFrame:
    """doc_id and lost, the array of its line keys that it loses.

    Distinct documents are counted for each key (first by key and document, so a very common line is spread); only keys
    of at least most_docs documents go on, and only they are joined back to the documents that hold them, the hottest by broadcast.
    """
    keys = stored(line_keys(docs, least), "lines")
    common = keys.groupBy("key").agg((F.countDistinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"), F.max("doc_id").alias("keeper")).filter(F.col("n_docs") >= most_docs)
    found = look_up(keys, stored(common, "common"), "key", "n_docs", max(keys.count(), 1))
    lost = found.filter(F.col("keeper").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))


def with_lost(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """docs with lost; only texts of rows whose doc_id may be in `lost` are shuffled, the others stay where they are.

    The ids of `lost` set bits of a map of BITS bits, which is broadcast by its words of 64 bits: of one size whatever the input.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    words = lost.select(place.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits"))
    marked = docs.withColumn("at", place).withColumn("word", F.expr("at div 64")).join(F.broadcast(words), "word", "left")
    maybe = F.coalesce(F.expr("getbit(bits, cast(at % 64 as int)) = 1"), F.lit(False))
    few = marked.filter(maybe).select(*docs.columns)
    rows = few.groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    found = look_up(few, null_safe(lost, rows, ["doc_id"], "inner"), "doc_id", "n_rows", max(docs.count(), 1), whole=0)
    return marked.filter(~maybe).select(*docs.columns, F.lit(None).cast("array<binary>").alias("lost")).unionByName(found.select(*docs.columns, "lost"))


def drop_common_lines(docs: DataFrame, least: int = 40, most_docs: int = 5) -> DataFrame:
    """docs with text less its common lines, and n_lines, n_dropped: one row for each row of docs, columns as they are.

    A line's key is the line without outer ASCII white space, A-Z lower-cased.  Keys of at least `least` code points in
    at least most_docs distinct doc_ids lose all their lines but those in the largest doc_id that holds the key.  Other
    lines stay in place.  A null text is one empty line and stays null; a null doc_id counts as one document, smaller
    than all; rows that repeat a doc_id are one document.  Columns named n_lines or n_dropped are replaced, others may
    have any names; an empty table gives an empty result.
    """
    mine, restore = set_aside(docs.drop("n_lines", "n_dropped"), "doc_id", "text")
    both = with_lost(mine, stored(dropped_keys(mine, least, most_docs), "lost"))
    names = mine.columns
    at = names.index("text")
    schema = mine.withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts, n_lines, n_dropped = utf8(b.column(at)), [], []
            for i, lost in enumerate(b.column(len(names)).to_pylist()):
                lines = texts[i].split(b"\n") if texts[i] else [b""]
                n_lines.append(len(lines))
                n_dropped.append(0)
                if lost:
                    gone = set(lost)
                    left = [x for x in lines if key_of(x, least) not in gone]
                    n_dropped[-1] = len(lines) - len(left)
                    texts[i] = b"\n".join(left)
            cols = [b.column(k) for k in range(len(names))]
            cols[at] = pa.array(texts, pa.binary()).cast(cols[at].type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, "n_lines", "n_dropped"])

    return restore(both.mapInArrow(rebuild, schema), "n_lines", "n_dropped")


def line_summary(docs: DataFrame, least: int = 40, most_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of what is left; of nothing for a null text), from drop_common_lines()."""
    out = drop_common_lines(docs.select("doc_id", "text"), least, most_docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
