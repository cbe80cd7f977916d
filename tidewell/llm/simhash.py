"""SimHash near-duplicates: fingerprints at most three bits apart, found by deletion variants of half fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import chunks, look_up, null_safe, partitions, set_aside, stored, utf8
from tidewell.llm.graph import components

#: Two halves: of three differing bits one half holds one at most.
HALF = 32
#: Buckets of more fingerprints than this are dealt out once more, by variants of quarter fingerprints of the other half.
GROUP = 8192
#: About so many fingerprints tell which buckets are hot: those that hold a thousandth of them.
SAMPLE = 20_000


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of the three-word shingles (A-Z lower-cased, repeats included), XXH64 with seed 42."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= 3:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[:-2].tolist(), ends[2:].tolist())], np.uint64)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a long) for each row of docs."""
    kept = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long"

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            fp = np.array([fingerprint(t) for t in utf8(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    return kept.mapInArrow(prints, schema)


#: bucket = half and deleted bit (0 to 63) above the half's value without that bit.
BUCKETS = f"transform(sequence(0, 63), p -> shiftleft(cast(p as long), {HALF}) | (shiftrightunsigned(fp, if(p < {HALF}, {HALF}, 0)) & 4294967295L & ~shiftleft(1L, p % {HALF})))"
#: The same of the two 16-bit quarters of the half that the bucket leaves open.
QUARTERS = "transform(sequence(0, 31), q -> shiftleft(cast(q as long), 16) | (shiftrightunsigned(fp, if(shiftrightunsigned(bucket, 32) < 32, 0, 32) + if(q < 16, 16, 0)) & 65535L & ~shiftleft(1L, q % 16)))"


def linked(fps: np.ndarray, bits: int, direct: bool = False) -> np.ndarray:
    """For each distinct fingerprint of a bucket the first one that reaches it by links inside the bucket; with `direct` the last on the way to it.

    Breadth first: one fingerprint at a time takes what it reaches out of those left, so dense buckets cost few passes.
    """
    root = fps.copy()
    left = np.arange(len(fps))
    while len(left):
        seed, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= bits
            root[left[near]] = fps[at if direct else seed]
            queue += left[near].tolist()
            left = left[~near]
    return root


def runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """First key, fingerprints and whether these are all, of each group of two rows or more; rows come sorted by all columns but the last, the fingerprint.

    A group of more than `most` rows comes in parts; groups of one row are passed over without a look.
    """
    key: tuple[int, ...] = ()
    held: list[np.ndarray] = []
    size, parted = 0, False

    def close() -> Iterator[tuple[int, np.ndarray, bool]]:
        nonlocal held, size, parted
        if size > 1 or parted and size:
            yield key[0], np.concatenate(held), not parted
        held, size, parted = [], 0, False

    for b in batches:
        if not b.num_rows:
            continue
        *keys, fp = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        new = np.ones(len(fp), bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.append(np.flatnonzero(new), len(fp))
        seen = np.diff(starts) > 1
        seen[0] = seen[-1] = True  # may go on from the last batch or into the next
        for i in np.flatnonzero(seen).tolist():
            lo, hi = int(starts[i]), int(starts[i + 1])
            at = tuple(int(k[lo]) for k in keys)
            if at != key:
                yield from close()
                key = at
            held.append(fp[lo:hi])
            size += hi - lo
            if size > most:
                yield key[0], np.concatenate(held), False
                held, size, parted = [], 0, True
    yield from close()


def forest(fps: np.ndarray, bits: int, direct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links inside a group."""
    fps = np.unique(fps.view(np.uint64))
    root = linked(fps, bits, direct)
    new = root != fps
    return fps[new].view(np.int64), root[new].view(np.int64)


def links(fps: DataFrame, bits: int = 3, group: int = GROUP, direct: bool = False) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of fps (column fp, distinct) that connect all that lie `bits` (3 at most) or fewer apart.

    Each fingerprint is indexed under 64 buckets, its two halves each with one bit deleted; two at most three bits apart
    share one.  One shuffle brings buckets together; a breadth-first search gives a spanning forest of each, so copies
    cost no pairs.  With `direct` the ends of each edge are themselves as near; else they may be near by others only.  Buckets of over `group` fingerprints are dealt out by one-bit deletions of quarters of the other half
    (again one of them differs by one bit at most), where a group leaves 18 bits open and so holds 2**18 fingerprints at
    most, whatever the input; of that many a search step takes out hundreds, for no more than 2**18 / 19 can lie
    unlinked.  Buckets that a sample of fps shows to be hot go there at once, so no task sees one whole.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits: 0 to 3")
    n = partitions(fps.sparkSession)
    # dealt out first, by another key than the one fps may have been grouped by (else the planner keeps that shuffle and
    # merges it into few tasks): each row becomes 64
    index = fps.repartition(n, F.xxhash64("fp")).select(F.explode(F.expr(BUCKETS)).alias("bucket"), "fp")
    total = fps.count()
    hot = hot_buckets(fps, total, group) if total > group else None

    def search(most: int):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list[np.ndarray]] = []
            for bucket, part, whole in runs(batches, most):
                a, b = forest(part, bits, direct) if whole else (part, part)
                held.append([np.full(len(a), bucket), a, b, np.full(len(a), not whole)])
                if len(part) > 10_000 or len(held) > 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["bucket", "a", "b", "large"])
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["bucket", "a", "b", "large"])

        return found

    schema = "bucket long, a long, b long, large boolean"
    cold = index if hot is None else index.join(F.broadcast(hot), "bucket", "left_anti")
    cold = cold.repartition(n, "bucket").sortWithinPartitions("bucket")
    found = stored(cold.mapInArrow(search(group), schema), "buckets")
    near, large = found.filter("not large").select("a", "b"), found.filter("large").select("bucket", F.col("a").alias("fp"))
    if hot is not None:
        large = large.unionByName(index.join(F.broadcast(hot), "bucket"))
    elif large.isEmpty():
        return near
    again = large.select("bucket", F.explode(F.expr(QUARTERS)).alias("quarter"), "fp")
    again = again.repartition(n, "bucket", "quarter").sortWithinPartitions("bucket", "quarter")
    return near.unionByName(again.mapInArrow(search(1 << 18), schema).select("a", "b"))


def hot_buckets(fps: DataFrame, total: int, group: int) -> DataFrame | None:
    """Buckets (64 thousands at most) that hold over a thousandth of a sample, and likely over `group` of all fingerprints; None if none do.

    Fingerprints are dealt to the sample by hash; it decides by which way a bucket is searched, not what is found.
    """
    every = max(total // SAMPLE, 1)
    some = fps.filter(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(every)) == 0).select(F.explode(F.expr(BUCKETS)).alias("bucket"))
    many = max(SAMPLE // 1000, group // every)
    hot = stored(some.groupBy("bucket").count().filter(F.col("count") > many).select("bucket"), "hot")
    return None if hot.isEmpty() else hot


def near_duplicates(docs: DataFrame, bits: int = 3) -> DataFrame:
    """doc_id, text_hash, fp, fingerprint (16 hex digits) and component_id for each row of docs.

    component_id is the least doc_id that links of at most `bits` differing bits reach, itself included.  Equal
    fingerprints are one node, so copies cost no pairs.  Texts that are null or have no word have fingerprint zero and link
    like any other.  Null doc_ids belong to components but don't name them (a component of them alone has a null one);
    repeated rows get the same answer; other columns are left out; an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")), "prints")
    out = named(rows, nodes, links(nodes.select("fp"), bits))
    return out.select("doc_id", "text_hash", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def named(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """rows (doc_id, text_hash, fp) with component_id; nodes: fp, least (doc_id) and n_rows of each; edges (a, b) between them."""
    roots = components(edges)
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    nodes = stored(nodes, "nodes")
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_nodes"))
    many = look_up(nodes, named, "root", "n_nodes", max(nodes.count(), 1)).select("fp", "n_rows", "component_id")
    return look_up(rows, many, "fp", "n_rows", max(rows.count(), 1)).select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, bits: int = 3) -> DataFrame:
    """docs, columns as they are, with one row of each component: the one of the least doc_id (nulls last, then by hash of the text).

    Rows alike in doc_id and text are one.  Null and empty texts are a component like any other; an empty table stays
    empty; columns may have any names.  Only ids and hashes are shuffled to decide; texts are joined to the decision once.
    """
    return one_of_each(docs, near_duplicates(docs, bits))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """keep_one for components that are found already: doc_id, text_hash, fp and component_id for each row of docs."""
    group = F.when(F.col("component_id").isNull(), F.col("fp"))  # components of null ids alone go by their fingerprint
    alike = found.groupBy("doc_id", "text_hash", "component_id", group.alias("g")).agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "n"))
    kept = alike.groupBy("component_id", "g").agg(best.alias("best")).select("best.doc_id", "best.text_hash", F.col("best.n").alias("n_alike"))
    kept = stored(kept, "kept")
    mine, restore = set_aside(docs, "doc_id", "text")
    rows = mine.withColumn("text_hash", F.xxhash64("text"))
    out = null_safe(rows, kept, ["doc_id", "text_hash"], "inner")
    if not kept.filter("n_alike > 1").isEmpty():  # else no text needs to be shuffled once more
        out = out.filter("n_alike = 1").unionByName(out.filter("n_alike > 1").dropDuplicates(["doc_id", "text_hash"]))
    return restore(out.drop("n_alike", "text_hash"))
