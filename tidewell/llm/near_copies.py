"""Near copies: texts whose sets of word shingles have a Jaccard similarity of at least 4/5, all of them and no others.

SimHash comes first: fingerprints of the sets at most three bits apart, found by deletion variants (simhash.links), give links where the
sets agree.  It can't find all: two such texts differ in 9.7 of 64 bits on average, and segments of which one surely differs by one
bit at most would then be of 6 bits and tell nothing apart, at any length of the fingerprint.  So more candidates come from
a prefix filter (Bayardo et al., 2007): in any one order of all shingles, two such sets share one of the first n // 5 + 1 of
their n.  Shingles that many texts have come last, by counts over all texts in an array of one size; that keeps buckets small
and decides nothing else.
A bucket's texts are held against one of them first; after that only texts that no link connects are held against each other,
by counts of their shingles in 128 cells, which bound what two sets can share from above, and only in the bucket of the first
shingle that they share.  Buckets with many of them are first cut
by a second shingle: sets so similar share two of their first n // 5 + 2.  What passes is decided by the sets, where many pass
in tasks that hold them: these give a link only where it connects what none has connected, so never more links than texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import BROADCAST_ROWS, chunks, discard, look_up, partitions, scratch, stored, utf8
from tidewell.llm.graph import components
from tidewell.llm.simhash import links as print_links
from tidewell.llm.simhash import majority, named, one_of_each

#: Similar: intersection / union of at least LEAST / OF.
LEAST, OF = 4, 5
#: Counters of shingles (their places by hash), which order them; and those of a row when tasks' counters are added up.
COUNTERS, TOGETHER = 1 << 22, 1 << 12
#: About so many texts tell which shingles are hot.
SAMPLE = 20_000
#: Shingles of over a HOTth of the sample are hot; their buckets are dealt out in SALTS parts.
HOT, SALTS = 100, 64
#: Rows that a bucket's first is held against at once, rows of a block of a bucket; and texts without a link in a bucket that needn't get one in another round.
GROUP, BLOCK, SINGLES = 8192, 4096, 64
#: Shingles of the texts that are dealt together to be held against each other by their sets (a text of more comes alone).
SHINGLES = 1 << 20
#: Cells of the counts that bound what two sets share; sets of LONG to MOST shingles also have counts in FINE cells.
CELLS, LONG, FINE, MOST = 128, 1000, 512, 65_535


def shingle_set(text: bytes | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles (A-Z lower-cased); fewer words are one shingle, no words none."""
    words = text.lower().split() if text else []
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64).view(np.int64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts[: 1 - k].tolist(), ends[k - 1 :].tolist())], np.uint64).view(np.int64))


def hot_shingles(docs: DataFrame, k: int) -> list[int]:
    """Shingles that over a HOTth of a sample of the distinct texts have."""
    every = max(docs.count() // SAMPLE, 1)
    texts = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            h, n = np.unique(np.concatenate([shingle_set(t, k) for t in utf8(b.column(0))] or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    sums = texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") > SAMPLE // HOT)
    return [r.shingle for r in sums.collect()]  # HOT times the words of a text on average, at most


def frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """About how many texts have a shingle, by its counter: over all texts, in tasks, added up by rows of counters.  Only an order is made of it."""
    rows = COUNTERS // TOGETHER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int32)
        for b in chunks(batches):
            for t in utf8(b.column(0)):
                total[shingle_set(t, k) & (COUNTERS - 1)] += 1
        parts = np.minimum(total, 255).astype(np.uint8).reshape(rows, TOGETHER)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([parts[i].tobytes() for i in used], pa.binary())], names=["row", "n"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(TOGETHER, np.int64)
        for n in t.column("n"):
            total += np.frombuffer(n.as_buffer(), np.uint8)
        return pa.table({"row": t.column("row")[:1], "n": pa.array([np.minimum(total, 65_535).astype(np.uint16).tobytes()], pa.binary())})

    out = np.zeros((rows, TOGETHER), np.uint16)
    found = docs.select("text").mapInArrow(count, "row long, n binary").groupBy("row").applyInArrow(add, "row long, n binary")
    for r in found.collect():  # two bytes for each counter
        out[r.row] = np.frombuffer(r.n, np.uint16)
    return out.ravel()


def prefixes(docs: DataFrame, k: int, frequency: np.ndarray) -> DataFrame:
    """doc_id, text_hash, fp (a hash of the set), print (its SimHash), n (its size), cells and fine (counts) and first (its shingles that the prefix filter needs, and the next one)."""
    kept = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(frequency)
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long, print long, n long, cells binary, fine binary, first array<long>"

    def first(h: np.ndarray) -> np.ndarray:
        return h[np.argsort(sent.value[h & (COUNTERS - 1)], kind="stable")][: len(h) + 2 - -(-LEAST * len(h) // OF)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            fp, prints, n, cells, fine, prefix = [], [], [], [], [], []
            for t in utf8(b.column(2)):
                h = shingle_set(t, k)
                fp.append(xxhash.xxh64_intdigest(h.tobytes(), 42))
                prints.append(majority(h.view(np.uint64)))
                n.append(len(h))
                cells.append(counts(h, CELLS))
                fine.append(counts(h, FINE) if LONG <= len(h) <= MOST else b"")
                prefix.append(first(h))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in prefix])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *prefix])))
            cols = [b.column(0), b.column(1), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, prints)), pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (cells, fine)), lists]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_hash", "fp", "print", "n", "cells", "fine", "first"])

    return kept.mapInArrow(rows, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """fp and set for wanted (fp, text_hash): one text of each is read again."""
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(F.broadcast(wanted) if few else wanted, "text_hash")
    texts = texts.groupBy("fp").agg(F.first("text").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, k) for t in utf8(b.column(1))], pa.list_(pa.int64()))], names=["fp", "set"])

    return texts.mapInArrow(sets, "fp long, set array<long>")


def with_ends(pairs: DataFrame, table: DataFrame, of: int) -> DataFrame:
    """pairs (a, b, of rows) with each column c of table (fp, ...) as c_a and c_b; an end that many pairs have is looked up by broadcast."""
    out = pairs
    for end in ("a", "b"):
        mine = table.withColumnsRenamed({c: f"{c}_{end}" for c in table.columns if c != "fp"}).withColumnRenamed("fp", end)
        hot = pairs.groupBy(end).agg(F.count("*").alias("many")).filter(F.col("many") > max(of // 1000, 1000))
        if hot.isEmpty():
            out = out.join(mine, end)
        else:
            out = look_up(out, mine.join(pairs.groupBy(end).agg(F.count("*").alias(f"of_{end}")), end), end, f"of_{end}", of, whole=0)
    return out


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (shingle, salt, fp, n), sorted, each bucket's members with the first of them: shingle, fp, n, pivot, n_pivot, and whether the bucket has three or more.

    Buckets of one are left out, as is the pivot's own row in those of two.  Parts of hot buckets have salts from 0, other
    buckets -1.  A bucket passes in parts, so it may be of any size.
    """
    names = ["shingle", "salt", "fp", "n"]
    held = [np.zeros(0, np.int64)] * 4
    parted = False  # held is the pivot of a bucket of which more may come

    def members(cols: list[np.ndarray], first_parted: bool) -> pa.RecordBatch:
        shingle, salt, fp, n = cols
        new = np.ones(len(fp), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(fp)))
        large = (size > 2) | (salt[starts] >= 0)  # parts of a hot bucket belong to a large one
        if first_parted and len(size):
            large[0] = True
        at = np.repeat(starts, size)
        keep = np.repeat((size > 1) | large, size) & (~new | np.repeat(large, size))
        if first_parted:
            keep[:1] = False
        out = [shingle, fp, n, fp[at], n[at], np.repeat(large, size)]
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in out], names=["shingle", "fp", "n", "pivot", "n_pivot", "large"])

    for b in batches:
        cols = [np.concatenate((h, b.column(i).to_numpy(zero_copy_only=False))) for i, h in enumerate(held)]
        if not len(cols[0]):
            continue
        last = int(np.flatnonzero(np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])))[-1])
        if last:
            yield members([c[:last] for c in cols], parted)
            parted = False
        held = [c[last:] for c in cols]
        if len(held[0]) > GROUP:
            yield members(held, parted)
            held, parted = [c[:1] for c in held], True
    if len(held[0]):
        yield members(held, parted)


def most_shared(cells: np.ndarray, others: np.ndarray) -> np.ndarray:
    """What sets can share at most, by their counts in cells."""
    return np.minimum(cells, others).sum(-1, dtype=np.int64)


def counts(h: np.ndarray, cells: int) -> bytes:
    """Shingles in each cell; were one over MOST, all cells say MOST, which bounds nothing."""
    n = np.bincount(h & (cells - 1), minlength=cells)
    return (n if n.max() <= MOST else np.full(cells, MOST)).astype(np.uint16).tobytes()


def cells_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, CELLS)


def finely(a: bytes, b: bytes, n: int) -> bool:
    """Whether two sets of n shingles together may be similar by their fine counts, if both have them."""
    return not a or not b or (LEAST + OF) * int(most_shared(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16))) >= LEAST * n


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Those of the pairs (a, b) of fps whose sets are similar, each once: first by what their counts allow, then by the sets."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    total = pairs.count()
    out = with_ends(pairs, nodes.select("fp", "n", "cells", "fine"), total).select("a", "b", "n_a", "n_b", "cells_a", "cells_b", "fine_a", "fine_b")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 4096):
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            good = (LEAST + OF) * most_shared(cells_of(b.column(4)), cells_of(b.column(5))) >= LEAST * n
            x, y = b.column(6).to_pylist(), b.column(7).to_pylist()
            for i in np.flatnonzero(good).tolist():
                good[i] = finely(x[i], y[i], int(n[i]))
            yield b.select(["a", "b"]).filter(pa.array(good))

    left = stored(out.mapInArrow(possible, "a long, b long"), "possible")
    ends = left.select(F.col("a").alias("fp")).unionByName(left.select(F.col("b").alias("fp"))).distinct()
    sets = stored(sets_of(docs, nodes.select("fp", "text_hash").join(ends, "fp"), k), "sets")
    both = F.size(F.array_intersect("set_a", "set_b"))
    similar = with_ends(left, sets, left.count()).filter((LEAST + OF) * both >= LEAST * (F.size("set_a") + F.size("set_b")))
    out = stored(similar.select("a", "b"), "links")
    for table in (pairs, left, sets):
        discard(table)
    return out


def by_simhash(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of fps whose SimHashes lie at most three bits apart: of equal ones each with the least, of others the least of each, by the edges that connect them."""
    prints = stored(nodes.groupBy("print").agg(F.min("fp").alias("least"), F.count("*").alias("of")), "prints")
    same = look_up(nodes.select("fp", "print"), prints, "print", "of", max(nodes.count(), 1)).select(F.col("fp").alias("a"), F.col("least").alias("b")).filter("a <> b")
    near = stored(print_links(prints.select(F.col("print").alias("fp")), direct=True).distinct(), "near_prints")
    return same.unionByName(with_ends(near, prints.select(F.col("print").alias("fp"), "least"), near.count()).select(F.col("least_a").alias("a"), F.col("least_b").alias("b")))


def links(docs: DataFrame, rows: DataFrame, k: int, hot: list[int]) -> DataFrame:
    """Edges (a, b) between the nodes fp of rows (of prefixes(), stored; they are deleted once the nodes are) that connect all whose sets are similar.

    First come those that SimHash finds and the sets confirm.  Then one shuffle brings the texts of a shingle together.  Each is held against the first of its bucket, in hot buckets against
    the first of its part and firsts against each other; another round does so for texts that no link connects, where a
    bucket has many of them.  Then texts of a bucket that are still apart are held against all others of it.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    nodes = stored(rows.groupBy("fp").agg(F.first("n").alias("n"), F.first("print").alias("print"), F.first("first").alias("first"), F.first("cells").alias("cells"), F.first("fine").alias("fine"), F.min("text_hash").alias("text_hash")), "nodes")
    discard(rows)
    close = verified(by_simhash(nodes), nodes, docs, k)
    needed = F.col("n") + 1 - F.ceil(F.col("n") * LEAST / OF)
    index = nodes.repartition(n, F.xxhash64("fp")).select("fp", "n", F.explode(F.slice("first", F.lit(1), needed.cast("int"))).alias("shingle"))
    if hot:  # SAMPLE * HOT at most; a part's first is likely one of the few with a small fp
        table = spark.createDataFrame([(h, True) for h in hot], "shingle long, hot boolean")
        index = index.join(F.broadcast(table), "shingle", "left")
        part, last, none = F.pmod("fp", F.lit(SALTS)).cast("long"), F.lit(SALTS).cast("long"), F.lit(-1).cast("long")
        few = F.col("fp") < F.lit(-(1 << 63) + (1 << 54))
        salts = F.when(F.col("hot") & few, F.array(part, last)).when(F.col("hot"), F.array(part)).otherwise(F.array(none))
        index = index.select("shingle", F.explode(salts).alias("salt"), "fp", "n")
    else:
        index = index.select("shingle", F.lit(-1).cast("long").alias("salt"), "fp", "n")
    index = index.repartition(n, "shingle", "salt").sortWithinPartitions("shingle", "salt", "fp")
    near = lambda a, b: OF * F.least(a, b) >= LEAST * F.greatest(a, b)
    found = stored(index.mapInArrow(stars, "shingle long, fp long, n long, pivot long, n_pivot long, large boolean"), "shingles")
    edges = close.unionByName(verified(found.filter((F.col("fp") != F.col("pivot")) & near("n", "n_pivot")).select(F.col("fp").alias("a"), F.col("pivot").alias("b")), nodes, docs, k))
    large = stored(found.filter("large").select("shingle", "fp", "n").distinct(), "large")
    for turn in range(2):
        edges = components(edges).select(F.col("node").alias("a"), F.col("root").alias("b"))
        if large.isEmpty():
            return edges
        roots = stored(edges.select(F.col("a").alias("fp"), F.col("b").alias("root")), "roots")
        apart = stored(large.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "apart")
        per = stored(apart.groupBy("shingle", "root").agg(F.count("*").alias("c")), "counts")
        main = stored(mains(per), "main")
        if turn == 1 or main.filter(F.col("singles") > SINGLES).isEmpty():
            break
        alone = apart.join(per.filter("c = 1").select("shingle", "root"), ["shingle", "root"]).join(main.filter(F.col("singles") > SINGLES).select("shingle"), "shingle")
        one = F.min(F.struct(F.xxhash64("fp", F.lit(turn)).alias("h"), F.col("fp").alias("b"), F.col("n").alias("n_b")))
        tried = alone.join(alone.groupBy("shingle").agg(one.alias("x")).select("shingle", "x.b", "x.n_b"), "shingle")
        tried = tried.filter((F.col("fp") != F.col("b")) & near("n", "n_b")).select(F.col("fp").alias("a"), "b")
        edges = edges.unionByName(verified(tried, nodes, docs, k))
    return edges.unionByName(decided(stored(across(apart, main, nodes, n, deal=True), "dealt"), nodes, docs, k, n))


def mains(per: DataFrame) -> DataFrame:
    """shingle, main (the root of most of its texts), m (texts), late (those of other roots) and singles of buckets with several roots; per: shingle, root and c (texts)."""
    most = F.max(F.struct("c", "root"))
    out = per.groupBy("shingle").agg(most["root"].alias("main"), F.sum("c").alias("m"), (F.sum("c") - most["c"]).alias("late"), F.count("*").alias("roots"), F.count(F.when(F.col("c") == 1, 1)).alias("singles"))
    return out.filter("roots > 1")


def with_main(apart: DataFrame, main: DataFrame) -> DataFrame:
    """Rows of apart whose bucket has several roots, with main, m, late and rest: whether their root isn't the main one."""
    rows = look_up(apart, main.select("shingle", "main", "m", "late"), "shingle", "m", max(apart.count(), 1)).filter("main is not null")
    return rows.withColumn("rest", F.col("root") != F.col("main"))


def across(apart: DataFrame, main: DataFrame, nodes: DataFrame, n: int, deal: bool = False) -> DataFrame:
    """Pairs (a, b) of a bucket's texts with different roots that may be similar by their sizes and counts; with `deal` what decided() takes.

    apart: shingle, fp, n, root.  main: mains() of it.  Texts of the main root are never held against each other.  In a bucket with up to
    BLOCK others these go to every part of the main ones.  A bucket with more is cut by a second shingle that two of its
    texts must share; where that leaves as many, blocks of at most about BLOCK texts are held against each other in pairs of blocks.
    No task holds more than two blocks, and none a whole bucket.
    """
    rows = stored(with_main(apart, main).select("shingle", "fp", "n", "root", "rest", "m", "late"), "across")
    few, many = rows.filter(F.col("late") <= BLOCK), rows.filter(F.col("late") > BLOCK)
    dealt = in_parts(few)
    if not many.isEmpty():
        second = many.join(nodes.select("fp", "first"), "fp").withColumn("second", F.explode("first")).filter("second <> shingle")
        finer = stored(second.select(F.xxhash64("shingle", "second").alias("shingle"), "fp", "n", "root").distinct(), "finer")
        again = with_main(finer, stored(mains(finer.groupBy("shingle", "root").agg(F.count("*").alias("c"))), "main"))
        dealt = dealt.unionByName(in_parts(again.filter(F.col("late") <= BLOCK))).unionByName(in_blocks(again.filter(F.col("late") > BLOCK)))
    return compared(dealt, nodes, n, deal)


#: What a row of a part is held against: nothing by itself, rows of NONE, or those and later rows of its own kind.
NONE, OTHERS, BOTH = 0, 1, 2


def in_parts(rows: DataFrame) -> DataFrame:
    """shingle, part, kind, fp, n and root: main texts dealt to parts of BLOCK, the few others to each; those are held against each other in the first part only."""
    parts = F.greatest(F.ceil((F.col("m") - F.col("late")) / BLOCK), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    out = rows.withColumn("part", F.explode(F.when(F.col("rest"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(mine))))
    kind = F.when(~F.col("rest"), NONE).when(F.col("part") == 0, BOTH).otherwise(OTHERS)
    return out.select("shingle", F.col("part").cast("long").alias("part"), kind.alias("kind"), "fp", "n", "root")


def in_blocks(rows: DataFrame) -> DataFrame:
    """As in_parts(), but a part is a pair of blocks: of others with others (also each with itself), and of others with main texts."""
    late, main = F.ceil(F.col("late") / BLOCK).cast("int"), F.greatest(F.ceil((F.col("m") - F.col("late")) / BLOCK), F.lit(1)).cast("int")
    mine = F.when(F.col("rest"), F.pmod(F.xxhash64("fp"), late)).otherwise(late + F.pmod(F.xxhash64("fp"), main)).cast("int")
    out = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("rest"), late + main).otherwise(late) - 1)))
    first, second = F.least("mine", "other"), F.greatest("mine", "other")
    kind = F.when(F.col("mine") == F.col("other"), BOTH).when(F.col("mine") < F.col("other"), OTHERS).otherwise(NONE)
    return out.select("shingle", (first.cast("long") * (1 << 31) + second).alias("part"), kind.alias("kind"), "fp", "n", "root")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows of each value of the first `keys` columns, by which they come sorted."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        at = np.stack([b.column(i).to_numpy() for i in range(keys)], 1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), len(at)] if len(at) else []
        for lo, hi in zip(cuts, cuts[1:]):
            if held and tuple(at[lo]) != key:
                yield pa.concat_batches(held)
                held = []
            key = tuple(at[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about 10,000."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size > 10_000 or len(held) > 1000:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def partners(b: pa.RecordBatch, root: np.ndarray, rows: np.ndarray, allowed: Callable[[int], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of these rows of a bucket those allowed that have another root (as it is by then) and may be similar by sizes and counts.

    A pair counts only in the bucket of the first shingle that both need, for that one has it as well; buckets by two shingles know no first.
    """
    n, cells, shingle = b.column("n").to_numpy(), cells_of(b.column("cells")), b.column("shingle")[0].as_py()
    first = b.column("first")
    flat, starts, size = first.flatten().to_numpy(), first.offsets.to_numpy(), n + 1 + -LEAST * n // OF
    starts = starts - starts[0]
    for i in rows.tolist():
        j = np.flatnonzero((root != root[i]) & allowed(i) & (OF * np.minimum(n, n[i]) >= LEAST * np.maximum(n, n[i])))
        j = j[(LEAST + OF) * most_shared(cells[j], cells[i]) >= LEAST * (n[j] + n[i])]
        mine = flat[starts[i] : starts[i] + size[i]]
        own = np.flatnonzero(mine == shingle)
        if len(own) and len(j):
            order = np.argsort(mine)
            theirs = np.concatenate([flat[starts[x] : starts[x] + size[x]] for x in j.tolist()])
            at = np.minimum(np.searchsorted(mine[order], theirs), len(mine) - 1)
            at = np.where(mine[order][at] == theirs, order[at], len(mine))
            j = j[np.minimum.reduceat(at, np.concatenate(([0], np.cumsum(size[j])[:-1]))) == own[0]]
        if len(j):
            yield i, j


def compared(rows: DataFrame, nodes: DataFrame, n: int, deal: bool = False) -> DataFrame:
    """Pairs (a, b) of the rows of a part with different roots that may be similar by their sizes and counts.

    With `deal`, which is for parts with any number of such pairs, no pairs but the rows that are in one, for decided(): a part's texts are
    cut, by their sizes, into blocks of about SHINGLES shingles, and for two blocks (or one and itself) with pairs comes each text in one of
    them, with its role.  So a part gives its rows once for each SHINGLES that its texts hold, at most twice.
    """
    rows = rows.join(nodes.select("fp", "cells", "first"), "fp").repartition(n, "shingle", "part").sortWithinPartitions("shingle", "part", "kind")
    names = ["shingle", "part", "kind", "fp", "n", "root", "cells", "first"]

    def found(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        kind, place = b.column("kind").to_numpy(), np.arange(b.num_rows)
        order = np.flatnonzero(kind)
        order = order[np.argsort(b.column("n").to_numpy()[order], kind="stable")]
        return partners(b, b.column("root").to_numpy(), order, lambda i: (kind == NONE) | (kind[i] == BOTH) & (place > i))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((b.column("fp").to_numpy(), found(b)) for b in groups(batches, 2))
        yield from gathered(pa.RecordBatch.from_arrays([pa.array(np.full(len(j), fp[i])), pa.array(fp[j])], names=["a", "b"]) for fp, all_ in parts for i, j in all_)

    def dealt_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = b.column("n").to_numpy()
        block = np.empty(len(n), np.int64)
        order = np.argsort(n, kind="stable")
        block[order] = (np.cumsum(n[order]) - n[order]) // SHINGLES
        for p, each in itertools.groupby(found(b), key=lambda x: int(block[x[0]])):
            roles: dict[int, np.ndarray] = {}
            for i, j in each:
                for q in np.unique(block[j]).tolist():
                    role = roles.setdefault(q, np.zeros(len(n), np.int8))
                    role[i] |= ONE
                    role[j[block[j] == q]] |= OTHER
            for q, role in roles.items():
                at = np.flatnonzero(role)
                some = b.select(["shingle", "part", "fp", "n", "root", "cells", "first"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(np.full(len(at), (p << 31) + q)), pa.array(role[at].astype(np.int64)), *some.columns[2:]], names=DEALT)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered(x for b in groups(batches, 2) for x in dealt_of(b))

    if deal:
        return rows.select(*names).mapInArrow(texts, "shingle long, part long, block long, role long, fp long, n long, root long, cells binary, first array<long>")
    return rows.select(*names).mapInArrow(pairs, "a long, b long").distinct()


DEALT = ["shingle", "part", "block", "role", "fp", "n", "root", "cells", "first"]
#: Roles of a row of two blocks: one of a pair, the other, or both (in different pairs).
ONE, OTHER = 1, 2


def decided(dealt: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, n: int) -> DataFrame:
    """Links (a, b) between rows of compared(..., deal=True) that connect all whose sets are similar, of each two blocks a spanning forest.

    A text is held against the others by its set, but not against those that a link of the same two blocks connects it with by then.
    """
    sets = stored(sets_of(docs, nodes.select("fp", "text_hash").join(dealt.select("fp").distinct(), "fp"), k), "sets")
    rows = dealt.join(sets, "fp").repartition(n, "shingle", "part", "block").sortWithinPartitions("shingle", "part", "block")

    def links_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp, n, role = (b.column(c).to_numpy() for c in ("fp", "n", "role"))
        root, place = b.column("root").to_numpy().copy(), np.arange(b.num_rows)
        one, other = (role & ONE) > 0, (role & OTHER) > 0
        flat, starts = b.column("set").flatten().to_numpy(), b.column("set").offsets.to_numpy()
        starts = starts - starts[0]
        for i, j in partners(b, root, np.flatnonzero(one), lambda i: other & ~((place <= i) & one & other[i]) & (place != i)):
            mine = flat[starts[i] : starts[i + 1]]
            theirs = np.concatenate([flat[starts[x] : starts[x + 1]] for x in j.tolist()])
            shared = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            both = np.add.reduceat(shared, np.concatenate(([0], np.cumsum(n[j])[:-1])), dtype=np.int64)
            j = j[(LEAST + OF) * both >= LEAST * (n[j] + n[i])]
            if len(j):
                roots, at = np.unique(root[j], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), fp[i])), pa.array(fp[j[at]])], names=["a", "b"])
                root[np.isin(root, roots)] = root[i]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered(x for b in groups(batches, 3) for x in links_of(b))

    return rows.select(*DEALT, "set").mapInArrow(links, "a long, b long")


def near_copies(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, text_hash, fp and component_id (the least doc_id that links of similar sets reach) for each row of docs.

    As simhash.near_duplicates, but by exact similarity; fp is a hash of the set.  Texts that are null or have no word are alike.
    """
    with scratch():
        whole = stored(prefixes(docs, k, frequencies(docs, k)), "prefixes")
        rows = stored(whole.select("doc_id", "text_hash", "fp"), "rows")
        edges = links(docs, whole, k, hot_shingles(docs, k))
        out = named(rows, rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")), edges)
        return stored(out, "near", keep=True)


def keep_one(docs: DataFrame, k: int = 5) -> DataFrame:
    """docs, columns as they are, with one row of each component of near copies, chosen as simhash.keep_one does."""
    return one_of_each(docs, near_copies(docs, k))
