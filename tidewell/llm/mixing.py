"""Mixing sources to target weights: fixed-length blocks, drawn for output shards through pseudorandom permutations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import in_order, look_up, null_safe, partitions, set_aside, stored, utf8


@dataclass(frozen=True)
class Recipe:
    """Weights go to sources in order of code points (null last), over and over."""

    weights: tuple[int, ...] = (5, 2, 1)
    #: Words of the mix, as a share of all words.
    share: float = 1.5
    #: A source's target is at most so many times its words.
    most_epochs: int = 2
    #: Words in a block and output shards; 0: by the corpus, see sized().  Seed of all draws.
    block: int = 0
    shards: int = 0
    seed: int = 1


def sized(recipe: Recipe, total: int) -> Recipe:
    """recipe with blocks of at least 64 and at most 4096 words, about 2**18 of them between these, and a shard for each 100,000 slots, at least 64."""
    block = recipe.block or min(max(64, total >> 18), 4096)
    return replace(recipe, block=block, shards=recipe.shards or max(64, int(recipe.share * total) // block // 100_000))


def sizes(docs: DataFrame, source: str) -> DataFrame:
    kept = docs.select("doc_id", F.col(source).alias("source"), F.xxhash64("text").alias("text_hash"), "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, source {kept.schema['source'].dataType.simpleString()}, text_hash long, size long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([len(t.split()) if t else 0 for t in utf8(b.column(3))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], n], names=["doc_id", "source", "text_hash", "size"])

    return kept.mapInArrow(count, schema)


def targets(rows: DataFrame, recipe: Recipe) -> tuple[DataFrame, int]:
    """source, number, source_size, n_docs, weight, target for each source of rows; and the words of all.

    The level (words for each unit of weight) rises as sources reach their limits; only sums go to the driver.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = in_order(per, [F.col("source").asc_nulls_last()], label="sources").withColumnRenamed("tw_rank", "number")
    weight = F.element_at(F.array(*map(F.lit, recipe.weights)), (F.col("number") % len(recipe.weights) + 1).cast("int"))
    per = stored(per.withColumn("weight", weight.cast("double")), "sources")
    top = F.col("source_size") * recipe.most_epochs
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.lit(level) * F.col("weight") > top
        taken, open_weight = per.agg(F.sum(F.when(full, top).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        nxt = (recipe.share * total - taken) / open_weight
        if nxt <= level:
            break
        level = nxt
    return per.withColumn("target", F.least(F.lit(level) * F.col("weight"), top.cast("double"))), total


def permuted(at: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), fixed by key: a Feistel network on the next even number of bits, walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = at.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for r in range(4):
            mixed = (right + np.uint64((key + r * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(64 - half)) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= n
    return out.astype(np.int64)


def key_of(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def slot_counts(per: DataFrame, recipe: Recipe) -> DataFrame:
    """number, n_blocks, shard, first_slot and n_slots: how many of a source's slots each output shard draws.

    A source has as many slots as come nearest to its target; a multinomial draw, seeded by source, deals them to the shards.
    """
    rows = per.filter("source_size > 0").select("number", "source_size", "target")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, size, target in zip(*(c.to_pylist() for c in b.columns)):
                blocks = -(-size // recipe.block)
                epochs = min(int(target // size), recipe.most_epochs)
                slots = min(epochs * blocks + round((target - epochs * size) * blocks / size), recipe.most_epochs * blocks)
                rng = np.random.Generator(np.random.PCG64(key_of(recipe.seed, "shards", number)))
                n = rng.multinomial(slots, np.full(recipe.shards, 1 / recipe.shards))
                k = recipe.shards
                yield pa.RecordBatch.from_arrays([pa.array([number] * k), pa.array([blocks] * k), pa.array(range(k), pa.int32()), pa.array(np.cumsum(n) - n), pa.array(n)], names=["number", "n_blocks", "shard", "first_slot", "n_slots"])

    return rows.mapInArrow(draw, "number long, n_blocks long, shard int, first_slot long, n_slots long")


def slots(per: DataFrame, recipe: Recipe) -> DataFrame:
    """number, shard, slot, epoch and block of each slot of the mix."""
    spread = slot_counts(per, recipe).filter("n_slots > 0").repartition(partitions(per.sparkSession), "number", "shard")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, blocks, shard, first, n in zip(*(c.to_pylist() for c in b.columns)):
                for at in range(first, first + n, 100_000):
                    slot = np.arange(at, min(at + 100_000, first + n))
                    epoch, inside = slot // blocks, slot % blocks
                    block = np.empty_like(slot)
                    for e in np.unique(epoch).tolist():
                        block[epoch == e] = permuted(inside[epoch == e], blocks, key_of(recipe.seed, "blocks", number, e))
                    k = len(slot)
                    yield pa.RecordBatch.from_arrays([pa.array([number] * k), pa.array([shard] * k, pa.int32()), pa.array(slot), pa.array(epoch.astype(np.int32)), pa.array(block)], names=["number", "shard", "slot", "epoch", "block"])

    return spread.mapInArrow(fill, "number long, shard int, slot long, epoch int, block long")


@dataclass(frozen=True)
class Mix:
    """rows: tw_rank, doc_id, source, text_hash, size, number, source_size, target, start (in its source's stream).
    drawn: a row for each document in each slot: tw_rank, shard, slot, epoch, word (its first word there), n (words)."""

    rows: DataFrame
    drawn: DataFrame


def mix(docs: DataFrame, recipe: Recipe = Recipe(), source: str = "source") -> Mix:
    """The mix of docs by recipe.

    The words of each source's documents, in order of doc_id, make one stream; it is cut into blocks of recipe.block words
    (or as sized() says; the last one may be shorter).  Slots of output shards name blocks by index, and blocks are joined by it.  Each
    epoch is a permutation of all blocks, so no word is taken more than most_epochs times.  Null texts have no words; a
    null source is a source, the last; repeated rows are documents of their own; the same rows give the same mix again.
    """
    rows = stored(sizes(docs, source), "sizes")
    per, total = targets(rows, recipe)
    per, recipe = stored(per, "targets"), sized(recipe, total)
    rows = in_order(rows, [F.col("source").asc_nulls_last(), F.col("doc_id"), F.col("text_hash"), F.col("size")], "size", "stream")
    starts = stored(rows.groupBy("source").agg(F.min("tw_before").alias("tw_first")), "starts")
    n = max(rows.count(), 1)
    per = null_safe(per, starts, ["source"])
    rows = look_up(rows, per.select("source", "number", "source_size", "target", "tw_first", "n_docs"), "source", "n_docs", n)
    rows = stored(rows.withColumn("start", F.col("tw_before") - F.col("tw_first")).drop("tw_first", "tw_before", "n_docs"), "rows")
    k = recipe.block
    spans = rows.filter("size > 0").select("tw_rank", "number", "start", "size", F.explode(F.expr(f"sequence(start div {k}, (start + size - 1) div {k})")).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * k)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * k)
    spans = spans.select("tw_rank", "number", "block", (low - F.col("start")).alias("word"), (high - low).alias("n"))
    # by a merge: the planner takes the slots for as few as the draws they are made from, and would broadcast them
    drawn = slots(per, recipe).hint("merge").join(spans, ["number", "block"]).select("tw_rank", "shard", "slot", "epoch", "word", "n")
    return Mix(rows, drawn)


def mix_summary(docs: DataFrame, recipe: Recipe = Recipe(), source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target (its source's) and taken (words that the mix takes): one row for each row of docs."""
    m = mix(docs, recipe, source)
    taken = m.drawn.groupBy("tw_rank").agg(F.sum("n").alias("taken"))
    out = m.rows.join(taken, "tw_rank", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def words_taken(text: bytes, parts: list[tuple[int, int]], size: int) -> bytes:
    """The words [word, word + n) of parts, in text order, with the white space that follows each inside a part."""
    if sum(n for _, n in parts) == size:
        return text
    out, ends = [], []
    end = 0
    for w in text.split():
        start = text.index(w, end)
        end = start + len(w)
        ends.append((start, end))
    last = None
    for word, n in sorted(parts):
        if last is not None and last[1] == word:
            last = (last[0], word + n)
            continue
        if last:
            out.append(text[ends[last[0]][0] : ends[last[1] - 1][1]])
        last = (word, word + n)
    if last:
        out.append(text[ends[last[0]][0] : ends[last[1] - 1][1]])
    return b"\n".join(out)


def by_copy(rows: DataFrame, alike: DataFrame) -> DataFrame:
    """rows with copy: 0, or for rows alike in doc_id and text_hash (which `alike` lists) their number, by their other columns.

    Rows alike are numbered by a sort by range, so no number of them is one group.
    """
    names = rows.columns
    rows = rows.withColumn("k", F.struct("doc_id", "text_hash"))
    flagged = look_up(rows, alike.select("k", "n_alike"), "k", "n_alike", max(rows.count(), 1))
    several = in_order(flagged.filter("n_alike is not null").drop("n_alike"), [F.col("doc_id"), F.col("text_hash"), F.xxhash64(*names)], label="alike")
    first = several.groupBy("k").agg(F.min("tw_rank").alias("first"), F.count("*").alias("n"))
    several = look_up(several, stored(first, "first"), "k", "n", max(several.count(), 1))
    one = flagged.filter("n_alike is null").select(*names, F.lit(0).cast("long").alias("copy"))
    return one.unionByName(several.select(*names, (F.col("tw_rank") - F.col("first")).alias("copy")))


def mixed_documents(docs: DataFrame, recipe: Recipe = Recipe(), source: str = "source") -> DataFrame:
    """docs as the mix has them, columns as they are and of any names: for each epoch a row of each document of which it takes words.

    The text is whole if the epoch takes all its words, else its taken passages, in order; n_chars, if there, follows.
    Documents without words, null texts among them, aren't in a mix; an empty table gives an empty one.  Texts are
    joined once, to the words taken; of rows alike in doc_id and text each gets its own share of them.
    """
    m = mix(docs, recipe, source)
    parts = m.drawn.groupBy("tw_rank", "epoch").agg(F.collect_list(F.struct("word", "n")).alias("parts"))
    k = F.struct("doc_id", "text_hash")
    alike = m.rows.groupBy("doc_id", "text_hash").agg(F.min("tw_rank").alias("base"), F.count("*").alias("n_alike")).filter("n_alike > 1")
    alike = stored(alike.select(k.alias("k"), "base", "n_alike"), "alike")
    mine, restore = set_aside(docs, "doc_id", "text", "n_chars")
    rows = mine.withColumn("text_hash", F.xxhash64("text"))
    named = m.rows.select("tw_rank", "doc_id", "text_hash", "size")
    if alike.isEmpty():
        rows, named = (x.withColumn("copy", F.lit(0).cast("long")) for x in (rows, named))
    else:
        rows = by_copy(rows, alike)
        named = look_up(named.withColumn("k", k), alike, "k", "n_alike", max(named.count(), 1))
        named = named.withColumn("copy", F.coalesce(F.col("tw_rank") - F.col("base"), F.lit(0).cast("long")))
    taken = named.select("tw_rank", "doc_id", "text_hash", "copy", "size").join(parts, "tw_rank").drop("tw_rank")
    joined = null_safe(rows, taken, ["doc_id", "text_hash", "copy"], "inner")
    names = mine.columns
    flat = joined.select(*names, "size", F.expr("transform(parts, p -> p.word)").alias("word"), F.expr("transform(parts, p -> p.n)").alias("n"))
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = b.columns[: len(names)]
            old = utf8(cols[at])
            size, word, n = (c.to_pylist() for c in b.columns[len(names) :])
            new = [words_taken(t, list(zip(w, k)), s) for t, s, w, k in zip(old, size, word, n)]
            cols[at] = pa.array(new, pa.binary()).cast(cols[at].type)
            if "n_chars" in names:
                c = names.index("n_chars")
                cols[c] = pa.array([v if x is y else len(y.decode()) for v, x, y in zip(cols[c].to_pylist(), old, new)], cols[c].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return restore(flat.mapInArrow(cut, mine.schema))
