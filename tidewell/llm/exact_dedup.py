"""Exact dedup of whole texts: batches are screened by static binary-fuse filters of immutable snapshots.

Texts are equal when they are the same bytes after each run of ASCII white space became one space.  A batch's digests are
first grouped among themselves; each distinct one is then asked of the filters of every earlier snapshot.  Those that no
filter holds are new without any join; the others are joined to the snapshot's exact buckets.  What has equal digests
is compared byte by byte, so a digest decides nothing alone: digests that hold several texts are grouped by the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import look_up, maybe_in, null_safe, set_aside, stored

#: Digests of a bucket, about: one filter, and what a task holds at once.
BUCKET = 200_000
#: What tries to build a filter may take; each fails with a probability well under a half.
TRIES = 100

# Multipliers of the 64-bit finaliser of MurmurHash3.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    for m in MIX:
        h = (h ^ (h >> np.uint64(33))) * np.uint64(m)
    return h ^ (h >> np.uint64(33))


@dataclass(frozen=True)
class Fuse:
    """A binary fuse filter (Graf and Lemire, 2022) with 3 cells for each key, in neighbouring segments, and 8-bit fingerprints."""

    seed: int
    length: int
    segments: int
    cells: np.ndarray

    @staticmethod
    def spread(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys' three cells (3 rows) and their fingerprints."""
        h = mixed(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        inside = mixed(h)
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        mask = np.uint64(length - 1)
        cells = np.stack([(first + np.uint64(i)) * np.uint64(length) + ((inside >> np.uint64(18 * i)) & mask) for i in range(3)])
        return cells.astype(np.int64), (h & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> Fuse:
        """The filter of distinct keys (uint64).  Keys are peeled off in rounds: each takes all cells that one key has left."""
        n = max(len(keys), 2)
        length = 1 << min(18, max(2, math.floor(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, math.ceil(n * factor / length) - 2)
        size = (segments + 2) * length
        for seed in range(TRIES):
            places, prints = cls.spread(keys, seed, length, segments)
            count = np.bincount(places.ravel(), minlength=size)
            owner = np.zeros(size, np.int64)  # of the keys that a cell has left, their numbers' xor
            np.bitwise_xor.at(owner, places.ravel(), np.tile(np.arange(len(keys)), 3))
            rounds, ready = [], np.flatnonzero(count == 1)
            while len(ready):
                key, which = np.unique(owner[ready], return_index=True)
                rounds.append((key, ready[which]))
                gone = places[:, key].ravel()
                np.subtract.at(count, gone, 1)
                np.bitwise_xor.at(owner, gone, np.tile(key, 3))
                ready = np.unique(gone)
                ready = ready[count[ready] == 1]
            if sum(len(key) for key, _ in rounds) == len(keys):
                cells = np.zeros(size, np.uint8)
                for key, at in reversed(rounds):  # a cell still has 0 when its own key's turn comes
                    a, b, c = places[:, key]
                    cells[at] = prints[key] ^ cells[a] ^ cells[b] ^ cells[c]
                return cls(seed, length, segments, cells)
        raise ValueError("keys repeat")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """True for all keys of the filter, and for one of 256 others."""
        (a, b, c), prints = self.spread(keys, self.seed, self.length, self.segments)
        return prints == self.cells[a] ^ self.cells[b] ^ self.cells[c]


@dataclass(frozen=True)
class Snapshot:
    """Distinct digests of an earlier batch that no snapshot before it had (digest, bucket, keep_id, n), and a filter for each bucket.  Never changed."""

    digests: DataFrame
    filters: DataFrame
    buckets: int


def normal(text: Column) -> Column:
    """A text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def snapshot(digests: DataFrame) -> Snapshot:
    """The snapshot of distinct digests (digest, keep_id, n), written to the shared folder."""
    buckets = -(-digests.count() // BUCKET) or 1
    kept = stored(digests.select("digest", bucket(buckets), "keep_id", "n"), "snapshot")

    def build(t: pa.Table) -> pa.Table:
        f = Fuse.build(t.column("digest").to_numpy().view(np.uint64))
        return pa.table({"bucket": t.column("bucket")[:1], "seed": [f.seed], "length": [f.length], "segments": [f.segments], "cells": [f.cells.tobytes()]})

    filters = kept.select("bucket", "digest").groupBy("bucket").applyInArrow(build, "bucket int, seed long, length long, segments long, cells binary")
    return Snapshot(kept, stored(filters, "filters"), buckets)


def screened(digests: DataFrame, of: Snapshot) -> DataFrame:
    """digests (digest, keep_id, n) with maybe: whether the snapshot's filter of their bucket holds them.  A task holds one filter and one bucket."""
    parts = -(-digests.count() // BUCKET) or 1  # a batch larger than the snapshot is dealt out further
    part = F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(parts)).cast("int")
    rows = digests.select("digest", "keep_id", "n", bucket(of.buckets), part.alias("part"))
    filters = of.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    kind = digests.schema["keep_id"].dataType.simpleString()

    def ask(rows: pa.Table, filters: pa.Table) -> pa.Table:
        keys = rows.column("digest").to_numpy().view(np.uint64)
        maybe = np.zeros(len(keys), bool)
        for f in filters.to_pylist():
            maybe = Fuse(f["seed"], f["length"], f["segments"], np.frombuffer(f["cells"], np.uint8)).holds(keys)
        return rows.select(["digest", "keep_id", "n"]).append_column("maybe", pa.array(maybe))

    return rows.groupBy("bucket", "part").cogroup(filters.groupBy("bucket", "part")).applyInArrow(ask, f"digest long, keep_id {kind}, n long, maybe boolean")


def arrive(batch: DataFrame, snapshots: Iterable[Snapshot]) -> tuple[DataFrame, list[DataFrame]]:
    """Of a batch's rows (doc_id, digest), grouped by digest (digest, keep_id, n): those that are new, and those that each snapshot has."""
    left = stored(batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")), "arrived")
    known = []
    for s in snapshots:
        asked = stored(screened(left, s), "screened")
        maybe = asked.filter("maybe").drop("maybe")
        exact = s.digests.select("digest")
        known.append(stored(maybe.join(exact, "digest", "left_semi"), "known"))
        left = asked.filter("not maybe").drop("maybe").unionByName(maybe.join(exact, "digest", "left_anti"))
    return left, known


def hashed(docs: DataFrame, digest: Column) -> DataFrame:
    body = normal(F.col("text"))
    return docs.select("doc_id", body.alias("body")).select("doc_id", digest.alias("digest"), "body")


def classes(docs: DataFrame, batches: int = 3, digest: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, text_sha256 and copies (how many rows are alike in doc_id and text), one row for rows that are alike.

    docs: doc_id and text.  Rows come in so many batches, dealt by a hash of doc_id; each becomes a snapshot that later ones are screened by.  digest: of the
    column body, a long.
    """
    rows = hashed(docs, F.xxhash64("body") if digest is None else digest)
    base = stored(rows.select("doc_id", "digest", F.sha2("body", 256).alias("text_sha256")), "digests")
    snapshots: list[Snapshot] = []
    seen: list[DataFrame] = []
    for i in range(batches):
        fresh, known = arrive(base.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i), snapshots)
        seen += known
        snapshots.append(snapshot(fresh))
    parts = [s.digests.select("digest", "keep_id", "n") for s in snapshots] + seen
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    several = union.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")).filter("group_size > 1")
    several = stored(several, "several")
    # byte checks: of rows with a digest of several rows, the distinct texts; copies go before the shuffle
    texts = maybe_in(rows.select("digest", "body"), several, "digest").filter("tw_maybe").select("digest", "body").distinct()
    unequal = stored(texts.groupBy("digest").count().filter("count > 1").select("digest"), "unequal")
    alike = base.groupBy("doc_id", "digest", "text_sha256").agg(F.count("*").alias("copies"))
    of = max(base.count(), 1)
    if unequal.isEmpty():
        out = look_up(alike, several, "digest", "group_size", of)
    else:
        out = look_up(alike.join(unequal, "digest", "left_anti"), several.join(unequal, "digest", "left_anti"), "digest", "group_size", of)
        split = maybe_in(rows, unequal, "digest").filter("tw_maybe").drop("tw_maybe").join(unequal, "digest", "left_semi")
        split = split.groupBy("doc_id", "body").agg(F.count("*").alias("copies"))
        by_text = split.groupBy("body").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
        both = look_up(split, by_text, "body", "group_size", of, whole=0)
        out = out.select("doc_id", "text_sha256", "copies", "keep_id", "group_size").unionByName(both.select("doc_id", F.sha2("body", 256).alias("text_sha256"), "copies", "keep_id", "group_size"))
    alone = F.col("group_size").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256", "copies")


def duplicates(docs: DataFrame, batches: int = 3, digest: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of docs.

    The row of the smallest doc_id stays; of rows that repeat it with an equal text, one.  A null text counts as empty.  A null doc_id
    is larger than all others: such a row stays only where all of its class are null, and then one of them (keep_id is null).
    Other columns are left out; an empty table gives an empty result.
    """
    found = classes(docs, batches, digest)
    each = found.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, batches: int = 3) -> DataFrame:
    """docs, columns as they are, with the rows that duplicates() keeps.  Of rows alike in doc_id and normalised text any one stays; columns may have any names."""
    stay = classes(docs.select("doc_id", "text"), batches).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stay = stored(stay.select("doc_id", "text_sha256", "copies"), "stay")
    mine, restore = set_aside(docs, "doc_id", "text")
    rows = mine.withColumn("text_sha256", F.sha2(normal(F.col("text")), 256))
    out = null_safe(rows, stay, ["doc_id", "text_sha256"], "inner")
    if not stay.filter("copies > 1").isEmpty():
        once = out.filter("copies > 1").groupBy("doc_id", "text_sha256").agg(F.first(F.struct(*mine.columns)).alias("row")).select("row.*")
        return restore(out.filter("copies = 1").select(*mine.columns).unionByName(once))
    return restore(out)
