"""Source divergence audit: how far each source's words are from those of the other sources of its language.

Counts of terms by (lang, source) are dealt into blocks of terms of a language.  A task makes a block a dense matrix of
int64, sources by terms, turns it to shares per thousand million, and holds all pairs of sources against each other by
broadcasting; the blocks' partial pair sums are added up, and the best terms that each block finds for a source are merged.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import chunks, look_up, partitions, stored, utf8

#: Bytes of terms as they count (letters, A-Z lower-cased, and all of other code points); others part terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Shares are per so many.
WHOLE = 1_000_000_000
#: A term is kept if so many documents of the language have it; ranks of terms that a group reports.
LEAST_DOCS, RANKS = 3, 200
#: Cells (sources x terms) of a block, about; terms that a task counts before it sends them on.
CELLS, HELD = 1 << 20, 200_000


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that have it); a row with a null term for each group.

    Tasks count over many documents before they send a term; sums have map-side combining.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)
        having: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for group, terms in n.items():
                keys = [None, *terms]
                cols = [pa.array([group[0]] * len(keys)), pa.array([group[1]] * len(keys)), pa.array(keys, pa.binary()).cast(pa.string())]
                of = having[group]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([0, *terms.values()], pa.int64()), pa.array([0, *(of[t] for t in terms)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            n.clear()
            having.clear()

        for b in chunks(batches, 256):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                words = text.translate(TERMS).split()
                n[lang, source].update(words)
                having[lang, source].update(set(words))
            if sum(map(len, n.values())) > HELD:
                yield from sent()
        yield from sent()

    parts = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term and n of terms that at least so many documents of the language have.  Sums per term go before the shuffle; a term's rows are as many as sources."""
    terms = counts.filter("term is not null")
    many = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
    return terms.join(many.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(WHOLE * (count + 1) / total) of int64 arrays, count + 1 <= total, by long division in base 1000, which nothing overflows up to totals of 9e15."""
    left, out = count + 1, np.zeros(np.broadcast_shapes(count.shape, total.shape), np.int64)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, total)
        out = out * 1000 + digit
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / q); shares are at most WHOLE + 1, so squares fit."""
    return (p - q) ** 2 // q


def block_rows(block: pa.Table, ranks: int) -> Iterator[pa.RecordBatch]:
    """lang, source, part, item and value of one block: (lang, source, term, n, total, terms), first a row of each source (term null, n null), then its counts in the order of terms."""
    heads = block.filter(pc.is_null(block.column("term")))
    rows = block.filter(pc.is_valid(block.column("term")))
    lang = heads.column("lang")[0].as_py()
    sources = heads.column("source").to_pylist()
    totals, v = heads.column("total").to_numpy(), heads.column("terms")[0].as_py()
    terms = rows.column("term").to_numpy(zero_copy_only=False)
    new = np.append(True, terms[1:] != terms[:-1]) if len(terms) else np.zeros(0, bool)
    names = terms[new]
    count = np.zeros((len(sources), len(names)), np.int64)
    number = {s: i for i, s in enumerate(sources)}
    count[[number[s] for s in rows.column("source").to_pylist()], np.cumsum(new) - 1] = rows.column("n").to_numpy()

    def made(source: str, part: str, items: list[str], values: list[int]) -> pa.RecordBatch:
        k = len(items)
        return pa.RecordBatch.from_arrays([*(pa.array([x] * k, pa.string()) for x in (lang, source, part)), pa.array(items, pa.string()), pa.array(values, pa.int64())], names=["lang", "source", "part", "item", "value"])

    p = shares(count, totals[:, None] + v) if len(names) else count
    of_lang = shares(count.sum(0), totals.sum() + v) if len(names) else np.zeros(0, np.int64)
    for i, source in enumerate(sources):
        pair = distance(p[i], p).sum(1)  # one source against all, over the block's terms
        yield made(source, "pair", sources[:i] + sources[i + 1 :], np.delete(pair, i).tolist())
        at = np.flatnonzero((count[i] > 0) & (p[i] > of_lang))
        if len(at):
            value = distance(p[i, at], of_lang[at])
            best = np.lexsort((at, -value))[:ranks]  # terms stand in order, so ties go by place
            yield made(source, "term", names[at[best]].tolist(), value[best].tolist())


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part `pair`: for each source of a language each other one, how far their shares of the language's kept terms are apart,
    0 if it keeps none.  Part `term`: for each source the `ranks` terms that stand out most from the language's shares.
    Ranks go by falling value, then by the item's bytes.  Null text, lang and source are empty ones, an
    empty lang or source is one like any other; repeated rows count as rows; other columns are left out; a source alone in its language
    has no pairs; an empty table gives an empty result.
    """
    counts = stored(counted(docs), "counts")
    groups = counts.filter("term is null").select("lang", "source").distinct()
    kept = stored(kept_counts(counts, least_docs), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(groups.join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0))), "groups")
    sizes = kept.groupBy("lang").agg(F.countDistinct("term").alias("terms"), F.count("*").alias("n_rows"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_sources")).join(sizes, "lang", "left")
    langs = langs.select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.greatest(F.ceil(F.col("n_sources") * F.coalesce("terms", F.lit(0)) / CELLS), F.lit(1)).cast("int").alias("blocks"))
    langs = stored(langs, "langs")
    # each block gets its terms' counts, and a row for each source of the language
    of = max(kept.count(), 1)
    cells = look_up(kept, langs.select("lang", "blocks", "n_rows"), "lang", "n_rows", of)
    cells = cells.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "n", F.lit(None).cast("long").alias("total"), F.lit(None).cast("long").alias("terms"))
    heads = groups.join(langs, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"), "total", "terms")
    rows = heads.unionByName(cells).repartition(partitions(docs.sparkSession), "lang", "block").sortWithinPartitions("lang", "block", F.col("term").asc_nulls_first(), "source")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            at = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            cuts = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and at[lo] != key:
                    yield from block_rows(pa.Table.from_batches(held), ranks)
                    held = []
                if hi > lo:
                    key = at[lo]
                    held.append(b.slice(lo, hi - lo))
        if held:
            yield from block_rows(pa.Table.from_batches(held), ranks)

    found = stored(rows.mapInArrow(blocks, "lang string, source string, part string, item string, value long"), "blocks")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)
    best = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= ranks)  # tasks keep so many of a group before the shuffle
    return pairs.unionByName(best)
