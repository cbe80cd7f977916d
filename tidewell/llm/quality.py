"""Quality rules with host verdicts: shrunken failure rates of whole hosts are joined back to their documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SPACE, chunks, look_up, stored, utf8

SYMBOLS = b"#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rules:
    """Limits of the document rules and of the host rule."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5
    #: Bounds of the prior's strength, in documents.
    least_strength: float = 1.0
    most_strength: float = 10_000.0


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    if n - v < 3:  # a repeated window repeats its three words
        return 0
    pairs = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # else the product below stays within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    twice[2:] |= twice[1:-1] | twice[:-2]  # a hit at i covers i, i+1 and i+2
    return int(twice.sum())


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    kept = text.translate(None, SPACE)
    chars = len(kept) if kept.isascii() else len(kept.decode())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def document_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and STATS for each row."""
    kept = docs.select("doc_id", F.col(host).alias("host"), "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, host {kept.schema['host'].dataType.simpleString()}, {STATS}"

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            cols = np.array([text_stats(x) for x in utf8(b.column(2))], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c) for c in cols.T)], names=["doc_id", "host", *(x.split()[0] for x in STATS.split(", "))])

    return kept.mapInArrow(stats, schema)


def prior(hosts: DataFrame, rules: Rules) -> tuple[float, float, int]:
    """alpha and beta of the hosts' beta prior by moments, from one row of sums, and the number of documents."""
    n, k, h, spread = hosts.agg(F.sum("host_docs"), F.sum("host_failed"), F.count("*"), F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs"))).first()
    if not n:
        return 1.0, 1.0, 0
    rate = k / n
    between = (spread - k * rate) / n - rate * (1 - rate) * h / n
    strength = rules.most_strength if between <= 0 else rate * (1 - rate) / between - 1
    strength = min(max(strength, rules.least_strength), rules.most_strength)
    return rate * strength, (1 - rate) * strength, n


def quality_verdicts(docs: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """Statistics and verdicts: one row for each row of docs.

    A document fails by itself (base_failed) with too few words or too many repeated ones.  A host's failure
    rate is shrunk towards all hosts' by a beta prior fitted to them; documents of a host whose shrunken rate
    is over rules.max_host_rate aren't kept either.  A null text has no words and fails; null hosts are one
    host; repeated rows count each; other columns are left out; an empty table gives an empty result.
    Host sums are combined before the shuffle, so a hot host costs a row for each task.
    """
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    stats = stored(document_stats(docs, host).withColumn("base_failed", failed), "quality")
    hosts = stats.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    alpha, beta, n = prior(hosts, rules)
    rate = (F.col("host_failed") + F.lit(alpha)) / (F.col("host_docs") + F.lit(alpha + beta))
    hosts = hosts.withColumn("host_rejected", rate > F.lit(rules.max_host_rate))
    out = look_up(stats, hosts, "host", "host_docs", n)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("host")
