"""Token counts by a map-side lookup in two tiers; no pre-token is ever shuffled."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import chunks

MARK = "▁"
#: A run of blanks with what follows it up to the next blank or line end, or a line end with what follows it.
PRE_TOKEN = re.compile(r"\n[^ \n]*| +[^ \n]*")


@lru_cache(maxsize=2)
def model(path: str) -> Any:
    """The tokenizer, loaded once in each Python worker; checks that cutting texts into pre-tokens can't change the counts."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
    probe = "  a\n  b \n\nab cd   \u2581e"
    if any(re.search(f"[^{MARK}]{MARK}|[\n ]", p) for p in pieces) or len(m.encode(probe)) != sum(lengths_by(m, pre_tokens(probe))):
        raise ValueError(f"{path}: pieces may cross a blank or a line end, so counts by pre-token would be wrong")
    return m


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text; the tokenizer puts a blank before each text that isn't empty."""
    return PRE_TOKEN.findall(" " + text.replace(MARK, " ")) if text else []


def distinct_pre_tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pre-tokens of texts, each text's pre-tokens by number among these, end to end, and where each text's begin (one more for the end).

    What pre_tokens() gives, found in the bytes of all texts at once.
    """
    plain = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), MARK, " ")
    joined = pc.binary_join_element_wise(pa.scalar(" "), plain, "")
    ends = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1, joined.offset * 4)
    data = np.frombuffer(joined.buffers()[2], np.uint8, int(ends[-1]))
    blank = data == 32
    starts = data == 10
    starts[1:] |= blank[1:] & ~blank[:-1]
    starts[ends[:-1]] = True
    at = np.flatnonzero(starts).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, ends[-1:])), joined.buffers()[2]).dictionary_encode()
    return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), np.searchsorted(at, ends)


def lengths_by(m: Any, keys: list[str]) -> list[int]:
    """Tokens of each pre-token: its first blank is the one that the tokenizer adds; added before a line end it is a token too many."""
    ids = m.encode([k[1:] if k[0] == " " else k for k in keys], num_threads=1)
    return [len(x) - (k[0] == "\n") if k != " " else 1 for k, x in zip(keys, ids)]


class Lengths(dict):
    """A worker's cache of pre-token lengths that the broadcast table lacks; emptied when it holds `room` of them."""

    def __init__(self, path: str, room: int) -> None:
        super().__init__()
        self.path, self.room = path, room

    def learn(self, keys: set[str]) -> None:
        if len(self) + len(keys) > self.room:
            self.clear()
        todo = [k for k in keys if k not in self]
        for at in range(0, len(todo), 10_000):
            part = todo[at : at + 10_000]
            self.update(zip(part, lengths_by(model(self.path), part)))


@lru_cache(maxsize=2)
def cache(path: str, room: int) -> Lengths:
    return Lengths(path, room)


def frequent_lengths(docs: DataFrame, path: str, size: int = 32_768, sample_rows: int = 4_000, row_size: int = 500) -> dict[str, int]:
    """Lengths of `size` frequent pre-tokens, by their counts in about sample_rows rows of docs.

    Each task counts the pre-tokens of its sampled rows and sends one row of the most frequent, row_size for each sampled
    row at most; so sample_rows * row_size bounds what the driver gets, whatever the input, and no pre-token is the
    key of a shuffle.  The table only saves time: counts of tokens don't depend on what is in it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        n = 0
        for b in chunks(batches):
            n += b.num_rows
            b = b.filter(pc.greater(pc.binary_length(b.column(0)), 0))
            if b.num_rows:
                keys, which, _ = distinct_pre_tokens(b.column(0))
                seen.update(dict(zip(keys, np.bincount(which, minlength=len(keys)).tolist())))
            if len(seen) > 400_000:
                seen = Counter(dict(seen.most_common(200_000)))
        if seen:
            top = seen.most_common(n * row_size)
            yield pa.RecordBatch.from_arrays([pa.array([[k for k, _ in top]], pa.list_(pa.string())), pa.array([[c for _, c in top]], pa.list_(pa.int64()))], names=["pre", "n"])

    share = min(1.0, sample_rows / max(docs.count(), 1))
    tops = docs.select("text").sample(share, seed=1).mapInArrow(count, "pre array<string>, n array<long>")
    total: Counter[str] = Counter()
    for r in tops.toLocalIterator():
        total.update(dict(zip(r.pre, r.n)))
    keys = sorted(total, key=lambda k: (-total[k], k))[:size]
    return dict(zip(keys, lengths_by(model(path), keys))) if keys else {}


def token_counts(docs: DataFrame, path: str, limit: int = 4096, table_size: int = 32_768, cache_size: int = 200_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit): one row for each row of docs.

    A broadcast table of at most table_size entries answers for frequent pre-tokens; a worker encodes each other one
    once and keeps its length in a cache of at most cache_size.  A pre-token of any length is encoded whole.
    A null or empty text has 0 bytes and 0 tokens; repeated rows count each; other columns are left out.
    """
    kept = docs.select("doc_id", "text")
    table: Broadcast[dict[str, int]] = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, table_size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rare = table.value, cache(path, cache_size)
        for b in chunks(batches):
            keys, which, starts = distinct_pre_tokens(b.column(1))
            lengths = list(map(common.get, keys))
            rare.learn({k for k, n in zip(keys, lengths) if n is None})
            each = np.array([rare[k] if n is None else n for k, n in zip(keys, lengths)], np.int64)
            upto = np.append(0, np.cumsum(each[which]))
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            n = np.where(size.to_numpy() > 0, upto[starts[1:]] - upto[starts[:-1]], 0)
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return kept.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
