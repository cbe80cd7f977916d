"""Benchmark decontamination by a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import chunks, in_order, null_safe, set_aside, stored, utf8

#: Words are runs of ASCII digits and letters (A-Z lower-cased) and of all bytes from \x80; the rest separates.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Items' words in one automaton, and in a piece of an item; both bound what a task builds and what is broadcast at once.
AUTOMATON_WORDS, PIECE_WORDS = 200_000, 10_000


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


@dataclass
class Automaton:
    """Suffix automaton of several word sequences.  A state stands for substrings that end at the same places."""

    window: int
    number: dict[bytes, int] = field(default_factory=dict)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: Items of each state that holds a window: (words of the window, items).
    found: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    items: list[object] = field(default_factory=list)
    #: Pairs of adjacent words that the items hold, and the fewest words of a window.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    least: int = 0

    def add(self, ids: list[int]) -> None:
        last = 0
        for c in ids:
            last = self._extend(last, c)

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier item has this substring
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state({}, -1, self.length[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        short = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = short
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = short
            p = self.link[p]
        return short

    def _state(self, moves: dict[int, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """State and longest matching length at the end of each word."""
        at = n = 0
        for c in ids:
            while at and c not in self.next[at]:
                at = self.link[at]
                n = self.length[at]
            if c in self.next[at]:
                at = self.next[at][c]
                n += 1
            yield at, n

    def windows_at(self, at: int, n: int) -> Iterator[tuple[int, int]]:
        """(words, item) of the windows that end here, of a match of n words."""
        while at > 0:
            for size, item in self.found.get(at, ()):
                if size <= min(n, self.length[at]):
                    yield size, item
            at = self.link[at]
            n = self.length[at]


def automaton(items: list[tuple[object, list[bytes]]], window: int) -> Automaton:
    a = Automaton(window)
    texts = [[a.number.setdefault(w, len(a.number)) for w in words] for _, words in items]
    a.items = [i for i, _ in items]
    for ids in texts:
        a.add(ids)
    for item, ids in enumerate(texts):
        size = min(window, len(ids))
        for end, (at, n) in enumerate(a.walk(ids), 1):
            if end >= size:
                while a.length[a.link[at]] >= size:  # to the state of the last `size` words
                    at = a.link[at]
                a.found.setdefault(at, []).append((size, item))
    for at, x in a.found.items():
        a.found[at] = sorted(set(x))
    v = len(a.number)
    a.pairs = np.unique(np.array([p * v + q for ids in texts for p, q in zip(ids, ids[1:])], np.int64))
    a.least = min((min(window, len(ids)) for ids in texts), default=window)
    return a


def runs(a: Automaton, ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of words (-1: in no item) outside which no window can match: all adjacent pairs occur in items."""
    known = ids >= 0
    if a.least > 1:
        pair = ids[:-1] * len(a.number) + ids[1:]
        at = np.minimum(np.searchsorted(a.pairs, pair), max(len(a.pairs) - 1, 0))
        good = known[:-1] & known[1:] & (a.pairs[at] == pair) if len(a.pairs) else np.zeros(len(pair), bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - start + 1 >= a.least:
                yield start, end + 1
    else:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        yield from zip(edge[::2].tolist(), edge[1::2].tolist())


def matches(a: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans of words under windows, merged, and the items whose windows occur."""
    number = a.number
    ids = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    for start, end in runs(a, ids):
        for at, (state, n) in enumerate(a.walk(ids[start:end].tolist()), start + 1):
            if n < a.least:
                continue
            longest = 0
            for size, item in a.windows_at(state, n):
                items.add(item)
                longest = max(longest, size)
            if longest:
                if spans and spans[-1][1] >= at - longest:
                    first = min(spans[-1][0], at - longest)
                    while len(spans) > 1 and spans[-2][1] >= first:
                        first = min(first, spans.pop(-2)[0])
                    spans[-1] = (first, at)
                else:
                    spans.append((at - longest, at))
    return spans, items


def pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """item, words (joined by blanks) and n of pieces of at most PIECE_WORDS + window - 1 words that hold all windows of all items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 16):
            out = []
            for item, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                words = words_of(text)
                for at in range(0, max(len(words) - window, 0) + 1 if words else 0, PIECE_WORDS):
                    part = words[at : at + PIECE_WORDS + window - 1]
                    out.append((item, b" ".join(part), len(part)))
            item, words, n = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["item", "words", "n"])

    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(cut, "item string, words binary, n long")


def automata(benchmark: DataFrame, window: int) -> list[DataFrame]:
    """A one-row table (automaton, pickled) for each AUTOMATON_WORDS words of the items; tasks build them, none holds more than that."""
    cut = stored(pieces(benchmark, window), "pieces")
    total = cut.agg(F.sum("n")).first()[0] or 0
    number = F.lit(0).cast("long")
    if total > AUTOMATON_WORDS:
        cut, number = in_order(cut, [F.col("item"), F.col("words")], "n", "pieces"), F.expr(f"tw_before div {AUTOMATON_WORDS}")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        a = automaton([(None if pd.isna(i) else i, w.split()) for i, w in zip(pdf["item"], pdf["words"])], window)
        return pd.DataFrame({"number": pdf["number"].iloc[:1], "automaton": [pickle.dumps(a)]})

    built = cut.select(number.alias("number"), "item", "words").groupBy("number").applyInPandas(build, "number long, automaton binary")
    built = stored(built, "automata")
    return [built.filter(F.col("number") == i).select("automaton") for i in range(-(-total // AUTOMATON_WORDS))]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = {"n_words": pa.int64(), "spans": pa.list_(pa.list_(pa.int64())), "items": pa.list_(pa.string())}
FOUND_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(T.StringType()))]


def finder(docs: DataFrame, automaton: DataFrame | None) -> Callable[[bytes | None], tuple[int, list[tuple[int, int]], list[str | None]]]:
    """For executors: number of words, spans and items of a text, by one automaton (None: nothing matches).  It is broadcast: a few hundred bytes for each of its words."""
    row = automaton.first() if automaton is not None else None
    sent = docs.sparkSession.sparkContext.broadcast(pickle.loads(bytes(row.automaton)) if row else None)

    def find(text: bytes | None) -> tuple[int, list[tuple[int, int]], list[str | None]]:
        words, a = words_of(text), sent.value
        spans, items = matches(a, words) if a else ([], set())
        return len(words), spans, in_text_order({a.items[k] for k in items}) if items else []

    return find


def searched(docs: DataFrame, automaton: DataFrame | None, hits_only: bool = False) -> DataFrame:
    """docs with n_words, spans and items by one automaton."""
    find = finder(docs, automaton)
    names = docs.columns
    at = names.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 128):
            found = zip(*(find(t) for t in utf8(b.column(at))))
            out = pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, t) for c, t in zip(found, FOUND.values()))], names=[*names, *FOUND])
            yield out.filter(pc.greater(pc.list_value_length(out.column(len(names) + 1)), 0)) if hits_only else out

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, *FOUND_FIELDS]))


def in_text_order(items: Iterable[str | None]) -> list[str | None]:
    return sorted(items, key=lambda i: (i is None, i or ""))


def located(docs: DataFrame, found: list[DataFrame]) -> DataFrame:
    """docs (doc_id, text and columns named own0, own1, ...) with n_words, spans and items, by all automata.

    A benchmark that one automaton holds is found in one pass without any shuffle.  Else each pass over the texts finds what
    one automaton holds, of bounded size, and leaves the documents it hit; spans are combined by doc_id and text.
    """
    if len(found) <= 1:
        return searched(docs, found[0] if found else None)
    key = ["doc_id", "text_hash"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    hits = [stored(searched(keyed, a, True).drop("text", "n_words"), "hits").distinct() for a in found]
    hits = reduce(DataFrame.unionByName, hits).groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    rows = searched(docs, None).drop("spans", "items").withColumn("text_hash", F.xxhash64("text"))
    both = null_safe(rows, hits, key).drop("text_hash")
    at = both.columns.index("spans")

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [merged([(x, y) for x, y in s or []]) for s in b.column(at).to_pylist()]
            items = [in_text_order(set(i or [])) for i in b.column(at + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(spans, FOUND["spans"]), pa.array(items, FOUND["items"])], names=b.schema.names)

    return both.mapInArrow(combined, both.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Spans of each document that benchmark windows cover, and the items they are of.

    doc_id, n_words, spans (array of [from, to) word numbers, merged) and items (array of item_id as string, sorted, a null
    one last): one row for each row of docs.  A window is `window` consecutive words of an item; a shorter item with words
    is one window.  Null texts and texts without words match nothing; items without words and an empty benchmark match
    nothing; repeated items are found alike, those without an id as one; other columns are left out.
    """
    return located(docs.select("doc_id", "text"), automata(benchmark, window)).drop("text")


def contamination_summary(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row of docs, from contamination().

    Items without an id count in n_items, as one, and add nothing to items_sha256.
    """
    found = contamination(docs, benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without these words, the separators between them included; what is left and right is joined by a blank."""
    clean = text.translate(WORDS)
    places, parts, at, end = [], [], 0, 0
    for w in clean.split():
        start = clean.index(w, end)
        end = start + len(w)
        places.append((start, end))
    for a, b in spans:
        parts.append(text[at : places[a][0]].rstrip(b" "))
        at = places[b - 1][1]
    parts.append(text[at:].lstrip(b" "))
    return b" ".join(p for p in parts if p)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """docs without benchmark passages: spans under windows go; documents of which they cover over max_coverage go whole.

    Columns stay as they are and may have any names; n_chars, if there, follows the text.  Other documents, null and empty
    texts included, are untouched; repeated rows are treated alike; an empty table stays empty.
    """
    mine, restore = set_aside(docs, "doc_id", "text", "n_chars")
    names = mine.columns
    at = names.index("text")

    def clean(b: pa.RecordBatch, spans: list[list[Sequence[int]]], n_words: list[int]) -> pa.RecordBatch:
        keep = [sum(y - x for x, y in s) <= max_coverage * n for s, n in zip(spans, n_words)]
        hit = [i for i, s in enumerate(spans) if s and keep[i]]
        cols = b.columns[: len(names)]
        if hit:
            texts = utf8(cols[at])
            for i in hit:
                texts[i] = without_spans(texts[i], spans[i])
            cols[at] = pa.array(texts, pa.binary()).cast(cols[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                n_chars = cols[k].to_pylist()
                for i in hit:
                    n_chars[i] = len(texts[i].decode())
                cols[k] = pa.array(n_chars, cols[k].type)
        return pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep, pa.bool_()))

    found = automata(benchmark, window)
    if len(found) <= 1:  # found and cut in one pass
        find = finder(docs, found[0] if found else None)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in chunks(batches, 128):
                n_words, spans, _ = zip(*(find(t) for t in utf8(b.column(at))))
                yield clean(b, spans, n_words)

        return restore(mine.mapInArrow(cut, mine.schema))

    def cut_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 128):
            yield clean(b, b.column(b.schema.get_field_index("spans")).to_pylist(), b.column(b.schema.get_field_index("n_words")).to_pylist())

    return restore(located(mine, found).mapInArrow(cut_found, mine.schema))
