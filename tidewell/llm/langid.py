"""Language identification as inference of a mixture: which languages, and how much of each, explain a document's n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import chunks, set_aside, stored

BUCKETS = 1 << 15
#: Shares up to this are nothing but rounding: such languages are taken out together.
ZERO = 1e-12
#: Steps of a fit, and of one over more than FEW languages, which only tells which of them may matter.
STEPS, FIRST_STEPS, FEW = 50, 8, 20
PLAIN = re.compile(r"[A-Za-z]")
#: What isn't a letter of ASCII or a byte of a longer character counts as a blank.
LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter of any script (categories L); numbers such as fractions and Roman ones are none."""
    return bool(text) and (PLAIN.search(text) is not None or any(map(str.isalpha, text)))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a lower-cased text between blanks."""
    b = np.frombuffer(b"  " + b" ".join(text.lower().encode().translate(LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: log P(trigram | language), languages x BUCKETS.
    logs: np.ndarray


def train(docs: DataFrame, where: Column | None = None, lang: str = "lang", most_languages: int = 200) -> Model:
    """Smoothed trigram models from all rows with a label and a text for which `where` holds.

    Tasks count for themselves and send one row for each language and trigram they saw.  A model has the most_languages
    labels with the most trigrams (of equal ones the first by code point), so BUCKETS numbers times that bound what goes
    to the driver and the executors; rarer labels, as a dirty column has them, aren't learned and never predicted.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull())
    rows = (rows if where is None else rows.filter(where)).select(F.col(lang).cast("string").alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, n in seen.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "gram", "n"])
            seen.clear()

        for b in chunks(batches):
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if has_letter(text):
                    if name not in seen:
                        if len(seen) == most_languages:
                            yield from counted()
                        seen[name] = np.zeros(BUCKETS, np.int64)
                    seen[name] += np.bincount(trigrams(text), minlength=BUCKETS)
        yield from counted()

    sums = stored(rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    top = sums.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(most_languages)
    per = sums.join(F.broadcast(top), "lang").groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("counts"))  # BUCKETS entries at most

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 16):
            flat, ends = b.column(1).flatten(), b.column(1).offsets.to_numpy()
            gram, n, ends = flat.field(0).to_numpy(), flat.field(1).to_numpy(), ends - ends[0]
            out = [np.bincount(gram[i:j], n[i:j], BUCKETS).astype(np.int64).tobytes() for i, j in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["lang", "counts"])

    found = sorted(per.mapInArrow(packed, "lang string, counts binary").collect(), key=lambda r: r.lang)
    counts = np.array([np.frombuffer(r.counts, np.int64) for r in found], float).reshape(-1, BUCKETS) + 0.5
    return Model([r.lang for r in found], np.log(counts / counts.sum(1, keepdims=True)) if found else counts)


def shares(logs: np.ndarray, n: np.ndarray, start: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float, float]:
    """The languages' shares that expectation-maximisation finds for trigram counts n, the log-likelihood, and a bound of it for any shares.

    logs: languages x distinct trigrams.  The log-likelihood is concave, so no shares have more than that of the last ones
    and the total times what their steepest language gains.
    """
    top = logs.max(0)
    p = np.exp(logs - top)
    w, total, last, most = start, n.sum(), -np.inf, np.inf
    for _ in range(steps):
        mixed = w @ p
        like = float(n @ np.log(mixed))
        gain = p @ (n / mixed) / total
        most = min(most, like + total * (float(gain.max()) - 1))
        if like - last < 1e-4 * total:
            break
        last = like
        w = w * gain
        w = w / w.sum()
    return w, like + float(n @ top), most + float(n @ top)


def mixture(model: Model, text: str, penalty: float = 1.0) -> dict[str, float]:
    """Shares of the languages of a text with letters, most first.

    The language with the least share is taken out and the shares fitted anew, until one is left; of these sets and the best single
    language the one with the best log-likelihood less penalty * log(trigrams) * sqrt(trigrams) for each language after the first wins
    (overlapping trigrams aren't independent, so the usual half a log for each language would add too many).
    Sets too large to win, by the bound of the likelihood, are passed over: down to the largest that may, half of the languages go at once.
    """
    at, n = np.unique(trigrams(text), return_counts=True)
    logs, names = model.logs[:, at], np.arange(len(model.languages))
    cost = penalty * np.log(n.sum() + 1.0) * np.sqrt(n.sum())
    alone = logs @ n
    first = int(alone.argmax())
    best: tuple[float, np.ndarray, np.ndarray] = (float(alone[first]), names[first : first + 1], np.ones(1))
    w, bound = np.full(len(names), 1 / len(names)), np.inf
    while len(names) > 1:
        w, like, most = shares(logs[names], n, w, STEPS if len(names) <= FEW else FIRST_STEPS)
        score = like - cost * (len(names) - 1)
        if score >= best[0]:
            best = (score, names, w)
        bound = min(bound, most)
        may = len(names) if cost <= 0 else 1 + int(max(bound - best[0], 0.0) // cost)
        keep = w > ZERO
        if keep.all():
            keep = np.ones(len(w), bool)
            go = max(len(names) - max(may, len(names) // 2), 1)
            keep[np.argsort(w, kind="stable")[:go]] = False
        names, w = names[keep], w[keep] / w[keep].sum()
    _, names, w = best
    return dict(sorted(((model.languages[k], float(x)) for k, x in zip(names, w)), key=lambda p: (-p[1], p[0])))


def identify(docs: DataFrame, model: Model, penalty: float = 1.0) -> DataFrame:
    """doc_id, lang_pred, score (its share) and languages (all shares): one row for each row of docs.

    Only the text decides.  A null text, one without a letter, and any text under a model without languages is `und`
    with score 0.  Ties go to the language first by code point; texts of any length are read whole; repeated rows get the
    same answer; other columns are left out.
    """
    kept = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, languages map<string,double>"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in chunks(batches):
            found = [mixture(m, t, penalty) if m.languages and has_letter(t) else {} for t in b.column(1).to_pylist()]
            name = [next(iter(x), "und") for x in found]
            score = [min(1.0, next(iter(x.values()), 0.0)) for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array([list(x.items()) for x in found], pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "languages"])

    return kept.mapInArrow(predict, schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, penalty: float = 1.0) -> DataFrame:
    """The rows of docs, columns as they are and of any names, whose text has a main language of at least this share; the others go.

    Null and empty texts and those without a letter go, as do all texts under a model without languages; each of repeated rows
    stays or goes as the text says; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    mine, restore = set_aside(docs, "text")
    at = mine.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in chunks(batches):
            good = [bool(m.languages) and has_letter(t) and next(iter(mixture(m, t, penalty).values())) >= least for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(good, pa.bool_()))

    return restore(mine.mapInArrow(keep, mine.schema))
