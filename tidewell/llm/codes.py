"""Vector code compression: product codes of integer vectors, whose nearest entries an exponion search finds exactly.

A vector is cut into equal parts, each coded by the nearest of its codebook's entries; codebooks are means in rounds.  The
search of a part starts at its entry of the round before, at distance u.  An entry as near as that one lies within 2u of
it, so only a prefix of that entry's neighbours, sorted by distance, is scanned (after Newling and Fleuret, 2016).  All
distances are squared and integer; ties go to the lower index.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import discard, look_up, stored

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Vectors whose distances are held at once.
BLOCK = 1024
#: Errors that a long can't hold are given as the largest one.
MOST = (1 << 63) - 1
#: Sums pass between tasks and driver in limbs of so many bits, so longs hold them whatever their size.
LIMB = 32


def whole(x: np.ndarray, wide: bool) -> np.ndarray:
    """floor(1024 * x) of finite numbers: int64, or Python's integers where wide."""
    x = x.astype(np.float64)
    if not wide:
        return np.floor(x * 1024).astype(np.int64)
    return np.array([1024 * int(v) if abs(v) >= 1 << 53 else math.floor(1024 * v) for v in x.ravel().tolist()], object).reshape(x.shape)


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part (entries x components each), and whether they need Python's integers."""

    books: tuple[np.ndarray, ...]
    wide: bool

    @property
    def width(self) -> int:
        """Components of a vector."""
        return sum(b.shape[1] for b in self.books)

    def digest(self) -> str:
        """SHA-256 (hex) of all components as decimals, by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


class Searcher:
    """Nearest entries of one part."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = book
        self.square = (book * book).sum(1)
        apart = self.square[:, None] + self.square[None, :] - 2 * book.dot(book.T)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.scanned = 0

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the nearest entries and squared distances, from an entry to start at for each row of x."""
        diff = x - self.book[start]
        own = (diff * diff).sum(1)
        best, least = start.copy(), own.copy()
        square = (x * x).sum(1)
        by = np.argsort(start, kind="stable")
        cuts = np.flatnonzero(np.append(True, start[by][1:] != start[by][:-1])) if len(by) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
            a = int(start[by[lo]])
            inside = np.searchsorted(self.apart[a], 4 * own[by[lo:hi]], side="right")
            rows = by[lo:hi][np.argsort(inside, kind="stable")]
            inside = np.sort(inside)
            for at in range(0, len(rows), BLOCK):
                some, most = rows[at : at + BLOCK], int(inside[at : at + BLOCK][-1])  # the block's widest prefix
                among = np.sort(self.order[a, :most])
                d = square[some, None] - 2 * x[some].dot(self.book[among].T) + self.square[among]
                first = d.argmin(1)  # the lowest index of equal ones
                best[some], least[some] = among[first], d[np.arange(len(some)), first]
                self.scanned += len(some) * most
        return best, least


def sound(vectors: DataFrame, vec_id: str, vector: str, label: str | None) -> DataFrame:
    """vec_id, vector and label of rows whose vector has neither nulls nor anything but finite numbers."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)


def parts_of(column: pa.Array, like: Codebooks) -> list[np.ndarray]:
    x = whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, like.width), like.wide)
    return np.split(x, len(like.books), axis=1)


def assigned(rows: DataFrame, books: Codebooks, errors: bool = False) -> DataFrame:
    """rows (vec_id, vector, label, code: an index for each part, a byte each) with code anew; with errors, vector is replaced by error."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    names = rows.columns
    at = {n: names.index(n) for n in ("vector", "code")}
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if errors:
        kinds.pop("vector")
        kinds["error"] = "long"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = [Searcher(b) for b in sent.value.books]
        for b in batches:
            if not b.num_rows:
                continue
            start = np.frombuffer(b"".join(b.column(at["code"]).to_pylist()), np.uint8).reshape(b.num_rows, -1).astype(np.int64)
            found = [s.nearest(x, start[:, i]) for i, (s, x) in enumerate(zip(searchers, parts_of(b.column(at["vector"]), sent.value)))]
            code = np.stack([k for k, _ in found], 1).astype(np.uint8)
            cols = dict(zip(names, b.columns)) | {"code": pa.array([c.tobytes() for c in code], pa.binary())}
            if errors:
                total = sum(d.astype(object) for _, d in found) if sent.value.wide else sum(d for _, d in found)
                cols["error"] = pa.array([min(int(v), MOST) for v in total.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([cols[n] for n in kinds], names=list(kinds))

    return rows.mapInArrow(search, ", ".join(f"{n} {k}" for n, k in kinds.items()))


def means(rows: DataFrame, books: Codebooks, limbs: int) -> Codebooks:
    """Codebooks with each entry replaced by its parts' componentwise floor(sum / count); unused ones stay.

    A task sends a row for each component that it has summed; rows are added up by key with map-side combining.
    """
    sent = rows.sparkSession.sparkContext.broadcast(books)
    names = [f"limb{i}" for i in range(limbs)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if sent.value.wide else np.int64
        total = [np.zeros((len(b), b.shape[1] + 1), kind) for b in sent.value.books]  # the last column counts
        for b in batches:
            if not b.num_rows:
                continue
            code = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            for i, x in enumerate(parts_of(b.column(0), sent.value)):
                by = np.argsort(code[:, i], kind="stable")
                keys, starts = np.unique(code[by, i], return_index=True)
                total[i][keys, :-1] += np.add.reduceat(x[by], starts, axis=0)
                total[i][keys, -1] += np.diff(np.append(starts, len(by)))
        for i, t in enumerate(total):
            used = np.flatnonzero(t[:, -1] > 0)
            if not len(used):
                continue
            t = t[used]
            cols = [np.full(t.size, i), np.repeat(used, t.shape[1]), np.tile(np.arange(t.shape[1]), len(used))]
            left = t.ravel()
            for k in range(limbs):  # floor digits: only the last may be negative
                digit = left if k == limbs - 1 else left & ((1 << LIMB) - 1)
                cols.append(digit.astype(np.int64))
                left = left >> LIMB
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["part", "entry", "place", *names])

    sums_of = rows.select("vector", "code").mapInArrow(sums, "part long, entry long, place long, " + ", ".join(f"{n} long" for n in names))
    found = sums_of.groupBy("part", "entry", "place").agg(*(F.sum(n).alias(n) for n in names)).toArrow()  # entries x components at most
    total: dict[tuple[int, int, int], int] = {}
    for r in found.to_pylist():
        total[r["part"], r["entry"], r["place"]] = sum(r[n] << (LIMB * k) for k, n in enumerate(names))
    new = [b.copy() for b in books.books]
    for i, b in enumerate(new):
        for e in range(len(b)):
            if n := total.get((i, e, b.shape[1]), 0):
                b[e] = [total[i, e, p] // n for p in range(b.shape[1])]
    return Codebooks(tuple(new), books.wide)


def train(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, DataFrame] | None:
    """Codebooks after so many rounds, and the rows (vec_id, vector, label, code) with their codes of the last one; None if no row is left.

    Rows whose vector is null or empty, or has null or non-finite components, are left out.  All vectors should be of one
    length; it is that of the least vec_id's (null ids last, then by the vector) among those that parts divides, and others are left out too.
    Codebooks start as the parts of the `entries` least; fewer rows make smaller ones.  Equal vec_ids are rows of their own.
    Each round reads and writes the rows once, in tasks of any size; what meets on the driver is the size of the codebooks.
    """
    rows = sound(vectors, vec_id, vector, label).filter(F.size("vector") % parts == 0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    width = len(first[0].vector)
    rows = rows.filter(F.size("vector") == width)
    start = rows.orderBy(*order).limit(entries).select("vector").collect()
    rows = stored(rows.withColumn("code", F.lit(bytes(parts))), "vectors")
    largest, count = rows.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))), F.count("*")).first()
    bound = 1024 * (int(largest) + 1)
    wide = 16 * (width // parts) * bound * bound >= 1 << 62 or count * bound >= 1 << 62
    x = whole(np.array([r.vector for r in start], np.float64), wide)
    books = Codebooks(tuple(np.split(x, parts, axis=1)), wide)
    limbs = -(-(bound.bit_length() + count.bit_length() + 2) // LIMB)
    for _ in range(rounds):
        coded = stored(assigned(rows, books), "vectors")
        discard(rows)
        rows, books = coded, means(coded, books, limbs)
    return books, rows


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code (two hex digits a part), error (squared distances to the entries, summed), label_error (errors of all rows of the label, nulls together) and codebooks_sha256.

    One row for each that train() takes; other columns are left out.  Errors, and sums of them, that a long can't hold
    are its largest value.  Without rows the result is empty.
    """
    trained = train(vectors, vec_id, vector, label)
    if trained is None:
        kind = vectors.schema[vec_id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    books, rows = trained
    coded = stored(assigned(rows, books, errors=True), "codes")
    discard(rows)
    most = F.lit(MOST).cast("decimal(38,0)")
    of = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"), F.count("*").alias("n"))
    out = look_up(coded, of, "label", "n", max(coded.count(), 1))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def restored(codes: DataFrame, books: Codebooks) -> DataFrame:
    """codes (columns as they are, code in hex as of compress()) with vector: the entries' components over 1024.  A null code gives null."""
    sent = codes.sparkSession.sparkContext.broadcast(tuple(np.asarray(b, np.float64) / 1024 for b in books.books))
    names = codes.columns
    at = names.index("code")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [None if c is None else np.concatenate([t[k] for t, k in zip(sent.value, bytes.fromhex(c))]) for c in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*names, "vector"])

    return codes.mapInArrow(read, codes.withColumn("vector", F.lit(None).cast("array<double>")).schema)
