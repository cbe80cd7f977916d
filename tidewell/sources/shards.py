"""Gzip shards of lines as a Spark data source: several tasks read one shard, and a reader goes on from inside of it.

A shard is gzip members one after the other.  It is cut into ranges of compressed bytes; a range's members are those that start in
it.  Members are found by their first bytes and are taken only if they unpack to a right checksum, so no index is needed.
A line may go over members: it belongs to the range that has the byte before it.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

LINES = "path string, at long, value string, error string"
# The first bytes of a gzip member.
MAGIC = b"\x1f\x8b\x08"
#: Compressed bytes of a range, about; compressed bytes read and unpacked bytes held at once.
RANGE, PIECE, HELD = 8 << 20, 1 << 16, 4 << 20
#: Bytes of a file that are buffered; compressed bytes that a member is first tried with, as many members have no more; bytes of lines that are rows together, about.
BUFFER, FIRST, TOGETHER = 1 << 20, 1 << 11, 1 << 20


def store_of(path: str) -> tuple[Any, str]:
    """The file system of a path, of any kind that Arrow knows, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


class Member:
    """One gzip member at an offset of a file; `end` is known once all its data were read."""

    def __init__(self, f: Any, at: int) -> None:
        self.f, self.at, self.end = f, at, -1

    def data(self) -> Iterator[bytes]:
        self.f.seek(self.at)
        raw, d = self.f.read(FIRST), zlib.decompressobj(31)
        try:
            out = d.decompress(raw, HELD)
        except zlib.error:  # found again below, where lines before it count
            pass
        else:
            if d.eof:
                self.end = self.at + len(raw) - len(d.unused_data)
                if out:
                    yield out
                return
        self.f.seek(self.at)
        d, pos = zlib.decompressobj(31), self.at
        while not d.eof:
            raw = self.f.read(PIECE)
            if not raw:
                raise EOFError(f"the gzip member at byte {self.at} is cut off")
            pos += len(raw)
            while raw and not d.eof:
                if out := d.decompress(raw, HELD):
                    yield out
                raw = d.unconsumed_tail
        self.end = pos - len(d.unused_data)

    def skip(self) -> int:
        for _ in self.data():
            pass
        return self.end


def follows(f: Any, at: int) -> int | None:
    """Where the member after one that ends at `at` starts; None at the end of the file.  Zeros may fill up a file."""
    f.seek(at)
    head = f.read(len(MAGIC))
    if head == MAGIC:
        return at
    while head and not head.strip(b"\0"):
        head = f.read(PIECE)
    if head:
        raise ValueError(f"no gzip member at byte {at}")
    return None


def candidates(f: Any, lo: int, hi: int) -> Iterator[int]:
    at = lo
    while at < hi:
        f.seek(at)
        raw = f.read(min(1 << 20, hi - at + len(MAGIC) - 1))
        p = raw.find(MAGIC)
        while p >= 0:
            yield at + p
            p = raw.find(MAGIC, p + 1)
        at += max(len(raw) - len(MAGIC) + 1, 1)


def is_member(f: Any, at: int) -> bool | None:
    """Whether a member starts here; None if it may: what starts here is cut off by the end of the file, or something else follows it."""
    member = Member(f, at)
    try:
        member.skip()
        follows(f, member.end)
    except zlib.error:
        return False
    except (EOFError, ValueError):
        return None
    return True


def chained(f: Any, at: int) -> bool:
    """Whether the members before `at` end there, from the nearest one that is surely whole."""
    back = at
    while back > 0:
        back = max(0, back - RANGE)
        start = 0 if back == 0 else next((p for p in candidates(f, back, at) if is_member(f, p)), None)
        while start is not None and start < at:
            start = follows(f, Member(f, start).skip())
        if start is not None or back == 0:
            return start == at
    return at == 0


def first_member(f: Any, lo: int, hi: int, size: int) -> int | None:
    """The first member that starts from lo to hi - 1."""
    if lo == 0:
        return 0 if size else None
    for at in candidates(f, lo, hi):
        good = is_member(f, at)
        if good or good is None and chained(f, at):
            return at
    return None


def blocks(f: Any, lo: int, hi: int, size: int) -> Iterator[tuple[int, bytes]]:
    """The lines of a range, in blocks of whole lines, with where the member that ends a block starts."""
    at = first_member(f, lo, hi, size)
    skip, rest = lo > 0, []  # the line that is open at a range's start is the earlier range's
    while at is not None:
        if at >= hi and skip:
            return
        member = Member(f, at)
        for data in member.data():
            if skip:
                p = data.find(b"\n")
                if p < 0:
                    continue
                data, skip = data[p + 1 :], False
            p = data.find(b"\n") if at >= hi else data.rfind(b"\n")  # beyond the range, one line is still its own
            if p < 0:
                rest.append(data)
                continue
            yield at, b"".join([*rest, data[: p + 1]])
            if at >= hi:
                return
            rest = [data[p + 1 :]]
        at = follows(f, member.end)
    if last := b"".join(rest):
        yield lo, last


def batch_of(path: str, at: int, block: bytes) -> pa.RecordBatch:
    return rows_of(path, [(at, block)])


def rows_of(path: str, some: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """Rows of the lines of blocks; only the last block may lack its last line's end."""
    block = b"".join(data for _, data in some)
    lines = block.decode(errors="replace").split("\n")
    if not lines[-1]:
        lines.pop()
    if b"\r" in block:
        lines = [x.removesuffix("\r") for x in lines]
    n = len(lines)
    at = [x for x, data in some for _ in range(data.count(b"\n") + (not data.endswith(b"\n")))]
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(path, pa.string()), n), pa.array(at, pa.int64()), pa.array(lines, pa.string()), pa.nulls(n, pa.string())], names=["path", "at", "value", "error"])


def grouped(found: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    """Blocks in lists of about TOGETHER bytes, so that small members don't make a batch of rows each.  Those before an error come first."""
    some, n = [], 0
    try:
        for at, block in found:
            some.append((at, block))
            n += len(block)
            if n >= TOGETHER:
                yield some
                some, n = [], 0
    except (OSError, EOFError, ValueError, zlib.error):
        if some:
            yield some
        raise
    if some:
        yield some


@dataclass
class Ranges(InputPartition):
    """Ranges (path, lo, hi, size) that one task reads."""

    ranges: list[tuple[str, int, int, int]]


def read_ranges(part: Ranges) -> Iterator[pa.RecordBatch]:
    """Rows of a task's ranges; what can't be unpacked gives one row, with error, where its range starts, after the lines before it."""
    for path, lo, hi, size in part.ranges:
        try:
            store, name = store_of(path)
            with io.BufferedReader(store.open_input_file(name), BUFFER) as f:
                for some in grouped(blocks(f, lo, hi, size)):
                    yield rows_of(path, some)
        except (OSError, EOFError, ValueError, zlib.error) as e:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([lo], pa.int64()), pa.nulls(1, pa.string()), pa.array([f"{type(e).__name__}: {e}"])], names=["path", "at", "value", "error"])


def cut(path: str, size: int, start: int = 0, most: int = RANGE) -> list[tuple[str, int, int, int]]:
    """Ranges of a file from a byte on."""
    return [(path, lo, min(lo + most, size), size) for lo in range(start, size, most)]


def packed(ranges: list[tuple[str, int, int, int]], most: int = RANGE) -> list[Ranges]:
    """Ranges in tasks of about so many bytes, so small files share one."""
    out: list[Ranges] = []
    left = 0
    for r in ranges:
        if r[2] - r[1] > left:
            out.append(Ranges([]))
            left = most
        out[-1].ranges.append(r)
        left -= r[2] - r[1]
    return out


class ShardReader(DataSourceReader):
    def __init__(self, ranges: list[tuple[str, int, int, int]], most: int) -> None:
        self.ranges, self.most = ranges, most

    def partitions(self) -> list[Ranges]:
        return packed(self.ranges, self.most) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return read_ranges(partition)


class ShardStream(DataSourceStreamReader):
    """Shards of a folder as they land: each is read once, whole, by its name.  An offset is the names that were there, with their sizes."""

    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder.rstrip("/"), most

    def initialOffset(self) -> dict[str, int]:
        return {}

    def latestOffset(self) -> dict[str, int]:
        from pyarrow import fs

        store, name = store_of(self.folder)
        found = store.get_file_info(fs.FileSelector(name, allow_not_found=True))
        return {x.base_name: x.size for x in sorted(found, key=lambda x: x.base_name) if x.is_file and not x.base_name.startswith((".", "_"))}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Ranges]:
        new = [r for name, size in end.items() if name not in start for r in cut(f"{self.folder}/{name}", size, 0, self.most)]
        return packed(new, self.most) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return read_ranges(partition)

    def commit(self, end: dict[str, int]) -> None:
        """Nothing to let go: the offsets in the query's checkpoint say what was read."""


class Cdx(DataSource):
    """spark.read.format("cdx"): lines of gzip shards (path, at: the member's byte, value, error).

    Options: path (one file, or the folder of a stream) or paths (a JSON list), ranges (a JSON list of path, first and last byte
    in place of whole files), range_bytes.  A stream takes shards that land.
    """

    @classmethod
    def name(cls) -> str:
        return "cdx"

    def schema(self) -> str:
        return LINES

    def _most(self) -> int:
        return int(self.options.get("range_bytes") or RANGE)

    def reader(self, schema: Any) -> ShardReader:
        if "ranges" in self.options:
            return ShardReader([tuple(r) for r in json.loads(self.options["ranges"])], self._most())
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        sized = [(p, store.get_file_info(name).size or 0) for p in paths for store, name in [store_of(p)]]
        return ShardReader([r for p, n in sized for r in cut(p, n, 0, self._most())], self._most())

    def streamReader(self, schema: Any) -> ShardStream:
        return ShardStream(self.options["path"], self._most())
