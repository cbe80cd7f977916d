"""WARC archives: a Spark data source that streams records, and reads of single records by byte range."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from http.client import HTTPException, HTTPResponse
from typing import Any, BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewell.functions.html import extract_html
from tidewell.functions.scalars import at_least_zero, empty_to_null, first_non_empty
from tidewell.sources.shards import store_of

RECORD = "version string, type string, target_uri string, date string, digest string, headers map<string,string>, length long, content binary, path string, error string"


class MalformedRecord(ValueError):
    pass


def read_headers(f: BinaryIO) -> dict[str, str]:
    out: dict[str, str] = {}
    last = ""
    while (line := f.readline().decode("utf-8", errors="replace").rstrip("\r\n")) != "":
        if line[0] in " \t" and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out.setdefault(last, value.strip())
        else:
            raise MalformedRecord(f"header line {line[:80]!r}")
    return out


def records(f: BinaryIO) -> Iterator[dict[str, Any]]:
    """Records of an uncompressed stream, one in memory at a time."""
    while True:
        while (raw := f.readline()) and not raw.strip():
            pass
        if not raw:
            return
        version = raw.decode("utf-8", errors="replace").strip()
        if not version.startswith("WARC/"):
            raise MalformedRecord(f"expected a version, got {version[:80]!r}")
        headers = read_headers(f)
        try:
            length = int(headers.get("content-length", ""))
        except ValueError:
            raise MalformedRecord("no content length") from None
        if length < 0:
            raise MalformedRecord(f"content length {length}")
        content = f.read(length)
        if len(content) < length:
            raise MalformedRecord(f"a record of {length} bytes is cut off after {len(content)}")
        for _ in range(2):
            if f.readline().strip():
                raise MalformedRecord("no separator after a record")
        yield {
            "version": version, "type": headers.get("warc-type", ""), "target_uri": headers.get("warc-target-uri", "").strip("<>"), "date": headers.get("warc-date", ""),
            "digest": headers.get("warc-payload-digest", ""), "headers": headers, "length": length, "content": content,
        }


def unzipped(f: Any, offset: int = 0, length: int | None = None) -> BinaryIO:
    """An open file from an offset on, or a range of it, gunzipped if it is gzip."""
    f.seek(offset)
    raw = io.BytesIO(f.read(length)) if length is not None else io.BufferedReader(f, 1 << 16)
    head = raw.read(2)
    raw.seek(-len(head), 1)
    return gzip.GzipFile(fileobj=raw) if head == b"\x1f\x8b" else raw


RECORDS = pa.schema([
    ("version", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("digest", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("length", pa.int64()), ("content", pa.binary()),
    ("path", pa.string()), ("error", pa.string()),
])
#: Bytes of content in a batch of records, about; files of a task, and bytes of them.
BATCH_BYTES, FILES, FILE_BYTES = 8 << 20, 100, 64 << 20


def record_batches(path: str) -> Iterator[pa.RecordBatch]:
    """Records of an archive; what can't be read gives one row with error, after the records before it."""
    held: list[dict[str, Any]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([r | {"headers": list(r["headers"].items()), "path": path} for r in held], RECORDS)

    try:
        store, name = store_of(path)
        with store.open_input_file(name) as f:
            for r in records(unzipped(f)):
                held.append(r)
                size += r["length"]
                if size > BATCH_BYTES:
                    yield batch()
                    held, size = [], 0
        wrong = None
    except (OSError, ValueError, EOFError, zlib.error) as e:
        wrong = f"{type(e).__name__}: {e}"
    if held:
        yield batch()
    if wrong:
        yield pa.RecordBatch.from_pylist([{"path": path, "error": wrong}], RECORDS)


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[Files]:
        """Small files share a task: up to FILES of them, with up to FILE_BYTES."""
        out: list[Files] = []
        left = 0
        for p in self.paths:
            store, name = store_of(p)
            size = store.get_file_info(name).size or 0
            if not out or size > left or len(out[-1].paths) >= FILES:
                out.append(Files([]))
                left = FILE_BYTES
            out[-1].paths.append(p)
            left -= size
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for p in partition.paths:
            yield from record_batches(p)


class WarcSource(DataSource):
    """spark.read.format("warc").option("paths", "a.warc.gz,b.warc.gz").load(): records with their file, and a row with error where one can't be read further."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema: Any) -> WarcReader:
        return WarcReader([p.strip() for p in (self.options.get("paths") or self.options["path"]).split(",")])


class _Bytes:
    def __init__(self, data: bytes) -> None:
        self.data = data

    def makefile(self, *_: Any) -> BinaryIO:
        return io.BytesIO(self.data)


def http_response(content: bytes) -> tuple[int, str, int, bytes]:
    """Status, content type, declared length (-1 without one) and body of a raw HTTP response."""
    r = HTTPResponse(_Bytes(content))  # type: ignore[arg-type]
    r.begin()
    size = r.getheader("Content-Length", "")
    return r.status, r.getheader("Content-Type", ""), int(size) if size.isdigit() else -1, r.read()


RESPONSE = "status int, content_type string, content_length long, body binary, error string"
RESPONSES = pa.struct([("status", pa.int32()), ("content_type", pa.string()), ("content_length", pa.int64()), ("body", pa.binary()), ("error", pa.string())])
#: Records that are parsed at once.
TOGETHER = 128


def responses(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """RESPONSE of each type and content, few at a time: bodies are held for no more than those."""
    for kinds, contents in batches:
        for at in range(0, len(kinds), TOGETHER):
            rows: list[dict[str, Any]] = []
            for kind, content in zip(kinds[at : at + TOGETHER].to_pylist(), contents[at : at + TOGETHER].to_pylist()):
                try:
                    if kind != "response":
                        raise MalformedRecord(f"record type {kind!r} is not a response")
                    rows.append(dict(zip(RESPONSES.names, (*http_response(content), None))))
                except (HTTPException, ValueError) as e:
                    rows.append({"error": str(e)})
            yield pa.array(rows, RESPONSES)


def with_responses(rows: DataFrame) -> DataFrame:
    """Records with http, a struct of RESPONSE."""
    return rows.withColumn("http", F.arrow_udf(responses, RESPONSE)("type", "content"))


#: Bytes of archives that a task fetches, about; ranges nearer than GAP in a file are read at once, up to SPAN bytes.
TASK_BYTES, GAP, SPAN = 32 << 20, 64 << 10, 8 << 20


def fetch_records(targets: DataFrame, base: str, tasks: int | None = None) -> DataFrame:
    """Records of targets (index_id, crawl, url, stamp, digest, filename, offset, length) under a base path, with error.

    Targets are dealt to tasks in order of file and offset: each task opens a file once and reads ranges that lie close
    together at once.  tasks: at least so many (the session's cores without it), more where they would fetch over TASK_BYTES each.
    A record that can't be read gives a row with error.
    """
    kept = targets.select("index_id", "crawl", F.col("url").alias("index_url"), "stamp", F.col("digest").alias("index_digest"), "filename", "offset", "length")
    n, size = kept.agg(F.count("*"), F.sum(F.coalesce(F.col("length"), F.lit(0)) + GAP)).first()
    tasks = max(1, min(n, max(tasks or targets.sparkSession.sparkContext.defaultParallelism, -(-(size or 0) // TASK_BYTES))))
    order = ["filename", "offset", "index_id"]
    rows = kept.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = "index_id long, crawl string, index_url string, stamp string, index_digest string, warc_filename string, warc_offset long, type string, target_uri string, digest string, content binary, error string"
    names = [x.split()[0] for x in schema.split(", ")]

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for pdf in frames:
            for run in spans(pdf):
                rows, size, first = [], 0, run[0]
                try:
                    if first.filename != name:
                        if f is not None:
                            f.close()
                        name, f = None, None
                        store, path = store_of(f"{base}/{first.filename}")
                        name, f = first.filename, store.open_input_file(path)
                    f.seek(int(first.offset))
                    data = f.read(max(int(t.offset) + int(t.length) for t in run) - int(first.offset))
                    wrong = None
                except (OSError, ValueError) as e:
                    data, wrong = b"", f"{type(e).__name__}: {e}"
                for t in run:
                    rows.append((*t[:7], *(one_record(data, int(t.offset - first.offset), int(t.length)) if wrong is None else (None, None, None, None, wrong))))
                    size += len(rows[-1][-2] or b"")
                    if size > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)
        if f is not None:
            f.close()

    return rows.mapInPandas(fetch, schema)


def spans(targets: pd.DataFrame) -> Iterator[list[Any]]:
    """Runs of targets of one file that are near enough to be read at once; the frame is sorted by file and offset."""
    run: list[Any] = []
    end = 0
    for t in targets.itertuples(index=False):
        if run and (t.filename != run[0].filename or t.offset > end + GAP or max(end, t.offset + t.length) - run[0].offset > SPAN):
            yield run
            run, end = [], 0
        run.append(t)
        end = max(end, t.offset + t.length)
    if run:
        yield run


def one_record(data: bytes, at: int, length: int) -> tuple[Any, ...]:
    """Type, target, digest, content and error of the first record of a range."""
    try:
        r = next(records(unzipped(io.BytesIO(data[at : at + length]))), None)
    except (OSError, ValueError, EOFError, zlib.error) as e:
        return None, None, None, None, f"{type(e).__name__}: {e}"
    return (r["type"], r["target_uri"], r["digest"], r["content"], None) if r else (None, None, None, None, "no record")


def page_rows(fetched: DataFrame, store_text: bool = False, text_limit: int = 4096, collect_links: bool = True) -> DataFrame:
    """Rows of commoncrawl_pages, and error for those that failed (null for good ones).

    Bytes of a body that aren't UTF-8 count as replacement characters.
    """
    rows = with_responses(fetched)
    rows = rows.withColumn("doc", extract_html(F.make_valid_utf8(F.col("http.body").cast("string")), "target_uri", collect_links, text_limit))
    t = lambda c, a: empty_to_null(F.col(c)).alias(a)
    return rows.select(
        "index_id", t("crawl", "crawl"), first_non_empty("target_uri", "index_url").alias("url"), t("stamp", "stamp"), F.col("http.status").alias("status"), t("http.content_type", "content_type"),
        at_least_zero("http.content_length").alias("content_length"), t("doc.title", "title"), t("doc.description", "description"), t("doc.language", "language"), t("doc.canonical", "canonical_url"),
        F.size("doc.links").alias("link_count"), F.col("doc.text_length").alias("text_length"), (t("doc.text", "text") if store_text else F.lit(None).cast("string").alias("text")),
        empty_to_null(first_non_empty("digest", "index_digest")).alias("digest"), "warc_filename", "warc_offset", F.coalesce("error", "http.error").alias("error"),
    )
