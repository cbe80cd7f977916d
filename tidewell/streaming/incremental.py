"""Incremental runs as Structured Streaming: files that land are parsed and merged once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.catalog import Catalog


def merge_stream(rows: DataFrame, catalog: Catalog, table: str, checkpoint: str, name: str, seconds: int | None = None) -> StreamingQuery:
    """Merges a stream's batches into a table.

    Batches are numbered; one that is run again after a crash changes nothing.  Without seconds the query takes what is
    there and ends; with it, it goes on at that pace.
    """

    def merge(batch: DataFrame, number: int) -> None:
        catalog.commit({table: batch}, batch=(name, number))

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def landed_text(spark: SparkSession, path: str, parse: Callable[[DataFrame], DataFrame], files: int = 1000) -> DataFrame:
    """Lines of text files as they land (gzip too), parsed; `files` files a batch at most."""
    return parse(spark.readStream.option("maxFilesPerTrigger", files).text(path))


def landed_parquet(spark: SparkSession, path: str, schema: str, files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
