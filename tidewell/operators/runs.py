"""Collection runs: state, budget, merge, errors and accounting around a source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.catalog import Catalog
from tidewell.operators.merge import ORDINAL, one_for_each, with_ordinal, without
from tidewell.operators.options import Options
from tidewell.operators.sweeps import latest_runs


@dataclass
class Batch:
    """A part of what a source reads, committed at once.

    rows: data by table.  marks: rows that say what was read (landed files, finished shards).  errors: error and context.
    state: what to go on from.  staged: tables whose rows come from Catalog.stage(), with their order.  A budget may cut a
    batch's rows; then neither marks nor state are saved, so the batch is read again.
    """

    rows: dict[str, DataFrame]
    state: dict[str, Any]
    errors: DataFrame | None = None
    marks: dict[str, DataFrame] = field(default_factory=dict)
    staged: frozenset[str] = frozenset()


@dataclass
class Budget:
    """Data rows that a run may still take; None: any number."""

    left: int | None = None

    def at_most(self, n: int) -> int:
        return n if self.left is None else min(n, self.left)


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    catalog: Catalog
    state: dict[str, Any]
    options: Options = field(default_factory=Options)
    run_id: int = 0
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    budget: Budget = field(default_factory=Budget)


#: Reads a source batch by batch; after each `yield` the store has what was yielded.
Collect = Callable[[Context], Iterator[Batch]]
#: Sources by name: what they read and a line about them.
SOURCES: dict[str, tuple[Collect, str]] = {}


def register(name: str, about: str) -> Callable[[Collect], Collect]:
    def add(f: Collect) -> Collect:
        if name in SOURCES:
            raise ValueError(f"source {name} is registered twice")
        SOURCES[name] = (f, about)
        return f

    return add


def cut(catalog: Catalog, rows: dict[str, DataFrame], most: int) -> tuple[dict[str, DataFrame], int, bool]:
    """The first `most` rows over all tables that a batch has and the store hasn't, how many they are, and whether these are all.

    So runs with a budget all get further in a batch over it, and the last of them ends it.
    """
    out, taken, whole = {}, 0, True
    for name, df in rows.items():
        df = with_ordinal(df)
        for k in catalog.tables[name].keys:
            df = without(df, catalog.table(name), k)
        new = catalog.stage(one_for_each_key(df, catalog.tables[name].keys).orderBy(ORDINAL).limit(most - taken + 1))
        n = new.count()
        whole &= n <= most - taken
        out[name] = new.orderBy(ORDINAL).limit(most - taken)
        taken += min(n, most - taken)
    return out, taken, whole


def one_for_each_key(df: DataFrame, keys: list[list[str]]) -> DataFrame:
    return one_for_each(df, keys[0]) if len(keys) == 1 else df


class Totals(dict[str, int]):
    def add(self, more: dict[str, int]) -> None:
        for k, v in more.items():
            self[k] = self.get(k, 0) + v


def commit(ctx: Context, source: str, batch: Batch, totals: Totals) -> bool:
    """Commits a batch, or what the budget leaves of it; whether the run goes on."""
    catalog, spark = ctx.catalog, ctx.spark
    now = F.lit(ctx.started).cast(T.TimestampType())
    stamped = lambda t, df: df.withColumns({c: v for c, v in (("collected_at", now), ("run_id", F.lit(ctx.run_id))) if c not in df.columns and c in catalog.tables[t].schema.names})
    rows = {t: stamped(t, df) for t, df in batch.rows.items()}
    marks = {t: stamped(t, df) for t, df in batch.marks.items()}
    staged, whole = set(batch.staged), True
    if ctx.budget.left is not None:
        rows = {t: df if t in staged else catalog.stage(with_ordinal(df)) for t, df in rows.items()}
        staged |= rows.keys()
        taken = sum(df.count() for df in rows.values())
        if taken > ctx.budget.left:
            some, taken, whole = cut(catalog, rows, ctx.budget.left)
            rows = rows if whole else some
        ctx.budget.left = ctx.budget.left - taken if whole else 0
    if batch.errors is not None:
        rows["_errors"] = batch.errors.select(F.lit(ctx.run_id).alias("run_id"), F.lit(source).alias("source"), now.alias("occurred_at"), "error", "context")
    if whole:
        landed = marks.get("_landed_files")
        read = landed.agg(F.count("*"), F.sum("bytes")).first() if landed is not None else (0, 0)
        totals.add({"requests": read[0], "bytes": read[1] or 0})
        rows |= marks
    counts = catalog.commit(rows, {source: json.dumps(batch.state)} if whole else None, staged=staged)
    for name, c in counts.items():
        totals.add({"errors": c["inserted"]} if name == "_errors" else {} if name.startswith("_") else {"records": c["inserted"], "duplicates": c["duplicates"]})
    return ctx.budget.left != 0


def run(catalog: Catalog, source: str, options: dict[str, Any] | None = None, max_records: int = 0, resume: bool = True) -> dict[str, Any]:
    """One run of a source, batch by batch.  Returns the run's row.

    Each batch's rows, state, errors and read files are committed together.  The row stands there as `running` from the
    start, so a crash leaves it so; at the end it is `completed`, `failed` or `cancelled` (by an interrupt).  The batches that were committed
    before a failure or an interrupt stay, and the next run goes on after them.  max_records bounds the data rows that are taken, before any
    dedup (of a batch over it, those that the store hasn't); a run that reached it is completed.  requests and bytes count the landed files that the run read.
    """
    spark = catalog.spark
    started = datetime.now(timezone.utc)
    run_id = catalog.start_run(source, started)
    state = json.loads(catalog.state(source) or "{}") if resume else {}
    totals, status = Totals(records=0, errors=0, duplicates=0, requests=0, bytes=0), "completed"
    ctx = Context(spark, catalog, state, Options(options or {}), run_id, started, Budget(max_records or None))
    try:
        for batch in SOURCES[source][0](ctx):
            if not commit(ctx, source, batch, totals):
                break
    except KeyboardInterrupt:
        status = "cancelled"
    except Exception as e:
        status = "failed"
        totals.add({"errors": 1})
        catalog.commit({"_errors": spark.createDataFrame([(run_id, source, started, str(e)[:4000], None)], catalog.tables["_errors"].schema)})
    row = {"id": run_id, "source": source, "started_at": started, "finished_at": datetime.now(timezone.utc), "status": status, **totals}
    catalog.finish_run(row)
    return row


def status(catalog: Catalog) -> DataFrame:
    """The latest run of each source and its saved state."""
    states = catalog.spark.createDataFrame(list(catalog.manifest().states.items()), "source string, state string")
    return latest_runs(catalog.table("_runs"), states)
