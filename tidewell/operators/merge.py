"""Merges with a table by unique keys: insert or ignore, insert or replace, plain insert.

A row with a null in a key never conflicts on that key.  All decisions are aggregates and joins on keys with
map-side combining, so a key that holds much of a batch is not sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.plans.shared import shared_dir

#: Order of the rows of a batch: a column that callers may give; added where they don't.
ORDINAL = "tw_ordinal"


@dataclass(frozen=True)
class Merged:
    """appended: rows to add.  kept: rows of the target that stay (all of them but for replace)."""

    appended: DataFrame
    kept: DataFrame


def with_ordinal(batch: DataFrame) -> DataFrame:
    return batch if ORDINAL in batch.columns else batch.withColumn(ORDINAL, F.monotonically_increasing_id())


def complete(keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def one_for_each(batch: DataFrame, keys: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row by ORDINAL of each key; rows with a null in the key all stay."""
    pick = F.max_by if last else F.min_by
    whole = F.struct(*batch.columns)
    once = batch.filter(complete(keys)).groupBy(*keys).agg(pick(whole, ORDINAL).alias("tw_row")).select("tw_row.*")
    return once.unionByName(batch.filter(~complete(keys)))


def without(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in table; a null never matches."""
    return rows.join(table.select(*keys).distinct(), keys, "left_anti")


def first_of_two_keys(batch: DataFrame, keys: list[list[str]]) -> DataFrame:
    """Rows that a pass in order would insert under several unique keys.

    In each round rows that come first in all of their keys are taken, and rows that conflict with them go;
    the rest goes on.  That gives what one pass row by row would, in as many rounds as conflicts are chained.
    Each round is checkpointed, so plans don't grow from round to round.
    """
    shared_dir(batch.sparkSession)
    left, taken = batch, []
    while True:
        marked = left
        for i, k in enumerate(keys):
            first = left.filter(complete(k)).groupBy(*k).agg(F.min(ORDINAL).alias(f"tw_first{i}"))
            marked = marked.join(first, k, "left")
        wins = reduce(Column.__and__, (F.coalesce(F.col(f"tw_first{i}") == F.col(ORDINAL), F.lit(True)) for i in range(len(keys))))
        marked = marked.withColumn("tw_wins", wins).select(*batch.columns, "tw_wins").checkpoint()
        won = marked.filter("tw_wins").drop("tw_wins")
        rest = marked.filter("not tw_wins").drop("tw_wins")
        taken.append(won)
        for k in keys:
            rest = without(rest, won, k)
        rest = rest.checkpoint()
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, taken)
        left = rest


def insert_ignore(target: DataFrame | None, batch: DataFrame, keys: list[list[str]]) -> Merged:
    """First wins: against the table and inside the batch, for each of the unique keys."""
    batch = with_ordinal(batch)
    if target is not None:
        for k in keys:
            batch = without(batch, target, k)
    new = one_for_each(batch, keys[0]) if len(keys) == 1 else first_of_two_keys(batch, keys)
    return Merged(new.drop(ORDINAL), target if target is not None else new.drop(ORDINAL).limit(0))


def insert_replace(target: DataFrame | None, batch: DataFrame, keys: list[list[str]]) -> Merged:
    """Last wins: the batch's last row of a key takes the place of the table's."""
    (key,) = keys
    new = one_for_each(with_ordinal(batch), key, last=True).drop(ORDINAL)
    return Merged(new, without(target, new, key) if target is not None else new.limit(0))


def insert_fail(target: DataFrame | None, batch: DataFrame, keys: list[list[str]]) -> Merged:
    """All rows are added; a conflict on a declared key raises."""
    batch = batch.drop(ORDINAL)
    for k in keys:
        both = batch.select(*k) if target is None else batch.select(*k).unionByName(target.select(*k))
        if not both.filter(complete(k)).groupBy(*k).count().filter("count > 1").isEmpty():
            raise ValueError(f"unique key {', '.join(k)} is violated")
    return Merged(batch, target if target is not None else batch.limit(0))


POLICIES = {"ignore": insert_ignore, "replace": insert_replace, "fail": insert_fail}


def accounting(batch: DataFrame, appended: DataFrame) -> DataFrame:
    """fetched, inserted and duplicates of a merge, as one row."""
    n = batch.agg(F.count("*").alias("fetched")).join(appended.agg(F.count("*").alias("inserted")))
    return n.withColumn("duplicates", F.col("fetched") - F.col("inserted"))
