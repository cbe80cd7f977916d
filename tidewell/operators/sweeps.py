"""Target selection, budgets and cursors of collection runs, as relational operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def like_prefix(c: Column | str, prefix: str) -> Column:
    """Starts with prefix, ASCII case aside; an empty prefix takes all that aren't null."""
    c = F.col(c) if isinstance(c, str) else c
    safe = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return c.ilike(safe + "%") if prefix else c.isNotNull() | F.lit(True)


def keyset_page(rows: DataFrame, key: str, after: int, n: int) -> DataFrame:
    """The next n rows after a key, in its order."""
    return rows.filter(F.col(key) > after).orderBy(key).limit(n)


def page_targets(index: DataFrame, pages: DataFrame, mime: str = "text/html", after: int = 0, n: int = 256) -> DataFrame:
    """Index rows of good captures without a page yet, from a cursor on."""
    good = index.filter((F.col("status") == 200) & F.col("filename").isNotNull() & F.col("length").isNotNull() & F.col("offset").isNotNull() & like_prefix("mime", mime))
    todo = good.join(pages.select(F.col("index_id").alias("id")), "id", "left_anti")
    return keyset_page(todo, "id", after, n)


def refresh_targets(entities: DataFrame, snapshots: DataFrame, key: str, seen_key: str, seen_at: str, cutoff: Column, after: int = 0, n: int = 1000) -> DataFrame:
    """Entities without a snapshot newer than cutoff; the time filter comes before the anti-join."""
    fresh = snapshots.filter(F.col(seen_at) > cutoff).select(F.col(seen_key).alias(key))
    return keyset_page(entities.join(fresh, key, "left_anti"), key, after, n)


def file_refs(urls: DataFrame, url: str = "url") -> DataFrame:
    """url, name, kind and stamp of data files by their names; kind '' for others."""
    name = F.element_at(F.split(url, "/"), -1)
    out = urls.select(F.col(url).alias("url"), name.alias("name"))
    lower = F.lower("name")
    kind = F.when(lower.contains(".mentions."), "mentions").when(lower.contains(".export."), "export").when(lower.contains(".gkg."), "gkg").otherwise("")
    return out.withColumn("kind", kind).withColumn("stamp", F.regexp_extract("name", r"^([0-9]{14})", 1))


def select_files(files: DataFrame, kinds: list[str], after: str = "", since: str | None = None, until: str | None = None, most: int = 0) -> DataFrame:
    """Files of the wanted kinds after a stamp and between two (both inclusive), by stamp and kind; at most `most` if that isn't 0."""
    wanted = [k.strip().lower() for k in kinds]
    out = files.filter(F.col("kind").isin(wanted) & (F.col("stamp") > after))
    out = out.filter(F.col("stamp") >= since) if since else out
    out = out.filter(F.col("stamp") <= until) if until else out
    out = out.orderBy("stamp", "kind", "url")
    return out.limit(most) if most else out


def not_collected(files: DataFrame, collected: DataFrame) -> DataFrame:
    return files.join(collected.select("url"), "url", "left_anti")


def chunks(rows: DataFrame, key: str, size: int) -> DataFrame:
    """chunk and ids: keys in order in runs of size (the key must be unique).

    Ranks come from a sort by range and offsets of its partitions, so no task orders all keys.
    """
    at = rows.select(key).repartitionByRange(key).sortWithinPartitions(key).withColumn("tw_at", F.monotonically_increasing_id())
    part, inside = F.shiftright("tw_at", 33), F.col("tw_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = at.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    ranked = at.withColumn("part", part).join(F.broadcast(starts), "part")
    chunk = F.floor((F.col("start") + inside) / size)
    return ranked.groupBy(chunk.cast("long").alias("chunk")).agg(F.sort_array(F.collect_list(key)).alias("ids"))


def contiguous_cursor(rows: DataFrame, key: str, failed: Column, default: int = 0) -> DataFrame:
    """One row, cursor: the last key before the first failed one."""
    bad = F.min(F.when(failed, F.col(key)))
    limit = rows.agg(bad.alias("stop"))
    done = rows.join(F.broadcast(limit), F.col("stop").isNull() | (F.col(key) < F.col("stop")))
    return done.agg(F.coalesce(F.max(key), F.lit(default)).alias("cursor"))


def budget(rows: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first `most` rows in order, before any dedup; all for 0."""
    return rows.orderBy(*order).limit(most) if most else rows


def latest_runs(runs: DataFrame, states: DataFrame) -> DataFrame:
    """The latest run of each source with its saved state ('' without one), by source."""
    last = runs.groupBy("source").agg(F.max("id").alias("id"))
    return runs.join(last, ["source", "id"]).join(states.select("source", "state"), "source", "left").withColumn("state", F.coalesce("state", F.lit(""))).orderBy("source")


def throughput(runs: DataFrame, seconds: Column) -> DataFrame:
    """records_s and mb_s of runs; times under a millisecond count as one."""
    s = F.greatest(seconds, F.lit(0.001))
    return runs.withColumn("records_s", F.col("records") / s).withColumn("mb_s", F.col("bytes") / s / F.lit(float(1 << 20)))
