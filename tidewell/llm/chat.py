"""Chat formatting by quotation linking: quoted passages are joined to the messages they come from.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import in_order, look_up, stored

#: Quote marks at the start of a line, blanks between them allowed; one blank after them belongs to them.
MARKS = r"^(?:[ \t]*>)+ ?"
#: A line that introduces a quote: it ends in "wrote:" and quoted lines follow.
INTRODUCES = r"(?i)\bwrote:\s*$"


@dataclass(frozen=True)
class Template:
    """Text of a turn in the chat format."""

    head: str = "<|"
    mid: str = "|>\n"
    tail: str = "\n"


def parsed_lines(text: Column) -> Column:
    """Lines as (level, body): the number of quote marks and what follows them."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", ""))
    return F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))


def own_lines(lines: Column) -> Column:
    """Bodies of the lines that aren't quotes, without the lines that introduce quotes."""
    quoted_next = lambda i: F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(INTRODUCES) & quoted_next(i)))
    return F.transform(own, lambda x: x["body"])


def normalised(body: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(body, r"\s+", " ")))


def passages(lines: DataFrame) -> DataFrame:
    """rank, conv_id, level, h1, h2 (128 bits of hash) and chars of each line and each passage that has words.

    A passage is a run of lines of one level without an empty line; its words are joined by blanks, so other line breaks don't matter.
    """
    order = Window.partitionBy("tw_rank").orderBy("at")
    line = lines.withColumn("norm", normalised("body"))
    fresh = (F.col("norm") == "") | (F.lag("norm").over(order) == "") | (F.lag("level").over(order) != F.col("level"))
    line = line.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int")).withColumn("block", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).filter("norm <> ''")
    block = line.groupBy("tw_rank", "conv_id", "level", "block").agg(F.sort_array(F.collect_list(F.struct("at", "norm"))).alias("parts"))
    block = block.filter(F.size("parts") > 1).select("tw_rank", "conv_id", "level", F.array_join(F.transform("parts", lambda p: p["norm"]), " ").alias("norm"))
    both = line.select("tw_rank", "conv_id", "level", "norm").unionByName(block)
    return both.select("tw_rank", "conv_id", "level", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"), F.length("norm").cast("long").alias("chars"))


def depths(parents: DataFrame) -> DataFrame:
    """tw_rank and depth for rows tw_rank, parent (null at a root): pointers double until all reach their roots.

    A message that many others point to is looked up by broadcast, so they needn't meet in one task.
    """
    now = stored(parents.select("tw_rank", F.col("parent").alias("up"), F.col("parent").isNotNull().cast("long").alias("depth")), "depths")
    while not now.filter("up is not null").isEmpty():
        asked = now.filter("up is not null").groupBy("up").agg(F.count("*").alias("n"))
        to = now.select(F.col("tw_rank").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more")).join(asked, "up")
        further = look_up(now, stored(to, "pointers"), "up", "n", max(now.count(), 1))
        now = stored(further.select("tw_rank", F.col("further").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "depths")
    return now.drop("up")


def link_quotes(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Messages without quotes, linked to what they quote, in reply order: one row for each row of conversations.

    conv_id, turn, role, position (in the conversation, by turn), reply_to (position of the message replied to, null for the first),
    depth (replies above it), reply_order (by depth, then position: no reply before what it answers), n_quotes (quoted
    lines and passages with words), n_linked (those found in an earlier message of the conversation), text (without quotes and
    the lines that introduce them) and formatted (the turn in chat format).

    Quoted lines and passages are normalised (white space, case), hashed and joined to the earliest message that has them
    as its own.  A message replies to the one that most characters of its outermost quotes come from (the latest of equal
    ones), or else to the message before it.  Null texts are empty; null conv_ids are one conversation; turns that tie or are
    null (first) go on by role and text; repeated rows are messages of their own; other columns are left
    out; an empty table gives an empty result.  No group of a hot conversation, passage or message meets in one task.
    """
    kept = conversations.select("conv_id", "turn", "role", "text")
    kept = kept.withColumns({"tw_1": F.xxhash64("role", "text"), "tw_2": F.xxhash64("text", "role")})
    rows = in_order(kept, [F.col(c) for c in ("conv_id", "turn", "tw_1", "tw_2")], label="messages").drop("tw_1", "tw_2")
    lines = parsed_lines(F.col("text"))
    rows = stored(rows.select("conv_id", "turn", "role", "tw_rank", lines.alias("lines")), "lines")
    quotes_some = F.max(F.exists("lines", lambda x: x["level"] > 0)).alias("quoting")
    firsts = rows.groupBy("conv_id").agg(F.min("tw_rank").alias("first"), F.count("*").alias("n"), quotes_some)
    rows = look_up(rows, stored(firsts, "firsts"), "conv_id", "n", max(rows.count(), 1))
    exploded = rows.filter("quoting").select("tw_rank", "conv_id", F.posexplode("lines").alias("at", "x")).select("tw_rank", "conv_id", "at", "x.level", "x.body")
    found = passages(exploded).select("tw_rank", "level", "chars", F.struct("conv_id", "h1", "h2").alias("what"))
    found = stored(found, "passages")
    quoted = F.count(F.when(F.col("level") > 0, 1))
    origins = found.groupBy("what").agg(F.min(F.when(F.col("level") == 0, F.col("tw_rank"))).alias("origin"), quoted.alias("n")).filter("origin is not null and n > 0")
    quotes = found.filter("level > 0")
    quotes = look_up(quotes, stored(origins, "origins"), "what", "n", max(quotes.count(), 1)).withColumn("origin", F.when(F.col("origin") < F.col("tw_rank"), F.col("origin")))
    counts = quotes.groupBy("tw_rank").agg(F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"))
    votes = quotes.filter("level = 1 and origin is not null").groupBy("tw_rank", "origin").agg(F.sum("chars").alias("chars"))
    linked = votes.groupBy("tw_rank").agg(F.max(F.struct("chars", "origin"))["origin"].alias("quoted"))
    out = rows.join(counts, "tw_rank", "left").join(linked, "tw_rank", "left")
    position = F.col("tw_rank") - F.col("first")
    parent = F.coalesce("quoted", F.when(position > 0, F.col("tw_rank") - 1))
    own = F.array_join(own_lines(F.col("lines")), "\n")
    out = out.select("conv_id", "turn", "role", "tw_rank", "first", "quoting", position.alias("position"), parent.alias("parent"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.trim(F.regexp_replace(own, r"\n{3,}", "\n\n")).alias("text"))
    out = stored(out, "replies")
    deep = depths(out.filter("quoting").select("tw_rank", "parent"))
    out = out.join(deep, "tw_rank", "left").withColumn("depth", F.coalesce("depth", "position"))
    out = out.withColumnRenamed("tw_rank", "rank")
    ordered = in_order(out, [F.col("first"), F.col("depth"), F.col("position")], label="replies")
    formatted = F.concat(F.lit(template.head), F.coalesce("role", F.lit("")), F.lit(template.mid), F.col("text"), F.lit(template.tail))
    return ordered.select("conv_id", "turn", "role", "position", (F.col("parent") - F.col("first")).alias("reply_to"), "depth", (F.col("tw_rank") - F.col("first")).alias("reply_order"), "n_quotes", "n_linked", "text", formatted.alias("formatted"))
