"""License scans: MinHash bands over overlapping windows find candidate templates, exact shingle containment decides.

Templates shorter than a shingle are found as they are, word by word.
DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import partitions, stored
from tidewell.llm.license_texts import TEMPLATES

@dataclass(frozen=True)
class Bands:
    """bands x rows MinHashes.  Windows that share 0.6 of their shingles with a template meet it with probability 1 - (1 - 0.6**2)**20 = 0.9999."""

    shingle: int = 5
    bands: int = 20
    rows: int = 2
    #: Share of a template's distinct shingles that the text must hold.
    least: float = 0.8

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def shingle_hashes(of: str, k: int) -> Column:
    """Hashes of all k-word shingles of an array column, in place order; none if it has fewer words."""
    parts = ", ".join(f"get({of}, i + {j})" for j in range(k))
    return F.expr(f"transform(if(size({of}) < {k}, cast(array() as array<int>), sequence(0, size({of}) - {k})), i -> xxhash64({parts}))")


def band_hashes(window: str, b: Bands) -> Column:
    """A hash of each band of the MinHash signature of an array of shingle hashes."""
    signature = f"transform(sequence(0, {b.hashes - 1}), j -> array_min(transform({window}, x -> xxhash64(x, j))))"
    rows = ", ".join(f"get(s, i * {b.rows} + {r})" for r in range(b.rows))
    return F.expr(f"transform(sequence(0, {b.bands - 1}), i -> element_at(transform(array({signature}), s -> xxhash64(i, {rows})), 1))")


def template_table(spark: SparkSession, templates: list[tuple[str, str]], b: Bands) -> DataFrame:
    """template, license_id, w (words), n (distinct shingles), step (between windows) and their hashes; as small as the list given."""
    if not templates:
        templates = [("", "")]
    given = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(name).alias("license_id"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)))
    rows = spark.range(1).select(F.explode(given).alias("t")).select("t.template", "t.license_id", words(F.col("t.text")).alias("w"))
    rows = rows.select("template", "license_id", "w", F.array_distinct(shingle_hashes("w", b.shingle)).alias("marks"))
    n = F.size("marks")
    return rows.select("template", "license_id", "w", "marks", n.alias("n"), F.greatest(F.lit(1), F.floor(n / 8)).cast("int").alias("step"))


def short_places(of: str, notices: list[list[str]]) -> Column:
    """(key, word) for each place in an array of words where one of these short notices stands; key is the notice, joined by blanks."""

    def places(k: int) -> Column:
        own = [x for x in notices if len(x) == k]
        key = lambda i: F.concat_ws(" ", *(F.get(of, i + j) for j in range(k)))
        here = lambda i: F.get(of, i).isin(sorted({x[0] for x in own})) & key(i).isin([" ".join(x) for x in own])
        at = F.filter(F.sequence(F.lit(0), F.size(of) - k), here)
        return F.when(F.size(of) >= k, F.transform(at, lambda i: F.struct(key(i).alias("key"), i.alias("word")))).otherwise(none)

    none = F.expr("cast(array() as array<struct<key:string,word:int>>)")
    return F.concat(none, *map(places, sorted({len(x) for x in notices})))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, b: Bands = Bands()) -> DataFrame:
    """doc_id, license_id, containment and word: one row for each row of docs and license whose template it holds.

    Texts are lower-cased words of ASCII letters and digits.  Windows as long as a template, an eighth of it apart, overlap
    over whole texts; those without any shingle of a template can share no MinHash and are passed over unhashed (templates'
    shingles stand in the plan as one set, so a list of some hundred thousand words is the most to give).  A window that
    shares a band with the template is verified, others aren't: containment is the share of the template's distinct shingles that lie in the
    window or one step around it; at least b.least, or there is no match.  word is the first word of the best window (the
    earliest of equal ones).  A template with fewer words than a shingle matches where the text holds all its words in a row
    (containment 1).  Templates without words, null and empty texts match nothing; repeated rows match each; other columns
    are left out.
    """
    spark = docs.sparkSession
    given = template_table(spark, TEMPLATES if templates is None else templates, b)
    table, brief = given.filter("n > 0").drop("w"), given.filter("n = 0 and size(w) > 0").select("license_id", "w").distinct()
    notices = [r.w for r in brief.select("w").distinct().collect()]
    known = [r.mark for r in table.select(F.explode("marks").alias("mark")).distinct().collect()]  # bounded by the templates given
    is_known = f"get(h, i) in ({', '.join(f'{m}L' if m > -(2**63) else f'({m + 1}L - 1L)' for m in known)})" if known else "false"
    split = docs.select("doc_id", words("text").alias("w")).select("doc_id", shingle_hashes("w", b.shingle).alias("h"), short_places("w", notices).alias("short"))
    at = F.expr(f"if(size(h) > 0, filter(sequence(0, size(h) - 1), i -> {is_known}), cast(array() as array<int>))")
    # the row's number also keeps the filter from being computed twice
    held = stored(split.select("doc_id", "h", at.alias("at"), "short", F.monotonically_increasing_id().alias("row")).filter("size(at) > 0 or size(short) > 0"), "licenses")
    shapes = table.select("n", "step", F.explode("marks").alias("mark")).distinct()
    spots = held.select("row", F.explode("at").alias("p"), "h").select("row", "p", F.expr("get(h, p)").alias("mark")).join(F.broadcast(shapes), "mark")
    spans = F.expr("sequence(cast(greatest(0, ceil((p - n + 1) / step)) as int), cast(floor(p / step) as int))")
    # dealt out by a fixed number: by their bytes these windows would be joined into a few tasks, and they cost time, not room
    spots = spots.repartition(partitions(spark), "row")
    windows = spots.select("row", "n", "step", F.explode(spans).alias("k")).distinct().join(held.select("row", "doc_id", "h"), "row")
    windows = windows.withColumn("window", F.expr("slice(h, k * step + 1, n)")).withColumn("around", F.expr("slice(h, greatest(0, (k - 1) * step) + 1, n + (if(k > 0, 2, 1)) * step)"))
    banded = windows.select("row", "doc_id", "n", "step", "k", "around", F.posexplode(band_hashes("window", b)).alias("band", "hash"))
    keys = table.select("template", "license_id", "marks", "n", F.posexplode(band_hashes("marks", b)).alias("band", "hash"))
    met = banded.join(F.broadcast(keys), ["n", "band", "hash"])
    share = F.size(F.array_intersect("marks", "around")) / F.col("n")
    verified = met.select("row", "doc_id", "license_id", share.alias("containment"), (F.col("k") * F.col("step")).cast("long").alias("word")).filter(F.col("containment") >= b.least)
    exact = held.select("row", "doc_id", F.inline("short")).groupBy("row", "doc_id", "key").agg(F.min("word").cast("long").alias("word"))
    exact = exact.join(F.broadcast(brief.select("license_id", F.concat_ws(" ", "w").alias("key"))), "key")
    verified = verified.unionByName(exact.select("row", "doc_id", "license_id", F.lit(1.0).alias("containment"), "word"))
    best = F.max(F.struct("containment", (-F.col("word")).alias("early")))
    out = verified.groupBy("row", "doc_id", "license_id").agg(best.alias("best"))
    return out.select("doc_id", "license_id", F.col("best.containment").alias("containment"), (-F.col("best.early")).alias("word"))
