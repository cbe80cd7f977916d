"""Normalisers of raw fields as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Spark's trim() alone and a plain \s know less.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def trim_u(c: Column | str) -> Column:
    """Without leading and trailing Unicode white space."""
    return trim_blanks(as_column(c))


def field(cols: Column | str, i: int) -> Column:
    """Field i of an array, trimmed; empty if there is none."""
    return F.coalesce(trim_u(F.get(as_column(cols), F.lit(i))), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(trim_u(c), F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    """'' becomes null; nothing is trimmed."""
    return F.nullif(as_column(c), F.lit(""))


def int64(c: Column | str, trim: bool = True) -> Column:
    """A base-10 integer of 64 bits, or null."""
    x = trim_u(c) if trim else as_column(c)
    return F.when(x.rlike("^[+-]?[0-9]+$"), x.try_cast("bigint"))


def float64(c: Column | str, trim: bool = True) -> Column:
    """A decimal or exponent number as double, or inf, infinity or nan; null for others and for what overflows."""
    x = trim_u(c) if trim else as_column(c)
    number = F.when(x.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), x.try_cast("double"))
    sign = F.when(x.startswith("-"), -1.0).otherwise(1.0)
    special = F.when(x.rlike("(?i)^[+-]?inf(inity)?$"), sign * F.lit(float("inf"))).when(x.rlike("(?i)^[+-]?nan$"), F.lit(float("nan")))
    return F.coalesce(F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf"))), special)


def stamp_time(c: Column | str) -> Column:
    """YYYYMMDDHHMMSS, exactly, as a UTC timestamp; null if it isn't one."""
    x = as_column(c)
    return F.when(x.rlike("^[0-9]{14}$"), F.try_to_timestamp(x, F.lit("yyyyMMddHHmmss")))


def first_non_blank(*cols: Column | str) -> Column:
    """The first that isn't blank, untrimmed; '' if all are."""
    return F.coalesce(*(F.when(trim_u(c) != "", as_column(c)) for c in cols), F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*(empty_to_null(c) for c in cols), F.lit(""))


def bool_int(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(False)).cast("int")


def at_least_zero(c: Column | str) -> Column:
    """A length, or null where it is negative (unknown)."""
    return F.when(as_column(c) >= 0, as_column(c))


def collapse(c: Column | str) -> Column:
    """Runs of Unicode white space become one blank; none at the ends."""
    return F.btrim(F.regexp_replace(as_column(c), r"(?U)\s+", " "))


def words_length(c: Column | str) -> Column:
    """Sum over words of their UTF-8 bytes plus one."""
    n = F.octet_length(collapse(c))
    return (n + F.least(n, F.lit(1))).cast("long")


def pick_link(links: Column | str) -> Column:
    """The URL of array<struct<href,rel,text>>: the first of rel alternate or none, else the first not of self or hub; '' without one."""
    url = F.transform(as_column(links), lambda k: F.struct(first_non_empty(k["href"], trim_u(F.coalesce(k["text"], F.lit("")))).alias("url"), F.coalesce(k["rel"], F.lit("")).alias("rel")))
    url = F.filter(url, lambda k: k["url"] != "")
    best = F.filter(url, lambda k: k["rel"].isin("alternate", ""))
    other = F.filter(url, lambda k: ~k["rel"].isin("self", "hub"))
    return F.coalesce(F.get(best, F.lit(0))["url"], F.get(other, F.lit(0))["url"], F.lit(""))


# The date patterns of feeds in the order they are tried, without the day of the week.
TIME_PATTERNS = [
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSSSS][.SSSSSSS][.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]XXX",
    "d MMM yy HH:mm Z",
    "d MMM yy HH:mm z",
    "yyyy-MM-dd'T'HH:mm:ssXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MMMM d, yyyy",
    "d MMMM yyyy",
]


def parse_time(c: Column | str) -> Column:
    """A feed's date by the first pattern that fits; null if none does.  Zone names count with their real offset, years of two digits from 1969 on."""
    x = F.regexp_replace(trim_u(c), r"^[A-Za-z]{3},\s*", "")

    def by(pattern: str) -> Column:
        at = F.try_to_timestamp(x, F.lit(pattern))
        return F.when(F.year(at) >= 2069, at - F.make_ym_interval(F.lit(100))).otherwise(at) if " yy " in pattern else at

    return F.coalesce(*map(by, TIME_PATTERNS))


def category_names(categories: Column | str) -> Column:
    """Names of array<struct<term,text>>, trimmed, blanks dropped."""
    names = F.transform(as_column(categories), lambda k: trim_u(first_non_blank(k["term"], k["text"])))
    return F.filter(names, lambda x: x != "")


def topic_names(nodes: Column | str) -> Column:
    """'a,b' of array<struct<topic:struct<name>>>; null without names."""
    names = F.filter(F.transform(as_column(nodes), lambda n: n["topic"]["name"]), lambda x: x.isNotNull() & (x != ""))
    return empty_to_null(F.array_join(names, ","))


def thousands(c: Column | str) -> Column:
    return F.format_number(as_column(c).cast("long"), 0)


def byte_size(c: Column | str) -> Column:
    """Bytes with a unit of 1024s: '512 B', '1.5 KB'."""
    n = as_column(c).cast("double")
    out = F.format_string("%d B", as_column(c).cast("long"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB", "PB"), 1):
        out = F.when(n >= 1024.0**power, F.format_string(f"%.1f {unit}", F.bround(n / 1024.0**power, 1))).otherwise(out)
    return out


def clock(seconds: Column | str) -> Column:
    s = as_column(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def shortened(c: Column | str, n: int = 48) -> Column:
    x = as_column(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n - 1), F.lit("…"))).otherwise(x)
