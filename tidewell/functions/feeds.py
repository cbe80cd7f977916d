"""RSS 2.0, RDF and Atom feeds: a lenient XML reader gives raw fields, column expressions give one shape."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from html import unescape
from html.entities import html5
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import category_names, first_non_blank, parse_time, pick_link, trim_u

LINKS = "array<struct<href:string,rel:string,text:string>>"
TEXTS = ["title", "guid", "id", "description", "summary", "encoded", "content", "pubDate", "date", "published", "updated", "creator"]
ITEM = f"struct<{','.join(f'{t}:string' for t in TEXTS)},author_name:string,author_text:string,links:{LINKS},categories:array<struct<term:string,text:string>>>"
HEAD = "title:string,description:string,language:string,updated:string"
RAW = f"error string, channel struct<{HEAD},links:{LINKS}>, root struct<{HEAD},links:{LINKS}>, items array<{ITEM}>"

# Encodings that feeds may declare.  The second set is read as Latin-1.
UTF8 = {"", "utf-8", "utf8", "us-ascii", "ascii"}
LATIN1 = {"iso-8859-1", "iso8859-1", "latin1", "latin-1", "windows-1252", "cp1252"}
_DECLARED = re.compile(rb"^\s*<\?xml[^>]*?encoding\s*=\s*[\"']([^\"']*)[\"'][^>]*\?>")
_ENTITY = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#[xX][0-9a-fA-F]+);)([A-Za-z][A-Za-z0-9]*;)?")
_NOT_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def decoded(data: bytes) -> str:
    label = m[1].decode("latin-1").strip().lower() if (m := _DECLARED.match(data)) else ""
    if label in UTF8:
        text = data.decode("utf-8-sig", errors="replace")
    elif label in LATIN1:
        text = data.decode("latin-1")
    else:
        raise ValueError(f"unsupported charset {label!r}")
    return re.sub(r"^\s*<\?xml.*?\?>", "", text, count=1, flags=re.S)


def entities(text: str) -> str:
    """HTML's entities become characters, other loose ampersands text; CDATA sections stay as they are."""
    parts = re.split(r"(<!\[CDATA\[.*?\]\]>)", text, flags=re.S)
    known = lambda m: html5.get(m[1] or "", "&amp;" + (m[1] or ""))
    return "".join(p if p.startswith("<![CDATA[") else _ENTITY.sub(known, p) for p in parts)


def local(tag: Any) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def children(e: ET.Element, name: str) -> list[ET.Element]:
    return [x for x in e if local(x.tag) == name]


def own_text(e: ET.Element) -> str:
    return (e.text or "") + "".join(x.tail or "" for x in e)


def text_of(e: ET.Element, name: str) -> str:
    found = children(e, name)
    return own_text(found[-1]) if found else ""


def links_of(e: ET.Element) -> list[dict[str, str]]:
    return [{"href": x.get("href", ""), "rel": x.get("rel", ""), "text": own_text(x)} for x in children(e, "link")]


def item_of(e: ET.Element) -> dict[str, Any]:
    author = (children(e, "author") or [ET.Element("author")])[-1]
    return {t: text_of(e, t) for t in TEXTS} | {
        "author_name": text_of(author, "name"), "author_text": own_text(author), "links": links_of(e),
        "categories": [{"term": c.get("term", ""), "text": own_text(c)} for c in children(e, "category")],
    }


_TOKEN = re.compile(r"<!--.*?-->|<!\[CDATA\[(?P<raw>.*?)\]\]>|<\?.*?\?>|<![^>]*>|<(?P<end>/?)(?P<name>[A-Za-z_][\w.-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_][\w.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>/]+)))?")


def loose_tree(text: str) -> ET.Element:
    """The tree of XML that isn't well formed: attributes may lack quotes or values, and an end tag closes all that is open inside its element.

    An end tag of nothing open, and an end of the text inside an element, are errors still.
    """
    build, names = ET.TreeBuilder(), []
    for m in _TOKEN.finditer(text):
        if names and (m["raw"] is not None or m["text"] is not None):
            build.data(m["raw"] if m["raw"] is not None else unescape(m["text"]))
        elif m["name"] and m["end"]:
            if m["name"] not in names:
                raise ValueError(f"unexpected end of {m['name']!r}")
            while (last := names.pop()) != m["name"]:
                build.end(last)
            build.end(last)
            if not names:
                break
        elif m["name"]:
            attrs = m["attrs"].rstrip()
            empty = attrs.endswith("/")
            found = {k: unescape(a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(attrs.removesuffix("/"))}
            build.start(m["name"], found)
            if empty:
                build.end(m["name"])
            else:
                names.append(m["name"])
            if not names:
                break
    if names:
        raise ValueError(f"unexpected end of the text inside {names[-1]!r}")
    if (root := build.close()) is None:
        raise ValueError("no element")
    return root


def raw_feed(data: bytes | None) -> dict[str, Any]:
    out: dict[str, Any] = {"error": None, "channel": None, "root": None, "items": None}
    try:
        text = _NOT_XML.sub("", entities(decoded(data or b"")))
        # prefixes that nothing declares are dropped: only local names count
        text = re.sub(r"(</?)[A-Za-z_][\w.-]*:([A-Za-z_])", r"\1\2", text)
        text = re.sub(r"(\s)[A-Za-z_][\w.-]*:([\w.-]+\s*=)", r"\1\2", re.sub(r"\sxmlns(:[\w.-]+)?\s*=\s*(\"[^\"]*\"|'[^']*')", "", text))
        try:
            root = ET.fromstring(text)
        except ET.ParseError as strict:
            try:
                root = loose_tree(text)
            except (ValueError, AssertionError, ET.ParseError):
                raise strict from None
    except (ET.ParseError, ValueError, UnicodeError) as e:
        return out | {"error": f"parse feed: {e}"}
    channel = (children(root, "channel") or [ET.Element("channel")])[-1]
    head = {"title": text_of(channel, "title"), "description": text_of(channel, "description"), "language": text_of(channel, "language"), "updated": text_of(channel, "lastBuildDate"), "links": links_of(channel)}
    top = {"title": text_of(root, "title"), "description": text_of(root, "subtitle"), "language": "", "updated": text_of(root, "updated"), "links": links_of(root)}
    items = children(channel, "item") + children(root, "item") + children(root, "entry")
    return out | {"channel": head, "root": top, "items": [item_of(x) for x in items]}


def _raw(data: Column | str) -> Column:
    @F.pandas_udf(RAW)
    def parse(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([raw_feed(x) for x in data], columns=["error", "channel", "root", "items"])

    return parse(data)


def normal_item(i: Column) -> Column:
    link = pick_link(i["links"])
    t = lambda *names: trim_u(first_non_blank(*(i[n] for n in names)))
    return F.struct(
        trim_u(first_non_blank(i["guid"], i["id"], link)).alias("guid"), link.alias("url"), t("title").alias("title"),
        t("author_name", "creator", "author_text").alias("author"), t("description", "summary").alias("summary"), t("encoded", "content").alias("content"),
        category_names(i["categories"]).alias("categories"),
        parse_time(first_non_blank(i["pubDate"], i["published"], i["date"])).alias("published_at"), parse_time(first_non_blank(i["updated"], i["date"])).alias("updated_at"),
    )


def _shape(r: Column) -> Column:
    both = lambda n: trim_u(first_non_blank(r["channel"][n], r["root"][n]))
    link = F.coalesce(F.nullif(pick_link(r["channel"]["links"]), F.lit("")), pick_link(r["root"]["links"]))
    return F.struct(r["error"].alias("error"), both("title").alias("title"), link.alias("link"), both("description").alias("description"), both("language").alias("language"), both("updated").alias("updated"), F.transform(r["items"], normal_item).alias("items"))


def feed_rows(feeds: DataFrame) -> DataFrame:
    """Columns url and content (binary) to url and feed (a parsed struct), parsed once for each row."""
    raw = feeds.select("url", _raw("content").alias("raw"))
    return raw.select("url", _shape(F.col("raw")).alias("feed"))


def feed_items(parsed: DataFrame) -> DataFrame:
    """A row of rss_items for each item that has a guid."""
    i = parsed.filter("feed.error is null").select(F.col("url").alias("feed_url"), F.explode("feed.items").alias("i")).filter("i.guid <> ''")
    n = lambda c: F.nullif(F.col(f"i.{c}"), F.lit(""))
    return i.select(
        F.col("feed_url").alias("feed"), F.col("i.guid").alias("guid"), *(n(c).alias(c) for c in ("url", "title", "author", "summary", "content")),
        F.nullif(F.array_join("i.categories", ", "), F.lit("")).alias("categories"), F.col("i.published_at").alias("published_at"), F.col("i.updated_at").alias("updated_at"),
    )


def feed_heads(parsed: DataFrame) -> DataFrame:
    """A row of rss_feeds for each feed that could be read; item_count counts items without guid as well."""
    n = lambda c: F.nullif(F.col(f"feed.{c}"), F.lit(""))
    return parsed.filter("feed.error is null").select("url", *(n(c).alias(c) for c in ("title", "link", "description", "language")), F.size("feed.items").cast("long").alias("item_count"))


def feed_errors(parsed: DataFrame) -> DataFrame:
    return parsed.filter("feed.error is not null").select(F.col("feed.error").alias("error"), F.col("url").alias("context"))
