"""HTML extraction: title, description, language, canonical URL, links and visible text."""

from __future__ import annotations

from functools import lru_cache
from html.parser import HTMLParser
from typing import Any
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = "title string, description string, language string, canonical string, links array<struct<href:string,rel:string,text:string>>, text string, text_length long"
# Elements whose text isn't shown, and the limits of a title (bytes) and of links.
HIDDEN = {"script", "style", "noscript", "template", "svg"}
TITLE_BYTES = 4096
MOST_LINKS = 1000
#: Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def resolve(href: str, base: str) -> str:
    """Absolute URL without a fragment; '' for what leads nowhere."""
    href = href.strip()
    if not href or href[0] == "#" or href.lower().startswith("javascript:"):
        return ""
    try:
        return urldefrag(urljoin(base, href) if base else href)[0]
    except ValueError:
        return ""


class Page(HTMLParser):
    """Collects as tags stream by; broken markup ends elements late, never early."""

    def __init__(self, base: str, collect_links: bool, text_limit: int) -> None:
        super().__init__(convert_charrefs=True)
        self.base, self.collect_links, self.text_limit = base, collect_links, text_limit
        self.title = self.description = self.language = self.canonical = ""
        self.links: list[dict[str, str]] = []
        self.anchor: dict[str, str] | None = None
        self.open: list[str] = []
        self.kept: list[str] = []
        self.kept_bytes = self.text_length = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        first: dict[str, str] = {}
        for k, v in attrs:
            first.setdefault(k.lower(), (v or "").strip())
        if tag == "html":
            self.language = self.language or first.get("lang", "")
        elif tag == "meta":
            self.meta(first)
        elif tag == "link" and first.get("rel", "").lower() == "canonical":
            self.canonical = resolve(first.get("href", ""), self.base)
        elif tag == "a" and self.collect_links:
            self.end_link()
            href = resolve(first.get("href", ""), self.base)
            self.anchor = {"href": href, "rel": first.get("rel", ""), "text": ""} if href else None
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        n = len(self.open)
        self.handle_starttag(tag, attrs)
        del self.open[n:]

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.end_link()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1] == "title":
            room = TITLE_BYTES - len(self.title.encode())
            if room > 0:
                self.title += data.encode()[:room].decode(errors="ignore")
            return
        if not HIDDEN.isdisjoint(self.open):
            return
        if self.anchor is not None:
            self.anchor["text"] += data
        for word in data.split():
            size = len(word.encode()) + 1
            self.text_length += size
            if not self.text_limit or self.kept_bytes < self.text_limit:
                self.kept.append(word)
                self.kept_bytes += size

    def meta(self, a: dict[str, str]) -> None:
        name, content = (a.get("name") or a.get("property", "")).lower(), a.get("content", "")
        if name in ("description", "og:description"):
            self.description = self.description or content
        elif name == "og:title":
            self.title = self.title or content
        elif name in ("language", "og:locale"):
            self.language = self.language or content

    def end_link(self) -> None:
        if self.anchor is not None and len(self.links) < MOST_LINKS:
            self.links.append(self.anchor | {"text": " ".join(self.anchor["text"].split())})
        self.anchor = None


def extract(html: str | None, base: str | None = None, collect_links: bool = True, text_limit: int = 4096) -> dict[str, Any] | None:
    if html is None:
        return None
    page = Page(base or "", collect_links, text_limit)
    try:
        page.feed(html)
        page.close()
    except (AssertionError, ValueError):
        pass  # what was parsed stays
    page.end_link()
    return {
        "title": " ".join(page.title.split()), "description": " ".join(page.description.split()), "language": page.language,
        "canonical": page.canonical, "links": page.links, "text": " ".join(page.kept), "text_length": page.text_length,
    }


@lru_cache
def _extractor(collect_links: bool, text_limit: int):
    @F.pandas_udf(SCHEMA)
    def run(html: pd.Series, base: pd.Series) -> pd.DataFrame:
        empty = dict.fromkeys(x.split()[0] for x in SCHEMA.replace("href:string,rel:string,text:string", "").split(", "))
        return pd.DataFrame([extract(h, b, collect_links, text_limit) or empty for h, b in zip(html, base)], columns=list(empty))

    return run


def extract_html(html: Column | str, base: Column | str | None = None, collect_links: bool = True, text_limit: int = 4096) -> Column:
    """A struct of SCHEMA.  text stops at text_limit bytes (0: none; the word that crosses it is kept), text_length counts all."""
    return _extractor(collect_links, text_limit)(html, F.lit("") if base is None else base)
