"""HTML sources: sections of a newsletter page as rows, and mail bodies."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Sections(HTMLParser):
    """Anchors by the last heading before them, with the text of the block that holds them."""

    def __init__(self) -> None:
        super().__init__()
        self.section, self.rows = "", []
        self._heading: list[str] | None = None
        self._anchor: dict | None = None
        self._block: list[str] = []
        self._pending: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "h1":
            self._heading = []
        elif tag == "a":
            self._anchor = {"section": self.section, "url": dict(attrs).get("href") or "", "title": []}
        elif tag in ("p", "div", "td", "li"):
            self._flush()

    def handle_endtag(self, tag):
        if tag == "h1" and self._heading is not None:
            self.section, self._heading = " ".join("".join(self._heading).split()), None
        elif tag == "a" and self._anchor is not None:
            self._anchor["title"] = " ".join("".join(self._anchor["title"]).split())
            self._pending.append(self._anchor)
            self._anchor = None
        elif tag in ("p", "div", "td", "li"):
            self._flush()

    def handle_data(self, data):
        if self._heading is not None:
            self._heading.append(data)
        if self._anchor is not None:
            self._anchor["title"].append(data)
        self._block.append(data)

    def _flush(self):
        block = " ".join("".join(self._block).split())
        for a in self._pending:
            rest = block.split(a["title"], 1)[-1].strip() if a["title"] and len(block) > len(a["title"]) + 20 else ""
            self.rows.append((a["section"], a["title"], a["url"], rest))
        self._pending, self._block = [], []

    def close(self):
        super().close()
        self._flush()


def section_links(pages: DataFrame, key: str, column: str, min_title: int = 10) -> DataFrame:
    """key, item_no, section, title, url, description of the links of HTML pages; titles shorter than ``min_title`` are left out."""
    kind = pages.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for k, html in zip(pdf["k"], pdf["h"], strict=True):
                p = _Sections()
                p.feed(html or "")
                p.close()
                seen: set[str] = set()
                for section, title, url, text in p.rows:
                    if len(title) >= min_title and url and url not in seen:
                        seen.add(url)
                        rows.append((k, len(seen), section, title, url, text))
            yield pd.DataFrame(rows, columns=["k", "item_no", "section", "title", "url", "description"])

    schema = f"k {kind}, item_no int, section string, title string, url string, description string"
    return pages.select(F.col(key).alias("k"), F.col(column).alias("h")).mapInPandas(run, schema).withColumnRenamed("k", key)


def mail_body(part: F.Column) -> F.Column:
    """Text of a URL-safe base64 body, null if it is none."""
    std = F.translate(part, "-_", "+/")
    padded = F.concat(std, F.repeat(F.lit("="), (4 - F.length(std) % 4) % 4))
    return F.try_to_binary(padded, F.lit("base64")).cast("string")


#: Elements of an article page by preference: (tag, attribute, value); an empty attribute takes any element of the tag.
TITLE_AT = (("h1", "class", "rich_media_title"), ("h2", "id", "activity-name"), ("h1", "", ""), ("title", "", ""))
DATE_AT = (("em", "id", "publish_time"), ("span", "id", "publish_time"), ("em", "class", "publish_time"))
BODY_AT = (("div", "id", "js_content"), ("div", "class", "rich_media_content"), ("div", "id", "page-content"), ("article", "", ""), ("body", "", ""))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset(("script", "style"))


class _Page(HTMLParser):
    """Texts of the first element that each selector meets, in one pass."""

    def __init__(self, selectors) -> None:
        super().__init__(convert_charrefs=True)
        self.found: dict[tuple, list[str]] = {}
        self.wanted = set(selectors)
        self.open: list[tuple[str, list[tuple]]] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        values = dict(attrs)
        hits = []
        for s in self.wanted:
            if s[0] == tag and s not in self.found and (not s[1] or s[2] in (values.get(s[1]) or "").split()):
                self.found[s] = []
                hits.append(s)
        self.open.append((tag, hits))
        self.silent += tag in _SILENT

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.open):
            return
        while self.open:
            t, _ = self.open.pop()
            self.silent -= t in _SILENT
            if t == tag:
                break

    def handle_data(self, data):
        if self.silent:
            return
        for _, hits in self.open:
            for s in hits:
                self.found[s].append(data)


def article_pages(pages: DataFrame, key: str, column: str, clip: int = 8000, head: int = 200) -> DataFrame:
    """key, title, date_text, content, description of article pages: the first selector of each kind that the page has. Content is its non-blank
    lines, one for each text of an element, cut at ``clip`` characters (null for no limit); null pages give empty texts."""

    def first(found: dict, selectors) -> list[str]:
        return next((found[s] for s in selectors if s in found), [])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for page in pdf["h"]:
                p = _Page((*TITLE_AT, *DATE_AT, *BODY_AT))
                p.feed(page or "")
                p.close()
                lines = [ln.strip() for text in first(p.found, BODY_AT) for ln in text.split("\n")]
                content = "\n".join(ln for ln in lines if ln)
                content = content if clip is None else content[:clip]
                flat = lambda x: " ".join("".join(x).split())
                rows.append((flat(first(p.found, TITLE_AT)), flat(first(p.found, DATE_AT)), content, content[:head].replace("\n", " ")))
            out = pd.DataFrame(rows, columns=["title", "date_text", "content", "description"])
            out.insert(0, "k", pdf["k"].to_numpy())
            yield out

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("k"), F.col(column).alias("h")).mapInPandas(run, f"k {kind}, title string, date_text string, content string, description string").withColumnRenamed("k", key)
