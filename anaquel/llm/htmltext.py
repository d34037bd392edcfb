"""Main text of HTML pages by the distribution of text over lines.

Markup is stripped to lines, one per block of the page. What lies in elements that are never article
text (menus, forms, adverts, comments ...) counts as length 0, and outside the article, where a page
marks one, so does everything. The text lengths are summed over sliding windows of lines; a surge point
is where the sum rises, a dive point where it falls to nothing, and the text between them stays. So do short
lines beside it in the same element. Of several elements marked as articles, one that is nothing but links stays only
if it holds a surge.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import ship

WINDOW = 3  # lines
SURGE = 80  # characters in a window from which an unmarked page's text begins
LONG = 40  # characters of the first and last line of a passage of an unmarked page
LINKED = 0.5  # share of linked text from which a line is a menu

# HTML elements by kind.
_RAW = ("script", "style", "noscript", "template", "title", "textarea", "svg", "math", "iframe",
        "object", "canvas", "audio", "video", "map", "datalist", "select")
_NEVER = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"))
_BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu",
    "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
    "ul", "button",
))
_VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed",
                   "source", "track", "wbr"))
_ONCE = frozenset(("p", "li", "dd", "dt", "td", "th", "tr", "option"))  # the next one closes it
# Words in class, id or role that mark what is not the article.
_MARKS = frozenset((
    "ad", "ads", "adsbox", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "dialog", "disclaimer", "disqus", "footer", "gdpr",
    "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "pager", "pagination", "paywall", "popup", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social",
    "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "warning", "widget",
))
# Words that stand beside such a mark in a name and say where or how, not what about.
_BESIDE = frozenset((
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "clearfix",
    "col", "column", "container", "content", "fixed", "float", "form", "global", "group", "header", "hidden",
    "icon", "icons", "inline", "inner", "item", "items", "js", "large", "left", "link", "links", "list", "main",
    "mobile", "outer", "overlay", "page", "panel", "post", "posts", "primary", "right", "row", "secondary",
    "section", "site", "slot", "small", "sticky", "stories", "story", "text", "thread", "top", "unit", "wrap",
    "wrapper", "you", "may", "also", "like", "more", "read", "up", "to", "us",
))
_MARKED_HEADERS = frozenset(("header",))
_ARTICLE = frozenset(("main", "articlebody"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in _RAW}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z0-9]+")
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)|display\s*:\s*none", re.I)


def _role(name: str, attributes: str, in_article: bool) -> str:
    """'out' for what is not the article, 'in' for the article's element, else ''."""
    if name in _NEVER or name == "header" and not in_article:
        return "out"
    words: set[str] = set()
    marked = False
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            if key.lower() in ("class", "id", "role", "itemprop"):
                found = _WORD.findall("".join(values).lower())
                words.update(found)
                marked |= _marks(found, in_article)
        if _HIDDEN.search(attributes):
            return "out"
    if name not in ("html", "body") and (
        marked or not in_article and words & _MARKED_HEADERS and name != "main"
    ):
        return "out"
    return "in" if name in ("article", "main") or words & _ARTICLE else ""


def _marks(words: list[str], in_article: bool) -> bool:
    """Whether a class, id or role marks what is not the article.

    One word that does is enough outside the article. In it, all other words must be of those that go with such marks: a
    section on related work or a table of share prices is text.
    """
    return not _MARKS.isdisjoint(words) and (not in_article or all(
        w in _MARKS or w in _BESIDE or len(w) < 3 or not w.isalpha() for w in words
    ))


class Line(NamedTuple):
    text: str
    counts: int  # characters that count as the article's
    element: int  # number of the outermost element marked as the article, 0 outside
    heading: bool
    menu: bool  # mostly linked text
    holder: int  # number of the innermost element that holds blocks


def lines(page: str) -> tuple[list[Line], bool]:
    """Lines of a page, and whether it marks an article."""
    found: list[Line] = []
    marked = False
    stack: list[tuple[str, str, int]] = []  # name, role, number
    holders: list[int] = [0]
    out = inside = heading = number = element = 0
    # The depth of the open link, none is -1; it ends with its block, or with the first block in it.
    link = -1
    text: list[str] = []
    linked = 0

    def close_line():
        nonlocal text, linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                menu = linked > LINKED * len(words)
                counts = 0 if out or (menu and not inside) else len(words)
                found.append(Line(words, counts, element if inside else 0, heading > 0, menu, holders[-1]))
        text, linked = [], 0

    def pop(entry):
        nonlocal out, inside
        out -= entry[1] == "out"
        inside -= entry[1] == "in"
        if holders[-1] == entry[2]:
            holders.pop()

    at, end = 0, len(page)
    while at < end:
        open_ = page.find("<", at)
        if open_ < 0:
            open_ = end
        if open_ > at:
            part = page[at:open_]
            text.append(part)
            if link >= 0:
                linked += len(part)
            at = open_
            continue
        token = _TOKEN.match(page, at)
        if token is None:  # a lone "<" is text
            text.append("<")
            at += 1
            continue
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        name = name.lower()
        closing = (token[1] or token[4]) == "/"
        if name in _BLOCK:
            close_line()
        if closing:
            if name == "a":
                link = -1
            elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
                heading = 0
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close_line()
                    for entry in reversed(stack[depth:]):
                        pop(entry)
                    del stack[depth:]
                    if depth <= link:
                        link = -1
                    break
            continue
        if name in _RAW_END:
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else end
            continue
        if name in _VOID:
            continue
        attributes = token[3] or token[6] or ""
        if name == "a":
            link = len(stack) if _HREF.search(attributes) else -1
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            heading = 1
        if name in _BLOCK and stack and stack[-1][0] in _ONCE and (
            stack[-1][0] == name or stack[-1][0] == "p"
        ):
            pop(stack.pop())
            if len(stack) <= link:
                link = -1
        role = _role(name, attributes, inside > 0)
        if name in _BLOCK or role:
            close_line()
            number += 1
            stack.append((name, role, number))
            if name not in _ONCE and not (len(name) == 2 and name[0] == "h"):
                holders.append(number)
            out += role == "out"
            if role == "in" and not inside:
                element = number
            inside += role == "in"
            marked |= role == "in" and not out
    close_line()
    return found, marked


def passages(lengths: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Runs of lines between a surge and a dive of the sliding sums.

    A run begins at a line with text whose window sums to ``surge`` at least, and ends where a window
    sums to nothing.
    """
    n = len(lengths)
    sums = [sum(lengths[i:i + window]) for i in range(n)]
    runs, i = [], 0
    while i < n:
        if lengths[i] and sums[i] >= surge:
            stop = i
            while stop < n and sums[stop]:
                stop += 1
            runs.append((i, stop))
            i = stop
        else:
            i += 1
    return runs


def main_text(page: str) -> str:
    """The blocks of the article, joined by one space; empty if the page has no text."""
    found, marked = lines(page)
    if marked:
        lengths = [line.counts if line.element else 0 for line in found]
        if any(lengths):
            # An element with a surge is an article; so is one without, unless it only points to others.
            own: dict[int, list[int]] = {}
            for line, n in zip(found, lengths):
                own.setdefault(line.element, []).append(n)
            surges = {element for element, inner in own.items() if element and passages(inner, SURGE)}
            texts = surges | {line.element for line, n in zip(found, lengths) if n and not line.menu and not line.heading}
            texts = texts or {line.element for line in found}
            return " ".join(line.text for line, n in zip(found, lengths) if n and line.element in texts)
    lengths = [line.counts for line in found]
    kept: set[int] = set()
    holders: set[int] = set()
    for a, z in passages(lengths, min(SURGE, max(lengths, default=0))):
        # The passage proper is from its first to its last long line; headings before it belong to it.
        long = [i for i in range(a, z) if lengths[i] >= LONG]
        if long:
            first = long[0]
            while first > a and found[first - 1].heading:
                first -= 1
            a, z = first, long[-1] + 1
            holders.update(found[i].holder for i in long)
        kept.update(range(a, z))
    # Short lines of the elements that hold the long ones are of the same text, wherever they stand.
    return " ".join(
        line.text for i, line in enumerate(found) if line.counts and (i in kept or line.holder in holders)
    )


def _extract(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = [main_text(page.as_py() or "") for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every row. A null or empty html has an empty text. Columns
    page_id and url pass as they are, nulls and repeated rows too; others are not read."""
    ship(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string")
