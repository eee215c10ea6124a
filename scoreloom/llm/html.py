"""Main text of web pages by removal of site templates.

Every element is hashed with all that is in it.  Spark counts on how many pages of its
host each subtree stands, pages of equal text as one; those that recur on many of them are
the site's template and are deleted.  What the markup itself calls a menu, footer, advert, form or the like goes
too, and the text of what is left is read block by block.

Subtrees inside an article or main element, or around one, are not counted as template:
they are content even if a site shows it on several pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.llm.common import column_of, slices, stored

MIN_PAGES = 5
BROADCAST_SUBTREES = 500_000

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>
    |<(/?)([A-Za-z][^\s/>]*)[^>]*>
    |<[!?/A-Za-z][^>]*(?:>|\Z)
    |[^<]+|<""",
    re.S | re.X,
)
# A name with or without a value, or a quoted string by itself.
ATTRIBUTE = re.compile(
    r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'"""
)
NAMED = ("class", "id", "role")

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# What markup calls something else than main text, by element and by word of class, id or role.
DROPPED = frozenset(
    "aside button canvas dialog footer form head input menu nav object select svg "
    "script style textarea title noscript template iframe".split()
)
DROPPED_OUTSIDE = frozenset({"header"})
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs comment comments reply replies respond disqus newsletter subscribe signup login "
    "share sharing social related recommended popup modal overlay pagination pager".split()
)
WORDS_OUTSIDE = frozenset("header footer masthead banner".split())
MAIN = frozenset({"article", "main"})
KEPT_WHOLE = frozenset({"article", "main", "body", "html"})
# An opening tag closes these if they are open within the given bounds.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "body": (frozenset({"head"}), frozenset({"html"})),
}
SCOPES = frozenset({"article", "main", "table", "td", "th", "body", "html"})


class Element:
    __slots__ = ("tag", "parts", "at", "dropped", "inside", "holds_main", "words")

    def __init__(self, tag: str, at: int, dropped: bool, inside: bool):
        self.tag, self.at, self.dropped, self.inside = tag, at, dropped, inside
        self.parts: list[bytes] = [tag.encode()]
        self.holds_main = False
        self.words = False


def attributes_of(raw: str) -> dict[str, str]:
    """The attributes of a tag by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        if name:
            found.setdefault(name.lower(), value.strip("\"'"))
    return found


class Page:
    """Reads a page once: ``subtrees`` are hashes of possible template parts, ``text`` the rest.

    ``content`` hashes all texts of the page, dropped ones included, but no attributes: copies of
    a page under several URLs, with other links or heads, have one.  ``gone`` says of a hash whether that subtree is to be deleted.
    """

    def __init__(self, html: str, gone=None):
        self.gone = gone or (lambda _: False)
        self.subtrees: set[int] = set()
        self.content = xxhash.xxh64()
        self.out: list[str | None] = []  # texts, and None between blocks
        self.stack = [Element("", 0, False, False)]
        at = 0
        while at < len(html):
            match = TOKEN.match(html, at)
            at = match.end()
            tag = match.group(2) or match.group(5)
            if tag is None:
                if match.group()[0] != "<" or len(match.group()) == 1:
                    self._text(match.group())
                continue
            tag = tag.lower()
            if match.group(1) or match.group(4):
                self._end(tag)
                continue
            self._start(tag, match.group(3) or "")
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)
        while len(self.stack) > 1:
            self._pop()

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        text = unescape(raw)
        clean = " ".join(text.split())
        if clean:
            self.content.update(clean.encode("utf-8", "replace") + b"\0")
        if top.dropped:
            return
        if clean:
            top.parts.append(b"t" + clean.encode("utf-8", "replace"))
            top.words = True
        self.out.append(text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        if tag in BLOCKS:
            self._close_open(frozenset({"p"}), SCOPES)
        top = self.stack[-1]
        inside = top.inside or tag in MAIN
        if tag in VOID:
            if tag in BLOCKS and not top.dropped:
                self.out.append(None)
            return
        dropped = top.dropped or tag in DROPPED or (tag in DROPPED_OUTSIDE and not inside)
        if not dropped and attributes and tag not in KEPT_WHOLE:
            given = attributes_of(attributes)
            words: set[str] = set()
            for name in NAMED:
                if name in given:
                    words.update(re.findall(r"[a-z]+", given[name].lower()))
            dropped = bool(words & WORDS) or (not inside and bool(words & WORDS_OUTSIDE))
            dropped = dropped or "hidden" in given
            dropped = dropped or given.get("aria-hidden", "").strip().lower() == "true"
        if tag in BLOCKS and not top.dropped:
            self.out.append(None)
        self.stack.append(Element(tag, len(self.out), dropped, inside))

    def _close_open(self, tags: frozenset[str], bounds: frozenset[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag in tags:
                while len(self.stack) > depth:
                    self._pop()
                return
            if tag in bounds:
                return

    def _end(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in SCOPES and tag not in SCOPES and tag not in BLOCKS:
                return

    def _pop(self) -> None:
        element = self.stack.pop()
        parent = self.stack[-1]
        parent.holds_main |= element.holds_main or element.tag in MAIN
        if not element.dropped:
            value = xxhash.xxh64_intdigest(b"\0".join(element.parts))
            parent.parts.append(b"e" + value.to_bytes(8, "little"))
            parent.words |= element.words
            if element.words and not element.inside and not element.holds_main:
                self.subtrees.add(value)
                if self.gone(value):
                    del self.out[element.at :]
        if element.tag in BLOCKS and not parent.dropped:
            self.out.append(None)

    def text(self) -> str:
        blocks, now = [], []
        for piece in [*self.out, None]:
            if piece is not None:
                now.append(piece)
            elif now:
                block = " ".join("".join(now).split())
                if block:
                    blocks.append(block)
                now = []
        return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if it has none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def _combined(host: str, subtree: int) -> int:
    return _signed(xxhash.xxh64_intdigest(host.encode(), subtree))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def subtrees(pages: DataFrame) -> DataFrame:
    """(page, host, subtree, content): every subtree of every page of ``page``, ``host``, ``html``
    once, with the hash of the page's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            ids, hosts, found, contents = [], [], [], []
            for page, host, html in zip(
                *(column_of(part, c).to_pylist() for c in ("page", "host", "html")), strict=True
            ):
                read = Page(html or "")
                content = _signed(read.content.intdigest())
                for value in read.subtrees:
                    ids.append(page)
                    hosts.append(host)
                    found.append(_combined(host, value))
                    contents.append(content)
            whole = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, whole),
                    pa.array(hosts, pa.string()),
                    pa.array(found, whole),
                    pa.array(contents, whole),
                ],
                ["page", "host", "subtree", "content"],
            )

    return pages.mapInArrow(run, "page long, host string, subtree long, content long")


def templates(found: DataFrame, min_pages: int) -> DataFrame:
    """Subtrees on ``min_pages`` pages of their host, at least, whatever the size of the host.

    Pages of equal content are one page.  Further pages of a host never take a template back.
    """
    counts = found.groupBy("host", "subtree").agg(F.count_distinct("content").alias("n"))
    return counts.filter(F.col("n") >= min_pages).select("subtree")


def extract(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    broadcast_subtrees: int = BROADCAST_SUBTREES,
) -> DataFrame:
    """``pages`` (with url and html) with text instead of html.

    A null or empty html, or a page without main text, gives an empty text; equal pages of a
    host give equal texts, and copies are no evidence of a template, however many; a null url counts as a host of its own name, the empty one.  Columns
    named text are replaced.  The template subtrees are broadcast if there are at most
    ``broadcast_subtrees`` of them; otherwise each page is joined with its own.
    """
    names = [c for c in pages.columns if c not in ("html", "text")]
    kept = pages.select(*(f"`{c}`" for c in names))
    schema = StructType([*kept.schema.fields, *StructType.fromDDL("text string").fields])
    page = F.xxhash64(F.col("url"), F.col("html"))
    keyed = pages.select(
        *(f"`{c}`" for c in names),
        "html",
        page.alias("_page"),
        host_of(F.col("url")).alias("_host"),
    )
    known = keyed.select(F.col("_page").alias("page"), F.col("_host").alias("host"), "html")
    found = stored(subtrees(known), "subtrees")
    often = stored(templates(found, min_pages).distinct(), "templates")
    small = often.count() <= broadcast_subtrees
    shared = None
    if small:
        values = np.array([r["subtree"] for r in often.collect()], np.int64)
        shared = pages.sparkSession.sparkContext.broadcast(values)
    else:
        own = found.join(often, "subtree").groupBy("page").agg(
            F.collect_set("subtree").alias("_gone")
        )
        own = own.withColumnRenamed("page", "_own")
        keyed = keyed.join(own, F.col("_page") == F.col("_own"), "left").drop("_own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = set(shared.value.tolist()) if shared is not None else None
        for part in slices(batches, "html"):
            n = part.num_rows
            if everywhere is None:
                gone = [set(g or ()) for g in column_of(part, "_gone").to_pylist()]
            else:
                gone = [everywhere] * n
            texts = []
            for host, html, deleted in zip(
                column_of(part, "_host").to_pylist(),
                column_of(part, "html").to_pylist(),
                gone,
                strict=True,
            ):
                test = _test(host, deleted) if deleted else None
                texts.append(Page(html or "", test).text())
            columns = [column_of(part, c) for c in names] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return keyed.mapInArrow(run, schema)


def _test(host: str, deleted: set[int]):
    return lambda subtree: _combined(host, subtree) in deleted
