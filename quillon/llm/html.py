"""Main text of web pages by nearest-URL page differencing, guided by the marks that a page carries itself.

A page is cut into lines (its blocks). Lines inside menus, headers, footers, asides, forms, adverts, notices and comments that
are marked as such are never text, and lines inside a marked article or main part are, unless an element there has an id or a class
that may as well be a word of the article (header, related, discussion). Between the two, the method decides: pages of a host are sorted by URL path, each page is paired with the neighbour whose path agrees longest with its
own, the lines are aligned by a longest common subsequence (those outside the marked parts, or of a marked page its article), and
shared undecided lines are deleted as template.
Two pages that share nearly all of such a page's lines are copies, not pages of one template, and delete nothing from each other.

The marks come first because the method alone can't give right results where templates differ from page to page or hosts
serve one article under several addresses (README).
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import global_row_number
from ..session import cut_lineage, scratch_path
from . import words as W

COPY_SHARE = 0.9  # of the characters of a page's aligned lines; a neighbour that shares more is a copy

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "object", "audio", "video", "canvas", "annotation", "annotation-xml", "desc", "metadata"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav",
          "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_SIDE = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "fieldset", "label"}
_SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
_SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies",
               "footer", "gdpr", "header", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pager",
               "pagination", "popup", "promo", "promotion", "recommended", "related", "search", "share", "sharing", "sidebar", "signup", "skip",
               "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
_COMMENT_WORDS = {"comment", "comments", "disqus", "reply", "replies", "discussion", "respond"}

#: Words that an article may use itself: inside a marked part they leave the decision to the differencing.
_COMMON_WORDS = {"banner", "comment", "consent", "cookie", "cookies", "discussion", "footer", "header", "login", "menu", "navigation", "notice",
                 "notification", "promotion", "recommended", "related", "reply", "replies", "respond", "search", "share", "sharing", "skip", "social",
                 "sponsor", "widget"}

_OUT, _OPEN, _MAIN, _ASIDE = 0, 1, 2, 3  # _ASIDE: undecided, inside a marked part


def _zone(tag: str, attributes: str, zone: int) -> int:
    """The zone of an element inside ``zone``."""
    inside = zone in (_MAIN, _ASIDE)
    words, parts, roles = set(), set(), set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            parts.update(w.lower() for w in _PART.findall(value))
            whole = set(value.lower().split())
            words |= (whole - _COMMON_WORDS if name == "class" else set()) if inside else whole
        elif name == "role":
            roles.update(value.lower().split())
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return _OUT
    if words & _COMMENT_WORDS:
        return _OUT
    if tag in ("main", "article") or "main" in roles:
        return _MAIN
    if tag in ("html", "body"):
        return zone
    if tag in _SIDE or roles & _SIDE_ROLES or words & _SIDE_WORDS:
        return _OUT
    if tag == "header" and not inside:
        return _OUT
    return _ASIDE if inside and parts & (_SIDE_WORDS | _COMMENT_WORDS) else zone


def page_lines(page: str) -> list[tuple[int, str]]:
    """The blocks of a page in order, as (zone, text); blocks that are out, or empty, are left away."""
    lines: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", _OPEN)]
    text: list[str] = []

    def end_block() -> None:
        zone = stack[-1][1]
        if text and zone != _OUT:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append((zone, line))
        text.clear()

    at = 0
    while True:
        found = _TAG.search(page, at)
        text.append(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        close, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if not close and tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or len(page) if end else (at if attributes.endswith("/") else len(page))
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in _BLOCK:
            end_block()
        if tag in _VOID or (not close and attributes.endswith("/") and tag not in _BLOCK):
            continue
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag not in _BLOCK and stack[depth][1] != stack[depth - 1][1]:
                        end_block()
                    del stack[depth:]
                    break
            continue
        if tag in _BLOCK:  # an open paragraph ends where a block begins
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    del stack[depth:]
                    break
                if stack[depth][0] in _BLOCK:
                    break
        zone = stack[-1][1]
        own = _zone(tag, attributes, zone)
        if zone == _OUT and own == _MAIN and any(t in ("aside", "head") for t, _ in stack):
            own = _OUT
        elif zone == _OUT and own != _MAIN:
            own = _OUT
        if tag not in _BLOCK and own != zone:
            end_block()
        stack.append((tag, own))
    end_block()
    return lines


def shared_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """The places in ``a`` of a longest common subsequence of two lists of line hashes."""
    n, head = min(len(a), len(b)), 0
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[len(a) - 1 - tail] == b[len(b) - 1 - tail]:
        tail += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    # Longest increasing run of places: tops[k] is the smallest place that ends a run of k + 1, from[...] its predecessor.
    tops, ends, back = [], [], []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect.bisect_left(tops, j)
            back.append((i, ends[k - 1] if k else -1))
            if k == len(tops):
                tops.append(j)
                ends.append(len(back) - 1)
            else:
                tops[k], ends[k] = j, len(back) - 1
    middle, at = [], ends[-1] if ends else -1
    while at >= 0:
        middle.append(back[at][0])
        at = back[at][1]
    return [*range(head), *middle[::-1], *range(len(a) - tail, len(a))]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "html"):
        rows = []
        for page in batch.column("html").to_pylist():
            lines = page_lines(page or "")
            marked = any(z in (_MAIN, _ASIDE) for z, _ in lines)
            decided = marked and not any(z == _ASIDE for z, _ in lines)
            own = [t for z, t in lines if not marked or z != _OPEN]
            hashes = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for _, t in lines]
            rows.append(("\n\n".join(own) if decided else None, None if decided else own, hashes, [z for z, _ in lines]))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int8())))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("__t"), *columns], ["page_id", "url", "t", "text", "lines", "hashes", "zones"])


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for lines, own, zones, other, others in zip(*(batch.column(c).to_pylist() for c in ("lines", "hashes", "zones", "other", "others"))):
            marked = any(z in (_MAIN, _ASIDE) for z in zones)
            if marked:
                own, zones = zip(*((h, z) for h, z in zip(own, zones) if z != _OPEN))
            else:  # what a neighbour has marked as its article is no template
                other = [h for h, z in zip(other or [], others or []) if z != _MAIN]
            shared = set(shared_lines(own, other or []))
            if sum(len(lines[i]) for i in shared) > COPY_SHARE * sum(map(len, lines)):
                shared = set()
            shared = {i for i in shared if zones[i] != _MAIN}
            texts.append("\n\n".join(x for i, x in enumerate(lines) if i not in shared))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _nearest(pages: DataFrame) -> DataFrame:
    """``page_id, t`` of every page with the ``n_id, n_t`` of its neighbour in (host, path) order whose path agrees longest."""
    url = F.coalesce("url", F.lit(""))
    keys = pages.select("page_id", "t", F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path")).distinct()
    order = [F.col("host").asc(), F.col("path").asc(), F.col("page_id").asc_nulls_last(), F.col("t").asc()]
    placed = cut_lineage(global_row_number(keys, order, "at"))
    other = placed.select(F.col("at").alias("o_at"), F.col("host").alias("o_host"), F.col("path").alias("o_path"), F.col("page_id").alias("n_id"), F.col("t").alias("n_t"))
    both = placed.withColumn("o_at", F.explode(F.array(F.col("at") - 1, F.col("at") + 1))).join(other, "o_at").where("host = o_host")
    agree = F.expr("size(filter(transform(split(path, '/'), (x, i) -> slice(split(path, '/'), 1, i + 1)), p -> p = slice(split(o_path, '/'), 1, size(p))))")
    best = F.max(F.struct(agree.alias("agree"), (-F.col("o_at")).alias("first"), "n_id", "n_t")).alias("b")
    return both.groupBy("at", "page_id", "t").agg(best).select("page_id", "t", "b.n_id", "b.n_t")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (``page_id, url, html``): ``page_id, url, text, n_chars``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by an
    empty line; nothing else is dropped or cut. ``text`` is empty where a page has none (null or empty html); ``n_chars``
    counts its code points. A null url counts as a host of its own. Pages that repeat an id are told apart by their content;
    wholly repeated rows get equal texts. Further columns are ignored; an empty table gives no row.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html", F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).alias("__t"))
    path = scratch_path(pages.sparkSession, "pages")
    rows.mapInArrow(_parse, f"page_id {kind}, url string, t bigint, text string, lines array<string>, hashes array<bigint>, zones array<tinyint>").write.option("compression", "zstd").parquet(path)
    parsed = pages.sparkSession.read.parquet(path)
    marked = parsed.where("text is not null").select("page_id", "url", "text")
    undecided = parsed.where("text is null").drop("text")
    near = _nearest(parsed.select("page_id", "url", "t"))
    hashes = parsed.select(F.col("page_id").alias("n_id"), F.col("t").alias("n_t"), F.col("hashes").alias("other"), F.col("zones").alias("others")).dropDuplicates(["n_id", "n_t"])
    near = near.join(undecided.select("page_id", "t").distinct().withColumnsRenamed({"page_id": "u_id", "t": "u_t"}),
                     F.col("page_id").eqNullSafe(F.col("u_id")) & (F.col("t") == F.col("u_t")), "left_semi")
    near = near.join(hashes.withColumnsRenamed({"n_id": "h_id", "n_t": "h_t"}), F.col("n_id").eqNullSafe(F.col("h_id")) & (F.col("n_t") == F.col("h_t")))
    near = near.select(F.col("page_id").alias("k_id"), F.col("t").alias("k_t"), "other", "others")
    paired = undecided.join(near, F.col("page_id").eqNullSafe(F.col("k_id")) & (F.col("t") == F.col("k_t")), "left")
    rest = paired.select("page_id", "url", "lines", "hashes", "zones", "other", "others").mapInArrow(_difference, f"page_id {kind}, url string, text string")
    return marked.unionByName(rest).withColumn("n_chars", F.char_length("text").cast("bigint"))
