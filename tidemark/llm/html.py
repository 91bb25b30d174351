"""Main text of web pages, by structure and by comparing pages with their neighbours.

A page becomes lines, one per block of text.  Pages of a host with equal text (the lines
that the markup does not leave out) are one page.  The pages are put in order of their
URL paths; each is aligned with those next to it, the one first whose path has more in
common with its own, by a longest common subsequence of the lines, and the lines they
share are the site's, not the page's.

What is left of a page decides where its content is.  The lines in menus, headers, footers,
sidebars, notices, adverts, forms and comments (by element, role, or a class or id that names
nothing else) never count.  A main element is the content.  An article element is where it holds a third
of what is left, or where nothing is left; else it is a teaser and goes.  Without one, the content is
the innermost element that holds four fifths of what is left in two lines or more, or, where
none does, just the lines that are left.  Articles quote each other, so the content keeps
its shared lines: an article or main element all of them, another element those that stand beside
lines of the page's own; a division, list or table inside it that has no line of its own loses
the lines that more than one of the pages around it have.

Defined results: a null html or one without text gives an empty text; a null or
unparsable url belongs to the host "" with an empty path; a neighbour that has almost all
of a page's text may be an altered copy, so the next of the two pages on either side is
tried; where all of them are such, the site's lines are those that all of them have, if
others are left over (a page without a line of its own keeps its text); altered copies
that fill all these places count as short articles of a site; copies and repeated rows get
one answer, and ``n_shared`` of the first of them; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.session import scratch_folder

MARKED = 3  # an article element is a teaser below one part in so many of what is left
CONTENT_SHARE = 0.8  # of what is left, in the element taken for the content
COPY = 0.8  # share of a page's text lines from which it may be its neighbour's altered copy
SIDE = 2  # neighbours on either side
BLOCK = 512  # pages compared by one call
CELLS = 1 << 28  # bits that an alignment may keep at once

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
LINES = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split())
ENDS_PARAGRAPH = LINES - frozenset("html head body caption legend option optgroup summary tbody tfoot thead tr".split())
LEFT_OUT = frozenset("nav footer aside form menu dialog svg math canvas audio video object applet button select datalist".split())
CONTENT = {"article": 1, "main": 2}
HOLDERS = frozenset("article main section div center td".split())  # may hold an article
DIVISIONS = HOLDERS | frozenset("ul ol dl table blockquote".split())
ROLES_OUT = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog status".split())

# a class or id is left out if its parts are words of the first kind, with any of the second
_FURNITURE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|overlay|sidebar|menu|nav|navbar|"
    r"navigation|breadcrumbs?|footer|masthead|comments?|commentlist|disqus|respond|replies|share|sharing|social|related|newsletter|subscribe|"
    r"subscription|widget|login|signup|search", re.I)
_PLACES = re.compile(
    r"area|bar|block|bottom|box|buttons?|center|col|column|container|footer|group|header|holder|icons?|inner|items?|left|links?|list|main|outer|panel|"
    r"primary|right|row|secondary|section|side|site|slot|top|unit|wrap|wrapper|\d+", re.I)
_WHOLE_OUT = frozenset("site-header page-header side-bar".split())
_NAMES_CONTENT = re.compile(r"(?:^|\s)(?:article-?body|post-?content|entry-?content|article-?content|story-?body|main-?content)(?:$|\s)", re.I)
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)")


class _Element:
    __slots__ = ("name", "out", "content", "division")

    def __init__(self, name: str, out: bool, content: int, division: int):
        self.name, self.out, self.content, self.division = name, out, content, division


def _named_out(value: str) -> bool:
    """Does one of the names of a class or id attribute say that the element is furniture?"""
    for name in value.split():
        parts = [p for p in re.split("[-_]+", name) if p]
        if name.lower() in _WHOLE_OUT or any(map(_FURNITURE.fullmatch, parts)) and all(_FURNITURE.fullmatch(p) or _PLACES.fullmatch(p) for p in parts):
            return True
    return False


def _judge(name: str, attributes: str, in_content: bool) -> tuple[bool, int]:
    """Is the element left out, does it hold content (1: an article, 2: the page's)?"""
    out, content = name in LEFT_OUT or name == "header" and not in_content, CONTENT.get(name, 0)
    if not attributes:
        return out, content
    for key, a, b, c, alone in _ATTRIBUTE.findall(attributes):
        key, value = (key or alone).lower(), unescape(a or b or c)
        if key in ("class", "id"):
            out = out or name not in ("html", "body") and _named_out(value)
            content = 2 if _NAMES_CONTENT.search(value) else content
        elif key == "role":
            out = out or value.strip().lower() in ROLES_OUT
            content = max(content, CONTENT.get(value.strip().lower(), 0))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out = True
        elif key == "itemprop" and value == "articleBody":
            content = 2
    return out, content


class Line(NamedTuple):
    text: str
    out: bool  # left out by its markup
    content: int  # inside an article (1) or the page's main element (2)
    division: int  # the innermost division


def lines(html: str) -> list[Line]:
    """The page's lines in order."""
    return read(html)[0]


def read(html: str) -> tuple[list[Line], list[int], list[bool]]:
    """The page's lines in order, and of every division (0 is the page) the one around it and if it may hold an article."""
    found: list[Line] = []
    stack: list[_Element] = []
    places: dict[str, list[int]] = {}  # where in the stack a name stands
    around, may = [0], [False]
    parts: list[str] = []
    out = content = mains = 0

    def last(names: tuple[str, ...]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=-1)

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append(Line(text, out > 0, 2 if mains else int(content > 0), stack[-1].division if stack else 0))

    def close(to: int, line: bool = True) -> None:
        nonlocal out, content, mains
        if line:
            flush()
        while len(stack) > to:
            e = stack.pop()
            places[e.name].pop()
            out -= e.out
            content -= e.content > 0
            mains -= e.content == 2

    at, n = 0, len(html)
    while at < n:
        m = _MARKUP.search(html, at)
        if m is None:
            parts.append(unescape(html[at:]))
            break
        if m.start() > at:
            parts.append(unescape(html[at:m.start()]))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        if at < n and html[at] != ">":  # a quote without its end
            at = html.find(">", at)
            at = n if at < 0 else at
        at += 1
        name = name.lower()
        if m[1]:
            place = last((name,))
            if name in LINES:
                flush()
            if place >= 0:
                close(place, any(e.name in LINES or e.name in DIVISIONS or e.out or e.content for e in stack[place:]))
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = n if end is None else end.start()
            close_at = html.find(">", at)
            at = n if close_at < 0 else close_at + 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in ENDS_PARAGRAPH:
            place = last(("p",))
            if place >= 0:
                close(place)
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(name, (name,))
            scope = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "option": ("select", "datalist")}.get(name, ("tr", "table"))
            place = last(same)
            if place > last(scope):
                close(place)
        if name in LINES:
            flush()
        elif name in ("td", "th"):
            parts.append(" ")
        if name in VOID or m[3].endswith("/") and name in ("svg", "path", "use", "circle", "rect", "line"):
            continue
        left, holds = _judge(name, m[3].strip(), content > 0)
        if left or holds:
            flush()
        division = stack[-1].division if stack else 0
        if name in DIVISIONS:
            around.append(division)
            may.append(name in HOLDERS)
            division = len(around) - 1
        places.setdefault(name, []).append(len(stack))
        stack.append(_Element(name, left, holds, division))
        out += left
        content += holds > 0
        mains += holds == 2
    close(0)
    return found, around, may


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of ``b`` with every prefix of ``a``."""
    rows = _rows(a, b, keep=False)
    v, total, lengths = rows[-1], 0, [0]
    for i in range(len(a)):
        total += not v >> i & 1
        lengths.append(total)
    return lengths


def _rows(a: list[int], b: list[int], keep: bool = True) -> list[int]:
    """After each of ``b``, the bits of ``a`` at which the length does not grow."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v, rows = full, [full]
    for x in b:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def common(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    in_b, in_a = set(b[low:len(b) - high]), set(a[low:len(a) - high])
    places = [i for i in range(low, len(a) - high) if a[i] in in_b]  # others match nothing
    middle = _align([a[i] for i in places], [x for x in b[low:len(b) - high] if x in in_a])
    return [*range(low), *(places[i] for i in middle), *range(len(a) - high, len(a))]


def _align(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(b) > 1:  # too large to keep: cut where both halves match most
        half = len(b) // 2
        head, tail = _lengths(a, b[:half]), _lengths(a[::-1], b[half:][::-1])
        cut = max(range(len(a) + 1), key=lambda i: head[i] + tail[len(a) - i])
        return _align(a[:cut], b[:half]) + [cut + i for i in _align(a[cut:], b[half:])]
    rows = _rows(a, b)
    i, j, found = len(a) - 1, len(b), []
    while i >= 0 and j > 0:
        if rows[j] >> i & 1:
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
        else:
            found.append(i)
            i, j = i - 1, j - 1
    return found[::-1]


def nearness(a: str, b: str) -> int:
    """Leading parts that two URL paths share."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def shared_lines(own: list[int], path: str, others: list[tuple[list[int], str]]) -> tuple[list[int], list[int]]:
    """Positions of the lines that a page shares with its nearest neighbour (nearest first where they tie),
    and of those that another neighbour has as well, if there is one.

    Lines below zero are left out by the markup: they are told by their complement and are no text.
    """
    plain, texts = [_line(x) for x in own], sum(x >= 0 for x in own)
    every = nearest = None
    again: set[int] = set()
    neighbours = 0
    for theirs, _ in sorted(others, key=lambda o: -nearness(path, o[1])):
        same = common(plain, [_line(x) for x in theirs])
        if sum(own[i] >= 0 for i in same) < COPY * max(texts, sum(x >= 0 for x in theirs)):
            neighbours += 1
            if nearest is None:
                nearest = same
            else:
                again |= set(same)
        elif nearest is None:
            every = set(same) if every is None else every & set(same)
    if nearest is not None:
        return nearest, [i for i in nearest if i in again] if neighbours > 1 else nearest
    left = every is not None and sum(own[i] >= 0 for i in every) < texts
    return (sorted(every), sorted(every)) if left else ([], [])


def _line(x: int) -> int:
    return x if x >= 0 else ~x


def _located(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", "url", "html", host.alias("host"), path.alias("path"), F.xxhash64("page_id", "url", "html").alias("key"))


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page in batch.column("html").to_pylist():
            found = [(xxhash.xxh64_intdigest(line.text) >> 1, line.out) for line in lines(page or "")]
            rows.append([~x if out else x for x, out in found])
        text = [xxhash.xxh128_hexdigest(np.array([x for x in row if x >= 0], np.int64).tobytes()) for row in rows]
        names = ["host", "path", "page_id", "key"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string()), pa.array(rows, pa.list_(pa.int64()))],
                                         names=[*names, "text", "lines"])


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = len(batch)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int32()), pa.array(np.arange(at, at + n))],
                                         names=[*batch.schema.names, "part", "at"])
        at += n


def _compare(pages: pa.Table) -> pa.Table:
    rows = pages.sort_by("rank").to_pylist()
    found = []
    for i, row in enumerate(rows):
        if row["halo"]:
            continue
        near = [rows[j] for d in range(1, SIDE + 1) for j in (i - d, i + d)
                if 0 <= j < len(rows) and abs(rows[j]["rank"] - row["rank"]) == d and rows[j]["host"] == row["host"]]
        own = row["lines"]
        same, sure = shared_lines(own, row["path"], [(r["lines"], r["path"]) for r in near])
        if same:
            number = np.cumsum([x >= 0 for x in own]) - 1  # of text lines, which copies have alike
            deleted, certain = ([int(number[i]) for i in x if own[i] >= 0] for x in (same, sure))
            found.append({"host": row["host"], "text": row["text"], "deleted": deleted, "sure": certain, "n_shared": len(same)})
    return pa.Table.from_pylist(found, pa.schema([("host", pa.string()), ("text", pa.string()), ("deleted", pa.list_(pa.int32())), ("sure", pa.list_(pa.int32())), ("n_shared", pa.int64())]))


def differences(located: DataFrame, folder: str) -> DataFrame:
    """``key``, ``deleted``: the numbers of a page's text lines that its neighbour has too,
    ``sure``: those that another neighbour has as well, and ``n_shared``: how many lines of any kind.

    Lines travel as hashes.  The pages' order by host and path is written once, so that ranks stay the same.
    """
    spark = located.sparkSession
    hashed = located.mapInArrow(_line_hashes, "host string, path string, page_id long, key long, text string, lines array<long>")
    hashed.write.parquet(f"{folder}/lines")
    order = ["host", "path", "page_id", "key"]
    pages = spark.read.parquet(f"{folder}/lines")
    first = pages.withColumn("_n", F.row_number().over(Window.partitionBy("host", "text").orderBy("path", "page_id", "key"))).where("_n = 1").drop("_n")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = first.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(_positions, "host string, path string, page_id long, key long, text string, lines array<long>, part int, at long").write.parquet(f"{folder}/order")
    placed = spark.read.parquet(f"{folder}/order")
    counts = sorted(placed.groupBy("part").count().collect())  # a row a partition
    before = W.sums(np.array([c for _, c in counts], np.int64)).tolist()
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part int, before long")
    ranked = placed.join(starts, "part").withColumn("rank", F.col("before") + F.col("at"))
    block, within = F.floor(F.col("rank") / BLOCK), F.col("rank") % BLOCK
    # the first and last pages of a block are also beside the blocks next to it
    blocks = F.array_compact(F.array(
        F.struct(block.alias("block"), F.lit(False).alias("halo")),
        F.when(within < SIDE, F.struct((block - 1).alias("block"), F.lit(True).alias("halo"))),
        F.when(within >= BLOCK - SIDE, F.struct((block + 1).alias("block"), F.lit(True).alias("halo")))))
    spread = ranked.withColumn("in", F.explode(blocks)).select("host", "path", "text", "lines", "rank", "in.block", "in.halo")
    found = spread.groupBy("block").applyInArrow(_compare, "host string, text string, deleted array<int>, sure array<int>, n_shared long")
    every = pages.select("key", "host", "text").join(found, ["host", "text"])
    answer = F.min(F.struct("n_shared", "deleted", "sure")).alias("answer")  # repeated rows: one answer
    return every.groupBy("key").agg(answer).select("key", "answer.deleted", "answer.sure", "answer.n_shared")


def main_text(html: str, deleted: list[int], sure: list[int] | None = None) -> str:
    """The page's content, its lines joined by line breaks.

    ``deleted`` numbers the shared lines among those that the markup does not leave out, ``sure`` the ones of
    them that more than one neighbour has (None: all).
    """
    page, around, may = read(html)
    kept = [i for i, line in enumerate(page) if not line.out]
    gone, certain = ({kept[d] for d in x} for x in (deleted, deleted if sure is None else sure))
    weight = lambda places: sum(len(page[i].text) for i in places if i not in gone)
    marked = [i for i in kept if page[i].content]
    if marked:
        if any(page[i].content == 2 for i in marked) or MARKED * weight(marked) >= weight(kept):
            return "\n".join(page[i].text for i in marked)
        kept = [i for i in kept if not page[i].content]
    left = [i for i in kept if i not in gone]
    weights, counts = [0] * len(around), [0] * len(around)  # of the lines left in every division
    for i in left:
        weights[page[i].division] += len(page[i].text)
        counts[page[i].division] += 1
    for d in range(len(around) - 1, 0, -1):
        weights[around[d]] += weights[d]
        counts[around[d]] += counts[d]
    holder = next((d for d in range(len(around) - 1, 0, -1) if may[d] and counts[d] > 1 and weights[d] >= CONTENT_SHARE * weights[0]), 0)
    if not holder:
        return "\n".join(page[i].text for i in left or kept)
    inside = [False] * len(around)
    for d in range(holder, len(around)):
        inside[d] = d == holder or inside[around[d]]
    return "\n".join(page[i].text for i in kept if inside[page[i].division] and (counts[page[i].division] or i not in certain))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` and ``n_shared`` (lines its neighbour has too) of every page."""
    located = _located(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")))
    shared = differences(located, scratch_folder(pages.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("html", "deleted", "sure")))
            texts = [main_text(h or "", d or [], s or []) for h, d, s in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 batch.column("n_shared")], names=["page_id", "url", "text", "n_chars", "n_shared"])

    joined = located.select("page_id", "url", "html", "key").join(shared, "key", "left")
    return joined.select("page_id", "url", "html", "deleted", "sure", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")).mapInArrow(run, "page_id long, url string, text string, n_chars long, n_shared long")
