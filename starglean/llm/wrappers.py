"""Main text of web pages by wrappers: union-free regular expressions per host.

A page is a stream of tags and text.  Repeated neighbours (``<p>#</p><p>#</p>``)
fold into a repetition, then the streams of one host are aligned one after the
other: what only one side has becomes optional, texts that differ become a
slot.  The result is a wrapper without alternatives, made of tags, constant
texts, slots, optional and repeated groups.

Wrappers are built per task first, then merged per host in two steps, so a host
with a third of all pages is no single task's work.  The wrapper tells where the
host keeps its article: an ``article``, a ``main`` part, or the block of the
page body whose slots are not the same on every page.  Each page's blocks are
then kept by the place they have in the wrapper, less those that stand with the
same text at the same place on many different pages of the host.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_side, spread, stored
from .urlrules import host_of

# Element groups of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Elements that never hold the main text.
ASIDE = frozenset("nav aside footer form menu dialog button select option script style head svg canvas object audio video".split()) | RAW
#: Whole names of class, id or role that mark such a part, unless it is or encloses one of ``ROOTS``.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay sidebar side aside rail widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs masthead "
    "topbar footer comment comments disqus reply replies respond discussion form login signin signup subscribe subscription newsletter "
    "search searchbox share sharing social related recommended recommendations pagination pager toolbar skip copyright legal disclaimer "
    "complementary contentinfo navigation".split())
ROOTS = frozenset("html body main article".split())
#: Elements of an article that such a name does not make an aside.
PLAIN = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
#: A quote counts where a value starts; a tag that is not closed ends where the next one starts.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^<>]*>|<\?[^<>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^<>])*+)>", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w=-])(hidden)(?![\w=-])")
PART = re.compile(r"[a-z0-9]+")
#: Longer constant texts of a wrapper are kept as a digest of the whole text.
CONSTANT = 40
#: A block is part of the host's template if this many different pages of the host have it, and this share of them.
SEEN = 5
SHARE = 0.5


class Element:
    __slots__ = ("tag", "never", "doubtful", "name")

    def __init__(self, tag: str, attributes: str, inside: bool = False) -> None:
        """``inside`` an article an id says nothing, and headings are part of it whatever their class."""
        self.tag = tag
        marks, told = [], []
        hidden = False
        for name, *values, bare in ATTRIBUTE.findall(attributes) if attributes else ():
            value = next((v for v in values if v), "")
            if name.lower() in ("class", "id", "role"):
                named = ["-".join(PART.findall(n)) for n in value.lower().split()]
                marks += named
                if not inside or (name.lower() != "id" and tag not in PLAIN):
                    told += named
            hidden |= bare == "hidden" or (name.lower() == "style" and "display:none" in value.replace(" ", "").lower()) \
                or (name.lower() == "aria-hidden" and value.lower() == "true")
        self.never = tag in ASIDE or hidden
        self.doubtful = tag not in ROOTS and any(m in ASIDE_WORDS for m in told)
        self.name = ".".join([tag, *sorted({m for m in marks if m})])

    @property
    def aside(self) -> bool:
        return self.never or self.doubtful


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(place, text) of each block of text outside head, menus, notices and the like, in page order.

    A place lists the open elements.  Inline elements and line breaks do not
    end a block; character references are decoded and white space is one space.
    Whether an element with a word of such a part encloses the article is known
    at the end of the page only.
    """
    out: list[tuple[str, str, list[Element]]] = []
    stack: list[Element] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text and not any(e.never for e in stack):
                out.append((">".join(e.name for e in stack if e.tag not in INLINE), text, [e for e in stack if e.doubtful]))
            run.clear()

    at = 0
    for match in TOKEN.finditer(page):
        if match.start() < at:
            continue
        if match.start() > at:
            run.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag == "br":
                run.append(" ")
                continue
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
            if depth is None:
                continue
            if tag not in INLINE or any(e.aside for e in stack[depth:]):
                flush()
            del stack[depth:]
        elif tag in VOID:
            if tag in ("br", "hr", "img", "input", "wbr"):
                run.append("" if tag == "wbr" else " ")
            if tag == "hr":
                flush()
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        else:
            element = Element(tag, match[3], any(e.tag in ("article", "main") for e in stack))
            if tag not in INLINE or element.aside:
                flush()
                if tag in CLOSES_P:
                    close_to(stack, "p", {"article", "div", "section", "td", "li", "main", "body"})
                elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close_to(stack, tag, {"ul", "ol", "dl", "table", "select", "menu"})
            if tag in ROOTS:
                for outer in stack:
                    outer.doubtful = False
            if not match[3].rstrip().endswith("/"):
                stack.append(element)
    if at < len(page):
        run.append(page[at:].split("<!--")[0])
    flush()
    return [(place, text) for place, text, doubts in out if not any(e.doubtful for e in doubts)]


def close_to(stack: list[Element], tag: str, walls: set[str]) -> None:
    """Close an open ``tag`` that the next element ends, unless a wall stands before it."""
    for k in range(len(stack) - 1, -1, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in walls:
            return


# --- wrappers -----------------------------------------------------------------------------------
# A wrapper is a list of parts: ["t", place, text or None] is a constant or a slot, ["?", wrapper] an
# optional and ["+", wrapper] a repeated group.


def shape(part: list) -> str:
    return part[1] if part[0] == "t" else part[0] + "(" + " ".join(map(shape, part[1])) + ")"


def fold(parts: list) -> list:
    """Repeated neighbours become one repeated group, shortest period first."""
    for period in (1, 2, 3, 4):
        out: list = []
        k = 0
        while k < len(parts):
            unit = [shape(p) for p in parts[k : k + period]]
            n = 1
            while len(unit) == period and [shape(p) for p in parts[k + n * period : k + (n + 1) * period]] == unit:
                n += 1
            if n > 1:
                group = parts[k : k + period]
                for r in range(1, n):
                    group = [same(a, b) for a, b in zip(group, parts[k + r * period : k + (r + 1) * period])]
                out.append(group[0] if period == 1 and group[0][0] == "+" else ["+", group])
                k += n * period
            else:
                out.append(parts[k])
                k += 1
        parts = out
    return parts


def same(a: list, b: list) -> list:
    """Two parts of one shape: constants that differ become a slot."""
    if a[0] == "t":
        return ["t", a[1], a[2] if a[2] == b[2] else None]
    return [a[0], [same(x, y) for x, y in zip(a[1], b[1])]]


def core(part: list) -> str:
    """What a part stands for, whether once, repeated or optional."""
    while part[0] != "t" and len(part[1]) == 1:
        part = part[1][0]
    return shape(part)


def joined(a: list, b: list) -> list:
    """Parts of one core: the weaker promise of both holds."""
    if shape(a) == shape(b):
        return same(a, b)
    optional = "?" in (a[0], b[0])
    inner_a, inner_b = (x[1][0] if x[0] == "?" and len(x[1]) == 1 else x for x in (a, b))
    if shape(inner_a) == shape(inner_b):
        both = same(inner_a, inner_b)
    elif "+" in (inner_a[0], inner_b[0]):
        x, y = (p[1] if p[0] == "+" else [p] for p in (inner_a, inner_b))
        both = ["+", [same(p, q) for p, q in zip(x, y)] if list(map(shape, x)) == list(map(shape, y)) else x]
    else:
        both = inner_a
    return ["?", [both]] if optional else both


def numbered(wrapper: list) -> list[tuple[str, int]]:
    """What each part stands for, and how often that stood before it."""
    met: dict[str, int] = {}
    out = []
    for name in map(core, wrapper):
        met[name] = met.get(name, 0) + 1
        out.append((name, met[name]))
    return out


def rising(values: list[int]) -> list[int]:
    """Indices of a longest rising run of ``values``, which are all different."""
    ends: list[int] = []
    last: list[int] = []
    before = []
    for k, value in enumerate(values):
        at = bisect_left(ends, value)
        before.append(last[at - 1] if at else -1)
        ends[at : at + 1] = [value]
        last[at : at + 1] = [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def optional(part: list) -> list:
    return part if part[0] == "?" else ["?", [part]]


def merge(a: list, b: list) -> list:
    """Align two wrappers of any size; what only one of them has, or has in another order, is optional.

    Parts are told apart by what they stand for and its number, and the most of
    them that keep their order are aligned.  No part comes twice, so a wrapper
    is no longer than all that its pages hold.
    """
    at = {name: k for k, name in enumerate(numbered(b))}
    partner = {i: at[name] for i, name in enumerate(numbered(a)) if name in at}
    pairs = list(partner.items())
    aligned = [pairs[k] for k in rising([j for _, j in pairs])]
    shared = set(partner.values())
    out: list = []
    i = j = 0
    for x, y in [*aligned, (len(a), len(b))]:
        out += [optional(joined(a[k], b[partner[k]]) if k in partner else a[k]) for k in range(i, x)]
        out += [optional(b[k]) for k in range(j, y) if k not in shared]
        if x < len(a):
            out.append(joined(a[x], b[y]))
        i, j = x + 1, y + 1
    return fold(out)


def constant_of(text: str) -> str:
    return text if len(text) <= CONSTANT else hashlib.md5(text.encode()).hexdigest()


def wrapper_of(blocks: list[tuple[str, str]]) -> list:
    return fold([["t", place, constant_of(text)] for place, text in blocks])


def absorb(wrapper: list | None, other: list) -> list:
    return other if wrapper is None else merge(wrapper, other)


def places(wrapper: list) -> dict[str, str | None]:
    """Each place of the wrapper; its constant text, or None for a slot."""
    out: dict[str, str | None] = {}
    for part in wrapper:
        if part[0] == "t":
            out[part[1]] = part[2] if out.get(part[1], part[2]) == part[2] else None
        else:
            for place, constant in places(part[1]).items():
                out[place] = constant if out.get(place, constant) == constant else None
    return out


def root_of(wrapper: list) -> str:
    """Which kind of element holds the main text of a host: ``article``, ``main``, ``content`` or ``body``."""
    found = set().union(*(kinds_of(element) for place in places(wrapper) for element in place.split(">")))
    return next((kind for kind in ("article", "main", "content") if kind in found), "body")


@lru_cache(1 << 16)
def kinds_of(element: str) -> frozenset[str]:
    """Kinds of main part an element may be; a name that also has a word of another part (``main-nav``) tells none."""
    tag, *marks = element.split(".")
    if tag in ("html", "body"):
        return frozenset()
    words = {w for m in marks for w in m.split("-") if not ASIDE_WORDS & set(m.split("-"))}
    kinds = {kind for kind in ("article", "main") if tag == kind or kind in words}
    return frozenset(kinds | ({"content"} if CONTENT_WORDS & words else set()))


def in_root(place: str, root: str) -> bool:
    return any(root in kinds_of(element) for element in place.split(">"))


def outside_header(place: str, root: str) -> bool:
    """Whether a block is not in a header of the page (one around or beside the article)."""
    return not any(e.split(".")[0] == "header" for e in place.split(">")) or in_root(place.split(">header")[0], root)


# --- Spark ----------------------------------------------------------------------------------------

BLOCKS = "page_id bigint, url string, host string, blocks array<struct<place:string, text:string>>"


def page_blocks(pages: DataFrame) -> DataFrame:
    def make():
        def work(batch: pa.RecordBatch):
            found = [[{"place": p, "text": t} for p, t in blocks_of(page or "")] for page in batch.column(3).to_pylist()]
            kind = pa.list_(pa.struct([("place", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, kind)],
                                             ["page_id", "url", "host", "blocks"])

        return work

    return map_batches(spread(pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")), make, BLOCKS)


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """One wrapper per key; equal wrappers meet as one row before they are shipped."""

    def run(group):
        wrapper = None
        for text in sorted(group.column("wrapper").to_pylist()):
            wrapper = absorb(wrapper, json.loads(text))
        return pa.table({"host": group.column("host")[:1], "wrapper": pa.array([json.dumps(wrapper)])})

    return rows.distinct().groupBy(*keys).applyInArrow(run, "host string, wrapper string")


def infer_wrappers(blocks: DataFrame) -> DataFrame:
    """``host, wrapper``: a wrapper of all pages of each host."""

    def make():
        def work(batch: pa.RecordBatch):
            wrappers: dict[str, list] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wrappers[host] = absorb(wrappers.get(host), wrapper_of([(b["place"], b["text"]) for b in page]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(wrappers), pa.string()), pa.array([json.dumps(w) for w in wrappers.values()], pa.string())], ["host", "wrapper"])

        return work

    partial = map_batches(blocks.select("host", "blocks"), make, "host string, wrapper string")
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(16)))
    return merged(merged(salted, "host", "salt"), "host")


def shipped(hosts: DataFrame) -> int:
    """Bytes of a table with one row per host."""
    return hosts.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 32)).first()[0] or 0


def named(text: str) -> int:
    """A 64-bit name of a text."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


CELLS = "host string, page bigint, cells array<struct<place:bigint, text:bigint>>"


def block_names(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    """``host, page, cells`` of every page: the name of its main text, and those of its blocks' places and texts."""

    def make():
        def work(batch: pa.RecordBatch):
            pages, cells = [], []
            for page, root in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                pairs = [(b["place"], b["text"]) for b in page]
                pages.append(named("\n".join(text for _, text in candidates(pairs, root or "body"))))
                cells.append([{"place": p, "text": t} for p, t in sorted({(named(p), named(t)) for p, t in pairs})])
            kind = pa.list_(pa.struct([("place", pa.int64()), ("text", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pages, pa.int64()), pa.array(cells, kind)], ["host", "page", "cells"])

        return work

    kinds = roots.select("host", "root")
    return map_batches(blocks.join(small_side(kinds, 1, shipped(kinds)), "host", "left").select("host", "blocks", "root"), make, CELLS)


def constant_places(cells: DataFrame) -> DataFrame:
    """``host, place`` of the places that have one text on all pages, different ones among them."""
    return cells.select("host", "page", F.explode("cells").alias("cell")).groupBy("host", F.col("cell.place").alias("place")).agg(
        F.min("cell.text").alias("text"), F.max("cell.text").alias("most"), F.min("page").alias("page"), F.max("page").alias("last")).filter(
        "text = most and page < last").select("host", "place")


def templates(cells: DataFrame, constant: DataFrame) -> DataFrame:
    """``host, common``: the blocks that many different pages of a host share, or that are constant at their place.

    Pages of one main text count once.
    """
    pages = cells.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = cells.groupBy("host", "page").agg(F.first("cells").alias("cells")).select("host", F.explode("cells").alias("cell")) \
        .groupBy("host", "cell").agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") >= SEEN)
    always = constant.withColumn("always", F.lit(True))
    seen = seen.withColumn("place", F.col("cell.place")).join(always, ["host", "place"], "left").join(pages, "host")
    return seen.filter((F.col("seen") >= SHARE * F.col("pages")) | F.col("always")).groupBy("host").agg(F.collect_list("cell").alias("common"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Pages without an article part of their host's kind fall back to all their
    blocks outside menus, notices and the like.  Null html counts as empty and
    gives an empty text; pages with a null url share the empty host.  Repeated
    rows and null ids are rows of their own; other columns are ignored.
    """
    blocks = stored(page_blocks(pages), "blocks")
    roots = stored(map_batches(infer_wrappers(blocks), lambda: _roots, "host string, root string"), "roots")
    cells = stored(block_names(blocks, roots), "cells")
    constant = stored(constant_places(cells), "constant")
    fixed = constant.groupBy("host").agg(F.collect_list("place").alias("fixed"))
    hosts = stored(roots.join(fixed, "host", "left").join(templates(cells, constant), "host", "left"), "hosts")

    def make():
        def work(batch: pa.RecordBatch):
            texts = []
            for page, root, fixed, common in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                pairs = [(b["place"], b["text"]) for b in page]
                kept = chosen(pairs, root or "body", set(fixed or ()), {(c["place"], c["text"]) for c in common or ()})
                texts.append(" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

        return work

    placed = blocks.join(small_side(hosts, 1, shipped(hosts)), "host", "left").select("page_id", "url", "blocks", "root", "fixed", "common")
    return map_batches(placed, make, "page_id bigint, url string, text string, n_chars bigint")


def _roots(batch: pa.RecordBatch):
    roots = [root_of(json.loads(text) or []) for text in batch.column(1).to_pylist()]
    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roots, pa.string())], ["host", "root"])


def candidates(blocks: list[tuple[str, str]], root: str) -> list[tuple[str, str]]:
    """The blocks inside the root, or where there are none those outside the page's header."""
    inside = [(place, text) for place, text in blocks if root != "body" and in_root(place, root)]
    return inside or [(place, text) for place, text in blocks if outside_header(place, root)]


def chosen(blocks: list[tuple[str, str]], root: str, fixed: set[int], common: set[tuple[int, int]] = frozenset()) -> list[str]:
    """Texts of the blocks that the wrapper places in the main text."""
    found = candidates(blocks, root)
    kept = [(place, text) for place, text in found if (named(place), named(text)) not in common] if common else found
    kept = kept or found
    if found and (root == "body" or not in_root(found[0][0], root)):
        kept = [(place, text) for place, text in kept if named(place) not in fixed] or kept
    return [text for _, text in kept]
