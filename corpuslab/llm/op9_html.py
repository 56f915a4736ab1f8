"""Operator 9, HTML extraction by consensus host paths.

Pass 1 scores the containers of each page: a block of text gives its length (link text
counts against it) to its container and half of it to the container above. Each page votes
for its best container's generalised path: tags with classes, digits and attributes
dropped, as a 64-bit hash chained from the root. Votes are counted per host in Spark. Pass 2
extracts again, from the outermost elements on the page that have a winning path; a page on
which no winning path occurs uses its own best container. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are left out wherever they stand:
by their tag or role, or if a whole class or id names such a part (``ad``, ``site-header``,
``cookie-banner``; not ``share-price`` or ``article-header``). But an element that is left out
for its class, id or role only is kept if all text in article or main elements, or all text of
the page, would go with it. A head ends where something begins that can't be in it.

The winning paths (a few per host) are counted and written first, so that Spark joins them
without shuffling a page if they are small; if not, adaptive execution can split a hot host.

Defined results: a null or empty page, or one without text, gives an empty text; pages
without a host vote together; repeated rows and null ids are extracted one by one; of
containers with equal scores the one that opens first has the page's vote, and all paths with
at least ``share`` of a host's votes win. Pages of any length and depth are read whole, in time
and memory in proportion to them. Extra columns are not read; empty in, empty out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, saved

#: A quote opens a value only after an equals sign.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
         "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot",
         "th", "thead", "tr", "ul"}
#: Elements that hold blocks and can be the page's main container.
CONTAINER = {"article", "body", "center", "div", "main", "section", "td"}
DROPPED = {"aside", "button", "dialog", "fieldset", "footer", "form", "head", "header", "input", "menu", "nav", "select", "svg", "math",
           "object", "canvas", "audio", "video", "label", "option"} | RAW
#: Classes and ids that name parts beside the article.
BESIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
          "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
          "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted", "related", "replies", "share",
          "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Words that may stand beside them in a class or id that still names such a part.
NEUTRAL = {"site", "global", "main", "top", "bottom", "left", "right", "bar", "box", "button", "buttons", "list", "links", "posts", "slot",
           "unit", "zone", "wrap", "wrapper", "container", "inner", "area", "block", "icons", "tools", "form"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
#: What may stand in a head; any other start tag ends it, as its end tag can be left out.
IN_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noscript", "script", "style", "template", "title"}
RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


class Element:
    """An open element. ``container`` is the nearest container (itself, if it is one), ``mark`` the
    nearest element named as beside the article; both are linked upwards, not copied."""

    __slots__ = ("tag", "key", "out", "container", "link", "mark", "main")

    def __init__(self, tag, key, out, link, mark, main):
        self.tag, self.key, self.out, self.link, self.mark, self.main = tag, key, out, link, mark, main


class Container:
    __slots__ = ("tag", "path", "no", "up", "mark")

    def __init__(self, tag, path, no, up, mark):
        self.tag, self.path, self.no, self.up, self.mark = tag, path, no, up, mark


class Mark:
    __slots__ = ("up", "depth", "kept")

    def __init__(self, up):
        self.up, self.depth, self.kept = up, 1 + (up.depth if up else 0), False


def _beside(token: str) -> bool:
    """Whether a class or an id names a part beside the article."""
    words = WORD.findall(token)
    return not BESIDE.isdisjoint(words) and all(w in BESIDE or w in NEUTRAL or len(w) == 1 for w in words)


def _named(attrs: str) -> tuple[str, bool]:
    """The generalised classes, and whether class, id or role name a part beside the article."""
    classes, beside = "", False
    for m in ATTR.finditer(attrs):
        name = m[1].lower()
        if name not in ("class", "id", "role"):
            continue
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "role":
            beside |= value.strip() in ROLES
            continue
        beside |= any(map(_beside, value.split()))
        if name == "class":
            classes = "".join(f".{w}" for w in sorted(set(re.sub(r"\d+", "", value).split())))
    return classes, beside


def _chained(path: int, step: str) -> int:
    """The hash of a path and one more step."""
    return xxhash.xxh3_64_intdigest(step.encode("utf-8", "surrogatepass"), seed=path)


def blocks(page: str) -> tuple[list[tuple[str, int, Container]], list[Container]]:
    """Blocks of wanted text in page order, each with its link characters and its container,
    and all containers, outer ones first."""
    found: list = []
    inside: list = []
    marks: list[Mark] = []
    root = Element("", 0, False, False, None, False)
    root.container = Container("", 0, 0, None, None)
    containers: list[Container] = [root.container]
    stack = [root]
    opened: Counter = Counter()  # how many of a tag are open
    text: list[str] = []
    link_chars = 0

    def flush():
        nonlocal text, link_chars
        if text:
            whole = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if whole:
                found.append((whole, link_chars, stack[-1].container))
                inside.append((stack[-1].mark, stack[-1].main))
            text, link_chars = [], 0

    def cut(at: int):
        opened.subtract(e.tag for e in stack[at:])
        del stack[at:]

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and stack[-1].tag == "head" and page[at:stop].strip():
            cut(len(stack) - 1)
        if stop > at and not stack[-1].out:
            piece = page[at:stop]
            text.append(piece)
            if stack[-1].link:
                link_chars += len(piece)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # end tag
            if tag in BLOCK:
                flush()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    if stack[-1].mark is not stack[i - 1].mark:
                        flush()
                    cut(i)
                    break
                if stack[i].tag in BLOCK and tag not in BLOCK:
                    break
            continue
        if tag not in IN_HEAD and opened["head"]:
            for i in range(1, min(len(stack), 4)):
                if stack[i].tag == "head":
                    cut(i)
                    break
        if tag in BLOCK:
            flush()
            closes, until = CLOSES.get(tag, ({"p"}, set()))
            for i in range(len(stack) - 1, 0, -1) if opened["p"] or any(opened[c] for c in closes) else ():
                here = stack[i].tag
                if here in closes or here == "p":
                    cut(i)
                    if here in closes:
                        continue
                elif here in until or (here in BLOCK and tag not in CLOSES):
                    break
                if not opened["p"] and not any(opened[c] for c in closes):
                    break
        elif tag == "br":
            text.append(" ")
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:  # up to its end tag, whatever it holds
            close = RAW_ENDS[tag].search(page, at)
            at = close.end() if close else (end if tag != "title" else at)
            continue
        up = stack[-1]
        classes, beside = _named(m[3]) if m[3] else ("", False)
        out = up.out or tag in DROPPED
        mark = up.mark
        if beside and not out and tag not in ("html", "body", "article", "main"):
            flush()
            mark = Mark(up.mark)
            marks.append(mark)
        e = Element(tag, _chained(up.key, f"{tag}{classes}") if tag in BLOCK else up.key, out, up.link or tag == "a", mark,
                    up.main or tag in ("article", "main") and not beside)
        e.container = up.container
        if tag in CONTAINER and not out:
            e.container = Container(tag, e.key, len(containers), up.container, mark)
            containers.append(e.container)
        if out and not up.out and tag not in BLOCK:
            text.append(" ")
        stack.append(e)
        opened[tag] += 1
    flush()
    depth = lambda mark: mark.depth if mark else 0
    of_main = [mark for mark, main in inside if main] or [mark for mark, _ in inside]
    least = min(map(depth, of_main), default=0)
    for mark in of_main:  # the marks around the least marked text do not count
        while mark and depth(mark) <= least and not mark.kept:
            mark.kept, mark = True, mark.up
    for mark in marks:  # outer ones first: kept only with all around it
        mark.kept = mark.kept and (mark.up is None or mark.up.kept)
    fine = lambda mark: mark is None or mark.kept
    return [f for f, (mark, _) in zip(found, inside) if fine(mark)], [c for c in containers if fine(c.mark)]


def best_path(found: list, containers: list[Container]) -> tuple[int, float]:
    """The path of the container with the best score, outermost of equals."""
    scores: Counter = Counter()
    for text, link_chars, c in found:
        worth = max(0.0, len(text) - 2.0 * link_chars)
        scores[c.no] += worth
        if c.up:
            scores[c.up.no] += worth / 2
    best, most = 0, 0.0
    for c in containers:
        score = scores[c.no] * (1.5 if c.tag in ("article", "main") else 1.0)
        if score > most:
            best, most = c.path, score
    return best, most


def extract(found: list, containers: list[Container], paths) -> str:
    """Text of the outermost containers with one of the paths, else of the page's best one."""
    wanted = set(paths or ()) & {c.path for c in containers}
    if not wanted:
        wanted = {best_path(found, containers)[0]}
    within: dict[int, bool] = {}
    for c in containers:  # outer ones first
        up = c.up
        while up is not None and up.no not in within:
            up = up.up
        within[c.no] = c.path in wanted or (up is not None and within[up.no])
    return " ".join(text for text, _, c in found if within.get(c.no, False))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        best = [best_path(*blocks(h.as_py() or "")) for h in b.column("html")]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array([p - (1 << 63) for p, _ in best], pa.int64()), pa.array([s for _, s in best], pa.float64())],
                                         names=["host", "path", "score"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(*blocks(h.as_py() or ""), [x + (1 << 63) for x in p.as_py() or ()]) for h, p in zip(b.column("html"), b.column("paths"))]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host():
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.lower(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")))


def consensus(pages: DataFrame, share: float = 0.1) -> DataFrame:
    """host and its winning paths: those with at least ``share`` of the host's votes."""
    votes = bounded(pages).select(host().alias("host"), "html").mapInArrow(_votes, "host string, path bigint, score double").filter("score > 0")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("n"))
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    return counted.join(total, "host").filter(F.col("n") >= share * F.col("total")).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def main_text(pages: DataFrame, share: float = 0.1) -> DataFrame:
    """page_id, url, text of every row."""
    paths = saved(consensus(pages, share).withColumnRenamed("host", "of_host"), "paths")
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    joined = rows.join(paths, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(_texts, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string")
