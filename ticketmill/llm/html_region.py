"""Main text of web pages: the best contiguous region of a token stream.

A page becomes a stream of words and tags. Words score positive and tags negative, with
weights learned from labelled pages; words of page furniture (menus, headers, footers,
sidebars, notices, adverts, forms, reader comments, by element or by class, id and role
names) are a kind of their own and come out strongly negative. One linear scan finds the
contiguous region of the highest sum (Pasternack and Roth 2009); its words, without
furniture inside it, are the text.

Scripts, styles, comments and other raw elements never enter the stream. Character references
are decoded; white space inside a block becomes one space, blocks are trimmed and joined by
one space; inline tags do not part words. A name says nothing on an element that holds most of the
page's words and a headline or article, or nearly all words and only names of layout: that is a wrapper.

Null and empty pages give an empty text, as do pages without a region of positive sum. Of regions
of equal sum the earliest is taken. Rows that repeat a page are each extracted; an empty table gives
no rows; extra columns are ignored, whatever their names. Very long pages are read whole, in time that
grows with their length: end tags are looked up by a count of open names, an attribute list of more
than ``ATTRIBUTES`` parts is read without regard to quotes.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED_PAGES = 1000
SMOOTHING = 1.0
LEAST_TAG_COST = 0.1
LEAST_WORD_GAIN = 0.2

ATTRIBUTES = 200
MOST, NEARLY_ALL = 0.5, 0.8

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|math|iframe|object|select|textarea|title|canvas|audio|video"
FURNITURE_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
BODY_TAGS = frozenset("html body main article".split())
# Fixed word list: names that sites give to page furniture.
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion popup modal overlay "
    "cookie cookies consent gdpr notice alert nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager "
    "header masthead topbar toolbar footer foot copyright sidebar side aside rail widget widgets related recommended "
    "share sharing social follow newsletter subscribe signup login search form comment comments commentlist disqus reply "
    "replies respond skip hidden contentinfo complementary".split())
# Those that also tell how a page is laid out ("with-sidebar", "header-fixed").
LAYOUT_NAMES = frozenset(
    "banner nav navbar navigation menu header topbar toolbar footer sidebar side rail widget widgets search form".split())
CONTENT_NAMES = frozenset("content article main post entry story body text".split())
KNOWN_TAGS = frozenset(
    "a article b blockquote body br code dd div dl dt em figcaption figure h1 h2 h3 h4 h5 h6 header hr i img li main ol p pre "
    "section span strong table tbody td th thead tr u ul".split()) | FURNITURE_TAGS
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)|<[!?][^>]*+>"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'){{0,{ATTRIBUTES}}}+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>", re.I | re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def furniture_names(name: str, attrs: str, inside_article: bool) -> frozenset | None:
    """What makes an element furniture: its names, an empty set if nothing can excuse it, None if nothing does."""
    if name in BODY_TAGS:
        return None
    if name == "form":
        return frozenset(["form"])
    if name in FURNITURE_TAGS or name == "header" and not inside_article:
        return frozenset()
    if "=" not in attrs and "hidden" not in attrs:
        return None
    if HIDDEN.search(attrs):
        return frozenset()
    found = set()
    for parts in NAMED.findall(attrs):
        for value in "".join(parts).split():
            words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())
            if not CONTENT_NAMES.intersection(words):
                found |= FURNITURE_NAMES.intersection(words)
    return frozenset(found) or None


class Element:
    """An open tag: what speaks against it, and the words and headlines of the page before and after it."""

    __slots__ = ("name", "names", "words", "heads")

    def __init__(self, name: str, names: frozenset | None, words: int, heads: int):
        self.name, self.names, self.words, self.heads = name, names, -words, -heads

    def is_furniture(self, words: int) -> bool:
        if not self.names:
            return self.names is not None
        wraps = self.heads > 0 and self.words >= MOST * words or self.words >= NEARLY_ALL * words and self.names <= LAYOUT_NAMES
        return not (wraps and self.words > 0)


def events(page: str) -> tuple[list[tuple], int]:
    """The page as (what, value, inside an article): text, tag, open or close of an element; and its number of words."""
    out: list[tuple] = []
    stack: list[Element] = []
    open_names: Counter = Counter()
    articles = words = heads = at = 0
    hidden = False

    def text(upto: int):
        nonlocal words
        if upto > at and (piece := page[at:upto]):
            piece = html.unescape(piece) if "&" in piece else piece
            words += len(piece.split())
            out.append(("text", piece, articles > 0))

    def pop():
        nonlocal articles
        e = stack.pop()
        open_names[e.name] -= 1
        articles -= e.name in ("article", "main")
        e.words += words
        e.heads += heads
        out.append(("close", e, articles > 0))

    # Nothing behind the last bracket can be a tag, and looking there for one would never end.
    for m in TOKEN.finditer(page, 0, page.rfind(">") + 1):
        text(m.start())
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            # A comment or raw element that nothing ends holds the rest of the page.
            shut = f"</{m['raw'].lower()}" in m[0].lower() if m["raw"] else not m[0].startswith("<!--") or m[0].endswith("-->")
            hidden = not shut
            if m["raw"] and m["raw"].lower() in ("select", "textarea", "object", "iframe", "video", "audio"):
                out.append(("tag", m["raw"].lower(), articles > 0))
            continue
        name = name.lower()
        shown = "~" + name if name in INLINE else name
        if m["end"] or m["end2"]:
            if open_names[name]:
                while stack[-1].name != name:
                    pop()
                out.append(("tag", shown, articles > 0))
                pop()
            continue
        if name == "body" or name == "html":
            continue
        heads += name in ("article", "main", "h1")
        if name not in VOID:
            e = Element(name, furniture_names(name, m["attrs"] or m["attrs2"] or "", articles > 0), words, heads)
            stack.append(e)
            open_names[name] += 1
            articles += name in ("article", "main")
            out.append(("open", e, articles > 0))
        out.append(("tag", shown, articles > 0))
    rest = page[at:]
    if hidden:
        rest = ""
    page = page[:at] + rest.partition("<!--")[0]
    text(len(page))
    while stack:
        pop()
    return out, words


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, payload, inside an article): kind is ``tag``, ``word``, ``link`` or ``chrome``.

    The payload is a tag name or a stretch of decoded text; a tag that parts words has its
    name, one that does not has the name after a ``~``.
    """
    found, words = events(page)
    furniture = links = 0
    for what, value, inside in found:
        if what == "text":
            yield "chrome" if furniture else "link" if links else "word", value, inside
        elif what == "tag":
            yield "tag", value, inside
        else:
            step = 1 if what == "open" else -1
            furniture += step * value.is_furniture(words)
            links += step * (value.name == "a")


def key(kind: str, payload: str) -> str:
    if kind != "tag":
        return kind
    name = payload.lstrip("~")
    return f"<{name}>" if name in KNOWN_TAGS else "<other>"


def weight_of(kind: str, payload: str) -> int:
    """How often a token counts: text by its words, but a stretch of furniture once.

    Furniture inside an article must not outweigh the paragraphs beside it.
    """
    if kind == "tag":
        return 1
    return len(payload.split()) if kind != "chrome" else 1 if payload.strip() else 0


def token_counts(page: str) -> tuple[Counter, Counter]:
    """Tokens inside and outside the labelled region of one page."""
    inside, outside = Counter(), Counter()
    for kind, payload, labelled in tokens(page):
        (inside if labelled and kind != "chrome" else outside)[key(kind, payload)] += weight_of(kind, payload)
    return inside, outside


def weights_of(inside: dict[str, float], outside: dict[str, float]) -> dict[str, float]:
    """Log odds of each kind of token, plain words held positive and tags negative."""
    kinds = {"word", "link", "chrome", "<other>", *(f"<{t}>" for t in KNOWN_TAGS)}
    a = sum(inside.values()) + SMOOTHING * len(kinds)
    b = sum(outside.values()) + SMOOTHING * len(kinds)
    out = {}
    for k in kinds:
        odds = math.log((inside.get(k, 0) + SMOOTHING) / a) - math.log((outside.get(k, 0) + SMOOTHING) / b)
        out[k] = min(-LEAST_TAG_COST, odds) if k[0] == "<" or k == "chrome" else odds
    out["word"] = max(LEAST_WORD_GAIN, out["word"])
    out["chrome"] = min(-1.0, out["chrome"])
    return out


def learn(pages: DataFrame, labelled_pages: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from pages whose own markup labels their main text (``article`` or ``main``).

    About ``labelled_pages`` of them are read, chosen by a hash of the page; the driver gets
    two numbers for each kind of token.
    """
    marked = pages.select("html").filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    total = marked.count()
    place = F.pmod(F.xxhash64("html"), F.lit(1_000_000)) / F.lit(1e6)
    some = marked.filter(place < min(1.0, labelled_pages / max(total, 1)))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            inside, outside = Counter(), Counter()
            for page in batch.column(0).to_pylist():
                a, b = token_counts(page)
                inside.update(a)
                outside.update(b)
            kinds = sorted({*inside, *outside})
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
                 pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "inside", "outside"])

    rows = some.mapInArrow(count, "kind string, inside long, outside long").groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return weights_of({r["kind"]: r["inside"] for r in rows}, {r["kind"]: r["outside"] for r in rows})


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the region with the highest sum; the earliest of equal ones."""
    if not page:
        return ""
    stream, best, best_sum, start, running = [], (0, 0), 0.0, 0, 0.0
    for kind, payload, _ in tokens(page):
        times = weight_of(kind, payload)
        stream.append((kind, payload))
        if times:
            running += times * weights[key(kind, payload)]
            if running <= 0:
                running, start = 0.0, len(stream)
            elif running > best_sum:
                best_sum, best = running, (start, len(stream))
    parts: list[str] = []
    for kind, payload in stream[best[0]:best[1]]:
        if kind == "tag":
            if payload[0] != "~":
                parts.append(" ")
        elif kind != "chrome":
            parts.append(payload)
        elif parts and parts[-1] != " ":
            parts.append(" ")
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points of ``text``) of every page."""
    weights = learn(pages) if weights is None else weights

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:

        for column in parts:
            yield pd.Series([main_text(p, weights) for p in column])

    return pages.select("page_id", "url", run("html").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
