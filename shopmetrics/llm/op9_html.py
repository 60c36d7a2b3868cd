"""Main text of web pages by consensus host paths.

1. Every page's containers are scored alone: the text they hold outside boilerplate parts
   and links.  The page votes for its article or main element, if that holds at least
   ``SHARE`` of this text and nearly all that is in such elements; else for the smallest
   container that holds all of it.  The vote is the generalised path: the tag and
   classes of each element from the body down, digits folded, ids left out.
2. Votes are summed per host in Spark, as (host, path) counts before any exchange; a host's
   path is the one with most votes (ties: least path).
3. Every page is extracted again, with its host's path.  A page on which that path holds
   less than ``SHARE`` of the text of its own vote falls back to that.

A page is parsed by one pass over its tags, tolerant of unclosed and stray ones.  Text is
cut into blocks at block-level tags; character references are decoded, white space in a
block becomes one space, and blocks are joined by a blank line.  Navigation, headers,
footers, asides, forms, scripts, styles, and elements of which a whole class, id or role
names a menu, side bar, notice, advert or comment are left out.  Such a name never drops the
body or a main element, nor one that holds a main element or an article, nor, on a page
without these, one that holds most of the text; a page that comes out empty is read again
without names.

Defined cases: null or empty html gives an empty text; a page without markup is one block;
a null url is a host of its own (the empty one); repeated rows and null ids each get a row;
an empty table gives no rows; other columns are ignored, whatever their names; very long,
deeply nested or unclosed pages cost time in proportion to their length: every character is
scanned a fixed number of times, blocks know only their innermost container, and chars are
added up from the inner containers to the outer ones once.  A header element is left out
wherever it stands, inside an article too, with the title it may hold.  A host with a third of
all pages is only a larger vote count.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SHARE = 0.6
NEARLY = 0.95
RAW = re.compile(r"<(script|style|noscript|template|textarea|select|svg|iframe|object|title)\b", re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
DELIMITER = re.compile("[>\"']")
#: Name and value of an attribute, or a quoted part or character that is none.
ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'|.""", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul").split())
DROPPED = frozenset("nav header footer aside form button head dialog menu fieldset label".split())
CONTAINERS = frozenset("article body div main section td".split())
INLINE = frozenset("p b i em strong span a u font small".split())
#: An open one of these ends when the next of its group starts.
SIBLINGS = {t: g for g in (("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for t in g}
NOTICE = (r"(?:nav(?:bar|igation)?|menu|header|masthead|footer|side-?bar|aside|notice|cookies?|consent|gdpr|banner|ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?"
          r"|promo|popup|modal|overlay|share|social|related|recommend(?:ed|ations)?|comments?|respond|discussion|disqus|breadcrumbs?|pagination|pager|newsletter|subscribe"
          r"|signup|login|search|widget|toolbar|skip|copyright|legal|alert|contentinfo|complementary|search-?form)")
#: May stand beside such a word in one class: site-footer is boilerplate, has-sidebar is a layout.
NEUTRAL = r"(?:site|top|bottom|left|right|main|primary|secondary|list|box|bar|area|block|\d+)"
BOILERPLATE = re.compile(rf"(?:^|\s)(?:{NEUTRAL}[_-]+)*{NOTICE}(?:[_-]+(?:{NOTICE}|{NEUTRAL}))*(?:$|\s)", re.I)


class Page:
    """Containers and blocks of one page.

    Container i has a parent (-1: none), a path number and the chars outside links in it; paths
    are numbered by (path of the parent, label), so that depth costs nothing.
    """

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {(-1, "body"): 0}
        self.labels: list[tuple[int, str, int, bool]] = [(-1, "body", 0, False)]  # parent path, label, depth, in an article or main
        self.parent, self.path, self.tag, self.chars = [-1], [0], ["body"], [0]
        self.blocks: list[tuple[str, int, int]] = []  # text, chars outside links, container

    def open(self, parent: int, tag: str, label: str) -> int:
        up = self.path[parent]
        number = self.numbers.setdefault((up, label), len(self.labels))
        if number == len(self.labels):
            _, _, depth, inner = self.labels[up]
            self.labels.append((up, label, depth + 1, inner or self.tag[parent] in ("article", "main")))
        self.parent.append(parent)
        self.path.append(number)
        self.tag.append(tag)
        self.chars.append(0)
        return len(self.parent) - 1

    def add_up(self) -> None:
        """Chars of every container, those of its inner containers included."""
        for _, chars, node in self.blocks:
            self.chars[node] += chars
        for node in range(len(self.parent) - 1, 0, -1):
            self.chars[self.parent[node]] += self.chars[node]

    def path_text(self, number: int) -> str:
        steps = []
        while number >= 0:
            number, label = self.labels[number][:2]
            steps.append(label)
        return ">".join(reversed(steps))

    def path_number(self, path: str | None) -> int:
        """Number of a path, -1 where the page has none such."""
        at = -1
        for label in path.split(">") if path else ():
            at = self.numbers.get((at, label), -2)
            if at < 0:
                return -1
        return at


def tokens(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" of an end tag, tag, attributes) of each tag; tag "" of what is only skipped,
    "!" of a comment or declaration.

    A ``<`` whose tag never ends is text.  Nothing is read twice: the next delimiter is kept, and
    quotes from which no end was found are remembered.
    """
    last = html.rfind(">")
    failed: set[int] = set()
    seen_from = seen_to = -1  # no delimiter between these places but at the second

    def tag_end(at: int) -> int:
        nonlocal seen_from, seen_to
        trail = []
        while at <= last:
            if not seen_from <= at <= seen_to:
                seen_from, seen_to = at, DELIMITER.search(html, at).start()
            q = seen_to
            if html[q] == ">":
                return q
            shut = -1 if q in failed else html.find(html[q], q + 1)
            trail.append(q)
            if shut < 0:
                break
            at = shut + 1
        failed.update(trail)
        return -1

    at = html.find("<")
    while at >= 0:
        raw = RAW.match(html, at)
        end, tag = -1, None
        if html.startswith("<!--", at):
            shut = html.find("-->", at + 4)
            end, tag = (shut + 3 if shut >= 0 else len(html)), ("", "!", "")
        elif raw and at < last:
            inner = html.find(">", raw.end()) + 1
            shut = re.compile(rf"</{raw[1]}\s*>", re.I).search(html, inner)
            end, tag = (shut.end() if shut else len(html)), ("", "", "")
        elif html.startswith(("<!", "<?"), at) and at < last:
            end, tag = html.find(">", at) + 1, ("", "!", "")
        elif m := TAG.match(html, at):
            shut = tag_end(m.end())
            if shut >= 0:
                end, tag = shut + 1, (m[1], m[2].lower(), html[m.end():shut])
        if end > 0:
            yield at, end, *tag
        at = html.find("<", max(end, at + 1))


def parse(html: str) -> Page:
    """Blocks and containers of a page, boilerplate parts left out."""
    page, spared, named = _scan(html, frozenset(), True)
    if spared:
        page, _, named = _scan(html, spared, True)
    if named and not page.blocks:
        page, _, _ = _scan(html, frozenset(), False)
    page.add_up()
    return page


def _scan(html: str, keep: frozenset[int], names: bool) -> tuple[Page, frozenset[int], bool]:
    """The page, the places of elements that names dropped wrongly, and whether names dropped any.

    ``keep`` has places that names must not drop; without ``names`` only tags do.
    """
    page = Page()
    stack: list[tuple[str, int, bool, int]] = []  # tag, container or -1, starts a dropped part, index in ``found`` or -1
    places: dict[str, list[int]] = {}  # of each open tag: where it is on the stack
    solid: list[int] = []  # where block elements and cells are
    found: list[list[int]] = []  # of each element dropped by name: its place, chars and articles in it
    hard = lost = articles = 0  # open parts dropped by tag; chars dropped by name; main elements and articles
    kept = 0  # chars of blocks, outside links
    held = [0]
    parts: list[str] = []
    linked = dropped = links = 0

    def flush() -> None:
        nonlocal parts, linked, kept
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                page.blocks.append((text, max(0, len(text) - linked), held[-1]))
                kept += page.blocks[-1][1]
            parts, linked = [], 0

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def close(upto: int) -> None:
        nonlocal dropped, links, hard
        while len(stack) > upto:
            tag, node, drop, place = stack.pop()
            places[tag].pop()
            if solid and solid[-1] == len(stack):
                solid.pop()
            if place >= 0:
                found[place][1:] = lost - found[place][1], articles - found[place][2]
            hard -= drop and place < 0
            if tag in BLOCKS:
                flush()
            if node >= 0:
                held.pop()
            dropped -= drop
            links -= tag == "a"

    at = 0
    for start, end, slash, tag, rest in tokens(html):
        if start > at and not dropped:
            piece = html[at:start]
            parts.append(piece)
            if links:
                linked += len(piece)
        elif not hard and not links:
            lost += sum(map(len, html[at:start].split()))
        at = end
        if tag in ("", "!"):
            if not dropped and not tag:
                parts.append(" ")
            continue
        if slash:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCKS:
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not dropped:
                parts.append(" " if tag in ("br", "wbr", "img") else "")
            continue
        if tag in BLOCKS:
            flush()
            # a block ends an open paragraph and the inline elements in it
            if stack and stack[-1][0] in INLINE and solid and stack[solid[-1]][0] == "p":
                close(solid[-1])
        if tag in SIBLINGS:
            i = nearest(SIBLINGS[tag])
            if i > nearest(("ul", "ol", "table", "dl")):
                close(i)
        if tag in ("td", "th"):
            parts.append(" ")
        if tag == "html":
            continue
        attrs = {m[1].lower(): m[2].strip("\"'") for m in ATTR.finditer(rest) if m[2] and m[1].lower() in ("class", "id", "role")} if "=" in rest else {}
        named = names and tag not in ("body", "main") and tag not in DROPPED and any(BOILERPLATE.search(v) for v in attrs.values()) and start not in keep
        drop = named or tag in DROPPED
        articles += tag in ("article", "main") and not named and not hard
        if drop:
            flush()
        if rest.endswith("/") and tag not in BLOCKS:
            continue
        node = -1
        if tag in CONTAINERS and not drop and not dropped and tag != "body":
            classes = ".".join(re.sub(r"\d+", "#", re.sub("[.>]", "_", c)) for c in sorted(attrs.get("class", "").split()))
            node = page.open(held[-1], tag, f"{tag}{'.' + classes if classes else ''}")
            held.append(node)
        place = -1
        if named:
            place = len(found)
            found.append([start, lost, articles])
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS or tag in ("td", "th"):
            solid.append(len(stack))
        stack.append((tag, node, drop, place))
        dropped += drop
        hard += drop and not named
        links += tag == "a"
    if at < len(html) and not dropped:
        parts.append(html[at:])
    elif not hard and not links:
        lost += sum(map(len, html[at:].split()))
    close(0)
    flush()
    most = (kept + lost) / 2
    return page, frozenset(p for p, chars, held_articles in found if held_articles or (not articles and chars > most)), bool(found)


def vote(page: Page) -> int:
    """Path number of the container that a page alone would choose."""
    total = page.chars[0]
    named: dict[int, int] = {}
    for tag, path, chars in zip(page.tag, page.path, page.chars, strict=True):
        if tag in ("article", "main"):
            named[path] = named.get(path, 0) + chars
    outer = sum(chars for path, chars in named.items() if not page.labels[path][3])
    good = [path for path, chars in named.items() if total and chars >= SHARE * total and chars >= NEARLY * outer]
    if not good:
        good = [path for path, chars in zip(page.path, page.chars, strict=True) if chars == total] if total else [0]
    return max(good, key=lambda path: page.labels[path][2])


def extract(html: str, path: str | None) -> str:
    """Main text: the blocks in containers of ``path``, or of the page's own vote."""
    page = parse(html)

    def under(path: int) -> list[tuple[str, int]]:
        inside = []  # parents come before what they hold
        for node, up in enumerate(page.parent):
            inside.append(page.path[node] == path or (up >= 0 and inside[up]))
        return [(text, chars) for text, chars, node in page.blocks if inside[node]]

    found, own = under(page.path_number(path)), under(vote(page))
    if not found or sum(n for _, n in found) < SHARE * sum(n for _, n in own):
        found = own
    return "\n\n".join(text for text, _ in found)


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the consensus of each host's pages."""
    def ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages_of = [parse(h.as_py() or "") for h in b.column(1)]
            paths = [p.path_text(vote(p)) for p in pages_of]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string())], names=["host", "path"])

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(ballots, "host string, path string")
    counted = cast.groupBy("host", "path").agg(F.count("*").alias("votes"))
    return counted.groupBy("host").agg(F.min(F.struct(-F.col("votes"), "path")).alias("w")).select("host", F.col("w.path").alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    # written, so that Spark knows its size: broadcast when small, else a split join
    winners = C.materialize(host_paths(pages), "host-paths").select(F.col("host").alias("w_host"), "path")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    rows = rows.join(winners, F.col("host") == F.col("w_host"), "left").select("page_id", "url", "path", "html")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [extract(h.as_py() or "", p.as_py()) for h, p in zip(b.column(3), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(texts, "page_id long, url string, text string")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(C.table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
