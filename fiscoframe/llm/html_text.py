"""Main text of web pages by line-block distribution.

Markup is stripped so that every block element with text becomes one line.  Lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments are emptied, and so are lines outside the article
where the page marks one; then nothing else goes, however short.  On a page that marks none, the lengths of the lines' text
outside links are summed over sliding windows; the text begins where this sum surges to a share of its largest value and ends
where it dives below it for good, with the headings, paragraphs and sentences next to it.

Where the page marks no article outside such elements, forms and elements that only a class or id tells are no
boilerplate if they hold more than half of the text, a main element, or an article with
at least as much text as stands outside all of them.

A null or empty page has an empty text.  Repeated pages are extracted each.  Unclosed elements end with
their parent or the page.  Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices, ship

ship(__name__)

#: Lines that one window sums over; the share of the densest window's text that is dense; text below which a page has no stretch.
WINDOW, THIN, LEAST = 3, 0.2, 200
#: Elements and ends of lines that belong to a dense stretch next to them.
NEXT_TO, ENDS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote figcaption pre td dd".split()), (".", "!", "?", "…", ":", '."', ".”", ".)")

# Names of HTML elements and words that mark what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
OMITTED = frozenset("head nav header footer aside form menu dialog button select textarea noscript template iframe object svg canvas audio video map datalist search".split())
RAW = ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts adv banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

NAME = re.compile(r"<(/?[a-zA-Z][^\s/>]*)")
DELIMITER = re.compile(r"[>\"']")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
NAMES = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ROLE = re.compile(r"\brole\s*=\s*[\"']?([a-z]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z]+")
#: First words of class names that state something about an element's surroundings.
STATES = frozenset("has have no not with without is hide show".split())
SOFT, HARD = 1, 2
CLOSES_P = BLOCKS - {"option", "optgroup", "caption", "legend", "summary"}


def omitted(name: str, attributes: str) -> int:
    """Whether an element is not part of an article: SOFT if only a class, an id or a form says so, HARD if more does, else 0."""
    if name in OMITTED:
        return SOFT if name == "form" and not HIDDEN.search(attributes) else HARD
    if not attributes or name in ("html", "body", "article", "main"):
        return 0
    role = ROLE.search(attributes)
    if role and role[1].lower() in ROLES or HIDDEN.search(attributes):
        return HARD
    for found in NAMES.findall(attributes):
        for token in "".join(found).lower().split():
            words = WORD.findall(token)
            if words and (words[0] in BOILERPLATE or words[-1] in BOILERPLATE and words[0] not in STATES):
                return SOFT
    return 0


def parts_of(page: str) -> Iterator[tuple[str, str, str]]:
    """(name, attributes, text): tags with a name (``/name`` for a closing one) and text without; each character is passed once.

    What follows an unclosed tag, comment or raw element is dropped.  Once a quote is found that never closes, quotes no longer
    hide the end of a tag.
    """
    at, quoted = 0, True

    def tag_end(start: int) -> int:
        nonlocal quoted
        here = start
        while quoted and (found := DELIMITER.search(page, here)):
            if found[0] == ">":
                return found.start()
            here = page.find(found[0], found.end()) + 1
            if not here:
                quoted = False
        return page.find(">", start)

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            begin = len(page)
        if begin > at:
            yield "", "", page[at:begin]
        at = begin
        named = NAME.match(page, at)
        if named:
            end = tag_end(named.end())
            if end < 0:
                return
            name, at = named[1].lower(), end + 1
            if name in RAW:
                closed = RAW_END[name].search(page, at)
                if closed is None:
                    return
                at = closed.end()
            else:
                yield name, page[named.end() : end], ""
        elif page.startswith("<!--", at) or page[at + 1 : at + 2] in ("!", "?", "/"):
            mark = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(mark, at)
            if end < 0:
                return
            at = end + len(mark)
        elif at < len(page):
            yield "", "", "<"
            at += 1


class Chains:
    """Sets of elements around a place as linked nodes: each new node adds one element to the set of its parent."""

    def __init__(self):
        self.parent: list[int] = []
        self.item: list = []

    def add(self, parent: int, item) -> int:
        self.parent.append(parent)
        self.item.append(item)
        return len(self.item) - 1

    def down(self, first, step) -> list:
        """A value of each node from that of its parent (``first`` for none); the last one is for no node at all, index -1."""
        out = [first] * (len(self.item) + 1)
        for node, (parent, item) in enumerate(zip(self.parent, self.item, strict=True)):
            out[node] = step(out[parent], node, item)
        return out

    def up(self, own: list[int]) -> list[int]:
        """Sums over each node and all below it."""
        for node in range(len(self.item) - 1, -1, -1):
            if self.parent[node] >= 0:
                own[self.parent[node]] += own[node]
        return own


@dataclass
class Line:
    text: str
    around: int
    within: int
    element: str
    linked: int


def lines_of(page: str) -> tuple[list[Line], list[bool], bool]:
    """Lines of the page, whether each may be part of the article by the names around it, and whether an article is marked."""
    lines: list[Line] = []
    run: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, omitted elements and articles around it and itself
    opened: dict[str, list[int]] = {}
    omits, articles = Chains(), Chains()  # omitted elements with their kind, articles with their name and what is omitted around them
    around = within = -1
    anchor, linked = False, 0

    def flush():
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                lines.append(Line(text, around, within, stack[-1][0] if stack else "", linked))
            run.clear()
        linked = 0

    def push(name: str, kind: int):
        nonlocal around, within
        if name in ("article", "main"):
            within = articles.add(within, (name, around))
        if kind:
            around = omits.add(around, kind)
        opened.setdefault(name, []).append(len(stack))
        stack.append((name, around, within))

    def close(k: int):
        nonlocal around, within
        while len(stack) > k:
            opened[stack.pop()[0]].pop()
        _, around, within = stack[-1] if stack else ("", -1, -1)

    for tag, attributes, text in parts_of(page):
        if not tag:
            run.append(text)
            linked += len(text.strip()) if anchor else 0
            continue
        closing, name = tag[0] == "/", tag.lstrip("/")
        if name == "br":
            run.append(" ")
            continue
        place = opened.get(name) or [None]
        if name not in BLOCKS and name not in OMITTED:
            anchor = not closing if name == "a" else anchor
            if closing and place[-1] is not None:
                flush()
                close(place[-1])
            elif not closing and name not in VOID and not attributes.endswith("/") and (kind := omitted(name, attributes)):
                flush()
                push(name, kind)
            continue
        flush()
        if closing:
            if place[-1] is not None:
                close(place[-1])
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if stack and stack[-1][0] == "p" and name in CLOSES_P or stack and stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close(len(stack) - 1)
        push(name, omitted(name, attributes))
    flush()
    lifted = set() if any(where < 0 for _, where in articles.item) else misnamed(lines, omits, articles)
    free = omits.down(True, lambda before, node, _: before and node in lifted)
    marked = articles.down(False, lambda before, _, item: before or free[item[1]])
    return lines, [free[line.around] and (marked[line.within] or not any(marked)) for line in lines], any(marked)


def misnamed(lines: list[Line], omits: Chains, articles: Chains) -> set[int]:
    """SOFT elements that hold the article or most of the text."""
    hard = omits.down(False, lambda before, _, kind: before or kind == HARD)
    held, of_article, total, outside = [0] * len(omits.item), [0] * len(articles.item), 0, 0
    for line in lines:
        if hard[line.around]:
            continue
        size = len(line.text)
        total += size
        if line.around >= 0:
            held[line.around] += size
        else:
            outside += size
        if line.within >= 0:
            of_article[line.within] += size
    out = {k for k, n in enumerate(omits.up(held)) if 2 * n > total}
    for (name, where), n in zip(articles.item, articles.up(of_article), strict=True):
        if n and (name == "main" or n >= outside) and not hard[where]:
            while where >= 0 and where not in out:
                out.add(where)
                where = omits.parent[where]
    return out


def dense_stretch(lines: list[Line], window: int = WINDOW) -> tuple[int, int]:
    """Surge and dive point: from where the text in a window of lines first reaches a share of the densest window's to where it last does.

    Text of links does not count.  The point is the outermost line of the window that carries its part.  Headings, paragraphs and
    sentences next to the stretch belong to it, as far as nothing else comes between.  Where no window holds much
    text, all lines are the stretch.
    """
    weight = [max(0, len(line.text) - line.linked) for line in lines]
    sums = [sum(weight[i : i + window]) for i in range(max(1, len(weight) - window + 1))]
    most = max(sums, default=0)
    if most < LEAST:
        return 0, len(lines)
    least = THIN * most
    full = [i for i, n in enumerate(sums) if n >= least]
    start = next(i for i in range(full[0], len(lines)) if weight[i] * window >= least)
    end = next(i for i in range(min(len(lines), full[-1] + window) - 1, -1, -1) if weight[i] * window >= least) + 1

    def joins(line: Line) -> bool:
        return line.element in NEXT_TO and 2 * line.linked < len(line.text) or line.text.endswith(ENDS)

    while start and joins(lines[start - 1]):
        start -= 1
    while end < len(lines) and joins(lines[end]):
        end += 1
    return start, end


def main_text(page: str) -> str:
    lines, allowed, marked = lines_of(page)
    kept = [line for line, ok in zip(lines, allowed, strict=True) if ok]
    surge, dive = (0, len(kept)) if marked else dense_stretch(kept)
    return "\n".join(line.text for line in kept[surge:dive])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every whole page."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(p) for p in piece.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [piece.column("page_id"), piece.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return map_slices(rows, work, "page_id long, url string, text string, n_chars long", column="html")
