"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph passes points (one, less if it has
under 25 characters, and one more for each comma and each hundred characters) to the element around it, half
of them to the next one, and so on; an element's points are discounted by the
share of its characters that stand in links. The best container and those of
its siblings that score well are kept, without the parts that are marked as
menus, headers, footers, sidebars, notices, adverts, forms or reader comments.

Blocks keep the order of the page; inside a block references are decoded and
white space (Python's ``str.split``, a line break element too) becomes one
space; blocks are joined by a newline. Nothing of what is kept is cut.

Defined cases: null or empty html, or a page with no text outside the dropped
parts, gives an empty text; nulls in other columns are kept; repeated rows
each get their row; an unclosed comment or script hides what follows; other
columns are ignored. A page is worked on as a whole, in time linear in it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content, pieces

# Fixed values of the HTML standard: kinds of elements.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
    option p pre section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: What a start tag closes, and the element it does not look beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

#: Elements, roles and words of class or id that mark what is no article.
DROPPED = frozenset("""head script style noscript template svg math iframe object embed canvas audio video nav header
    footer aside form button select option textarea dialog menu xmp noembed noframes title""".split())
ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar""".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
UNLIKELY = COMMENTS | frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion
    banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies
    consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login
    share sharing social related recommended recommendations trending widget toolbar pagination pager skiplink
    feedback search copyright paywall""".split())
LIKELY = frozenset("article body content entry main post story text".split())
WHOLE = frozenset("html body main article".split())

TOKEN = re.compile(r"<!--(?:.*?-->|.*+)|<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>?"
                   r"|</([a-zA-Z][^\s/>]*+)[^>]*+>?|<[!?/][^>]*+>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in RAW}
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
TELLING = re.compile(r"(?i)class|id\b|role|hidden|style")


def marked(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether the attributes mark an element as no article, and as likely one."""
    if not attributes or not TELLING.search(attributes):
        return False, False
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" \
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")) is not None
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in WORD.findall(names)}
    likely = bool(words & LIKELY)
    against = words & UNLIKELY
    if likely:  # the head of an article, or a layout that only names a sidebar
        against -= {"header"}
        if words & {"with", "has", "no"}:
            against &= COMMENTS
    if tag in WHOLE:
        against = against & COMMENTS if tag == "article" else set()
    return hidden or bool(against) or found.get("role", "").lower() in ROLES, likely and not against


class Page:
    """The elements of one page in page order, so that a subtree is a range of
    them, and its runs of text: (element, text), with None where a block ends."""

    def __init__(self, source: str):
        self.tags, self.parents, self.ends = ["#page"], [0], [0]
        self.hinted, self.likely, self.banned = [False], [False], [False]
        self.runs: list[tuple[int, str | None]] = []
        self.open, self.count = [0], Counter()
        at = 0
        while at < len(source):
            m = TOKEN.search(source, at)
            text = source[at:m.start() if m else len(source)]
            if text:
                self.runs.append((self.open[-1], html.unescape(text) if "&" in text else text))
            if not m:
                break
            at = m.end()
            if m[1]:
                name = m[1].lower()
                self.start(name, m[2])
                if name in RAW:
                    end = ENDS[name].search(source, at)
                    at = end.start() if end else len(source)
            elif m[3]:
                self.end(m[3].lower())
        while self.open:
            self.pop()

    def pop(self) -> None:
        node = self.open.pop()
        self.ends[node] = len(self.tags)
        self.count[self.tags[node]] -= 1
        if self.tags[node] in BLOCK:
            self.runs.append((node, None))

    def pop_to(self, names: set[str], beyond: set[str] | frozenset[str]) -> None:
        """Closes the nearest open element of ``names``, unless one of ``beyond`` is nearer."""
        if any(self.count[n] > 0 for n in names):
            for k in range(len(self.open) - 1, 0, -1):
                tag = self.tags[self.open[k]]
                if tag in names:
                    while len(self.open) > k:
                        self.pop()
                    return
                if tag in beyond:
                    return

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and self.count[tag] > 0:
            return
        if self.count["head"] > 0 and tag not in IN_HEAD:
            self.pop_to({"head"}, frozenset())
        if tag in BLOCK:
            self.pop_to({"p"}, BLOCK - {"p"})
            if tag in CLOSES:
                self.pop_to(*CLOSES[tag])
            self.runs.append((self.open[-1], None))
        elif tag == "br":
            self.runs.append((self.open[-1], " "))
        if tag in VOID:
            return
        node, parent = len(self.tags), self.open[-1]
        unlikely, likely = marked(tag, attributes)
        self.tags.append(tag)
        self.parents.append(parent)
        self.ends.append(0)
        self.banned.append(self.banned[parent] or tag in DROPPED)
        self.hinted.append(self.hinted[parent] or unlikely)
        self.likely.append(likely or tag in ("article", "main"))
        self.open.append(node)
        self.count[tag] += 1

    def end(self, tag: str) -> None:
        if tag not in ("body", "html"):
            self.pop_to({tag}, frozenset() if tag in BLOCK else BLOCK)


def blocks(page: Page, inside: list[tuple[int, int]], dropped: list[bool]) -> Iterator[tuple[int, str]]:
    """(element, text) of every block with text in the ranges of elements, in page order."""
    parts: list[str] = []
    first = 0
    for node, text in page.runs:
        if text is None:
            if parts:
                whole = " ".join("".join(parts).split())
                if whole:
                    yield first, whole
                parts = []
        elif not dropped[node] and any(a <= node < b for a, b in inside):
            if not parts:
                first = node
            parts.append(text)
    whole = " ".join("".join(parts).split())
    if whole:
        yield first, whole


def main_text(source: str) -> str:
    page = Page(source)
    dropped = [a or b for a, b in zip(page.banned, page.hinted, strict=True)]
    every = [(0, len(page.tags))]
    if next(blocks(page, every, dropped), None) is None:
        dropped = page.banned  # what marks leave without any text are no marks
    chars, linked, links = measured(page, dropped)
    # lists of links inside an article are menus too
    for node in range(1, len(page.tags)):
        if dropped[page.parents[node]] and not dropped[node]:
            dropped[node] = True
        elif not dropped[node] and page.tags[node] in ("ul", "ol", "dl", "table", "div", "section") \
                and links[node] >= 3 and linked[node] >= 0.8 * chars[node]:
            dropped[node] = True
    points = [0.0] * len(page.tags)
    for node, text in blocks(page, every, dropped):
        while page.tags[node] not in BLOCK and node:
            node = page.parents[node]
        if page.tags[node] not in ("h1", "h2", "h3", "h4", "h5", "h6"):
            holder = page.parents[node] if page.tags[node] in ("p", "li", "pre", "dd", "dt", "blockquote", "td") else node
            points[holder] += min(1, len(text) / 25) + text.count(",") + len(text) / 100
    for node in range(len(points) - 1, 0, -1):
        points[page.parents[node]] += points[node] / 2
    score = [p * (1 - b / max(a, 1)) for p, a, b in zip(points, chars, linked, strict=True)]
    best = max((k for k in range(len(score)) if score[k] > 0 and not dropped[k]),
               key=lambda k: score[k] + 25 * page.likely[k], default=None)
    if best is None:  # headings alone
        best = next((k for k, tag in enumerate(page.tags) if tag == "article" and not dropped[k]), 0)
    around = best
    while around and page.tags[around] != "article":
        around = page.parents[around]
    best = around or best  # an article counts as a whole
    keep = [(k, page.ends[k]) for k in siblings(page, best)
            if k == best or worth_keeping(page, k, best, score, chars, linked)]
    return "\n".join(text for _, text in blocks(page, keep, dropped))


def measured(page: Page, dropped: list[bool]) -> tuple[list[int], list[int], list[int]]:
    """Of each element: its characters, those in links, and its links."""
    n = len(page.tags)
    chars, linked, links = [0] * n, [0] * n, [0] * n
    for node, text in page.runs:
        if text and not dropped[node]:
            chars[node] += len(text.strip())
    for node in range(n - 1, 0, -1):
        if page.tags[node] == "a" and not dropped[node]:
            linked[node], links[node] = chars[node], 1
        up = page.parents[node]
        chars[up] += chars[node]
        linked[up] += linked[node]
        links[up] += links[node]
    return chars, linked, links


def siblings(page: Page, best: int) -> Iterator[int]:
    """The elements beside ``best`` and itself, in page order."""
    if not best:
        yield 0
        return
    up = page.parents[best]
    node = up + 1
    while node < page.ends[up]:
        yield node
        node = page.ends[node]


def worth_keeping(page: Page, node: int, best: int, score: list[float], chars: list[int], linked: list[int]) -> bool:
    tag, density = page.tags[node], linked[node] / max(chars[node], 1)
    if page.tags[best] in ("article", "main", "body"):  # complete, but for a second article
        return tag == page.tags[best] and score[node] >= 0.2 * score[best]
    if tag == "h1":
        return node < best and density < 0.5
    if tag == "p":
        return density < 0.25 and chars[node] > 0
    return score[node] >= max(2.0, 0.2 * score[best]) and density < 0.5


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", content("html").alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "html"):
            texts = pa.array([main_text(x) for x in b.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), texts], ["page_id", "url", "text"])

    return rows.mapInArrow(extract, schema).withColumn("n_chars", F.length("text").cast("long"))


def duckdb_sql() -> str:
    """The same for DuckDB where, as in the given pages, the article is one
    ``<article>`` of headings and paragraphs and the references are few."""
    return r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
        b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(body, '</?(p|h1)>', chr(10), 'g'),
                                                               '</?(b|br)>', ' ', 'g'), chr(10)) AS parts FROM a),
        c AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(
                  replace(x, '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM b),
        d AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM d"""
