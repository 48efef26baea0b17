"""Main text of web pages: flat text blocks, described by their own and their neighbours' words and link density,
are kept or dropped by a decision tree that is trained on a small labelled table."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches

#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select title".split())
#: Elements that don't end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Zones by element: 1 the article, -1 what stands around it.
ZONE_OF = {"article": 1, "main": 1, "nav": -1, "footer": -1, "aside": -1, "form": -1, "menu": -1, "dialog": -1, "button": -1}
#: Words of class, id and role attributes that mark a zone.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert disclaimer menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar side widget footer header masthead comment comments reply replies disqus respond share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login popup modal overlay copyright legal pagination pager tags toolbar search".split()
)
INSIDE = frozenset("article content post entry story main maincontent articlebody body text".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?until)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WHITE = re.compile(r"\s+")

#: Features of a block, in the table's order.
FEATURES = ("zone", "words", "links", "words_before", "links_before", "words_after", "links_after", "heading")

#: The labelled table, made by hand: features as above (links: share of words inside links), and 1 for main text.
LABELLED = (
    # inside an article element, of any length, also among short neighbours
    (1, 1, 0.0, 40, 0.0, 60, 0.0, 0, 1), (1, 2, 0.0, 2, 0.0, 3, 0.0, 0, 1), (1, 3, 0.0, 0, 0.0, 90, 0.0, 1, 1), (1, 8, 0.0, 15, 1.0, 30, 0.0, 1, 1),
    (1, 12, 0.0, 90, 0.0, 80, 0.0, 0, 1), (1, 45, 0.0, 12, 0.0, 55, 0.1, 0, 1), (1, 150, 0.0, 60, 0.0, 10, 0.0, 0, 1), (1, 700, 0.0, 8, 0.0, 12, 0.0, 0, 1),
    (1, 60, 0.1, 30, 0.0, 30, 0.0, 0, 1), (1, 40, 0.3, 50, 0.0, 20, 0.2, 0, 1), (1, 20, 0.2, 3, 0.0, 4, 1.0, 0, 1), (1, 5, 0.2, 50, 0.0, 50, 0.0, 0, 1),
    (1, 1, 0.0, 0, 0.0, 0, 0.0, 0, 1), (1, 6, 0.0, 1, 0.0, 1, 0.0, 0, 1), (1, 25, 0.4, 60, 0.0, 60, 0.0, 0, 1), (1, 4, 0.0, 200, 0.0, 9, 0.3, 0, 1),
    # inside an article element, but a list of links
    (1, 3, 1.0, 40, 0.0, 4, 1.0, 0, 0), (1, 6, 1.0, 5, 1.0, 5, 1.0, 0, 0), (1, 2, 1.0, 3, 1.0, 0, 0.0, 0, 0), (1, 9, 0.9, 80, 0.0, 7, 1.0, 0, 0), (1, 12, 0.8, 2, 1.0, 3, 1.0, 0, 0),
    # inside a menu, footer, side column, advert, notice, form or among comments
    (-1, 1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (-1, 1, 1.0, 1, 1.0, 1, 1.0, 0, 0), (-1, 2, 1.0, 1, 1.0, 12, 0.0, 0, 0), (-1, 12, 0.0, 1, 1.0, 8, 0.0, 0, 0),
    (-1, 9, 0.0, 2, 1.0, 9, 0.0, 0, 0), (-1, 14, 0.0, 120, 0.0, 0, 0.0, 0, 0), (-1, 30, 0.0, 60, 0.0, 40, 0.0, 0, 0), (-1, 80, 0.0, 30, 0.0, 50, 0.0, 0, 0),
    (-1, 150, 0.0, 100, 0.0, 90, 0.0, 0, 0), (-1, 4, 0.0, 60, 0.0, 25, 0.0, 1, 0), (-1, 25, 0.1, 4, 0.0, 30, 0.0, 0, 0), (-1, 5, 0.4, 90, 0.0, 0, 0.0, 0, 0),
    (-1, 400, 0.0, 200, 0.0, 2, 0.0, 0, 0), (-1, 3, 0.0, 0, 0.0, 5, 1.0, 1, 0), (-1, 60, 0.2, 10, 0.5, 8, 0.5, 0, 0), (-1, 1, 0.0, 1, 0.0, 300, 0.0, 0, 0),
    # pages without marks: long blocks without links are text, and so are short ones between them
    (0, 60, 0.0, 8, 0.0, 55, 0.0, 0, 1), (0, 35, 0.05, 60, 0.0, 40, 0.0, 0, 1), (0, 120, 0.0, 2, 1.0, 90, 0.0, 0, 1), (0, 90, 0.1, 70, 0.0, 3, 1.0, 0, 1),
    (0, 20, 0.0, 50, 0.0, 60, 0.0, 0, 1), (0, 18, 0.1, 45, 0.1, 30, 0.0, 0, 1), (0, 300, 0.2, 5, 0.5, 6, 0.9, 0, 1), (0, 26, 0.0, 6, 0.0, 4, 0.0, 0, 1),
    (0, 7, 0.0, 60, 0.0, 80, 0.0, 0, 1), (0, 2, 0.0, 45, 0.0, 35, 0.0, 0, 1), (0, 12, 0.0, 30, 0.0, 24, 0.0, 0, 1), (0, 6, 0.0, 3, 1.0, 60, 0.0, 1, 1),
    (0, 9, 0.0, 70, 0.0, 45, 0.0, 1, 1), (0, 4, 0.0, 0, 0.0, 80, 0.0, 1, 1), (0, 40, 0.3, 60, 0.0, 60, 0.0, 0, 1), (0, 55, 0.0, 0, 0.0, 0, 0.0, 0, 1),
    # pages without marks: links, and short blocks among short ones, are not
    (0, 1, 1.0, 1, 1.0, 1, 1.0, 0, 0), (0, 3, 1.0, 2, 1.0, 2, 1.0, 0, 0), (0, 4, 1.0, 60, 0.0, 3, 1.0, 0, 0), (0, 8, 0.9, 6, 0.9, 7, 1.0, 0, 0),
    (0, 20, 0.8, 10, 0.9, 40, 0.0, 0, 0), (0, 30, 0.7, 12, 0.8, 12, 0.9, 0, 0), (0, 5, 0.0, 3, 1.0, 4, 1.0, 0, 0), (0, 9, 0.2, 5, 0.5, 0, 0.0, 0, 0),
    (0, 6, 0.0, 90, 0.0, 0, 0.0, 0, 0), (0, 10, 0.0, 4, 0.3, 6, 0.2, 0, 0), (0, 3, 0.0, 2, 0.0, 2, 0.0, 0, 0), (0, 2, 0.5, 70, 0.0, 4, 0.8, 0, 0),
    (0, 7, 0.0, 8, 0.0, 9, 0.0, 0, 0), (0, 3, 0.0, 60, 0.0, 2, 1.0, 1, 0), (0, 50, 0.6, 40, 0.7, 30, 0.8, 0, 0), (0, 12, 0.5, 80, 0.0, 60, 0.0, 0, 0),
)


def train_tree(table=LABELLED, depth: int = 7):
    """A binary tree by Gini impurity: nested (feature, threshold, if not above, if above), leaves are 0 or 1."""
    rows = np.array(table, float)
    x, y = rows[:, :-1], rows[:, -1]

    def gini(v: np.ndarray) -> float:
        return 2 * v.mean() * (1 - v.mean()) * len(v)

    def grow(at: np.ndarray, left: int):
        own = y[at]
        if left == 0 or own.min() == own.max():
            return int(own.mean() >= 0.5)
        best = (gini(own) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            values = np.unique(x[at, f])
            for edge in (values[1:] + values[:-1]) / 2:
                low = x[at, f] <= edge
                found = gini(own[low]) + gini(own[~low])
                if found < best[0]:
                    best = (found, f, float(edge))
        if best[1] < 0:
            return int(own.mean() >= 0.5)
        low = x[at, best[1]] <= best[2]
        return (best[1], best[2], grow(at[low], left - 1), grow(at[~low], left - 1))

    return grow(np.arange(len(rows)), depth)


def decide(tree, features: tuple) -> bool:
    while isinstance(tree, tuple):
        tree = tree[3] if features[tree[0]] > tree[1] else tree[2]
    return bool(tree)


def _zone(name: str, attributes: str) -> int:
    """What an element says about its content: 1 or -1, or 0 if it says nothing. Its name counts before its attributes."""
    marks = {w for m in _MARKS.finditer(attributes) for w in _WORD_PARTS.findall(_CAMEL.sub(" ", next(g for g in m.groups() if g is not None)).lower())} if attributes else set()
    if ZONE_OF.get(name) == -1 or marks & OUTSIDE and not (name in ("article", "main", "body", "html")):
        return -1
    return ZONE_OF.get(name) or (1 if marks & INSIDE and name in ("div", "section", "td") else 0)


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, words in links, zone, heading) of each flat block, in page order.

    A block ends where a block element starts or ends. Comments, scripts, styles and hidden elements have no text; a tag or
    comment that the end of the page cuts off has none either. The innermost element that marks a zone decides; a
    header says nothing inside an article.
    """
    out: list[tuple[str, int, int, int, int]] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, int, bool]] = []
    heading = link = 0
    at, end = 0, len(page)

    def flush() -> None:
        if parts:
            text = _WHITE.sub(" ", "".join(p for p, _ in parts)).strip()
            if text:
                linked = sum(len(p.split()) for p, inside in parts if inside)
                words = text.count(" ") + 1
                out.append((text, words, min(linked, words), stack[-1][1] if stack else 0, heading))
            parts.clear()

    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at and not (stack and stack[-1][2]):
            piece = page[at:start]
            parts.append((html.unescape(piece) if "&" in piece else piece, link > 0))
        if start == end:
            break
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = end if close < 0 else close + 3
            continue
        found = _TAG.match(page, start)
        if not found:
            following = page[start + 1 : start + 2]
            if following and (following.isalpha() and following.isascii() or following in "/!?"):
                close = page.find(">", start)
                at = end if close < 0 else close + 1
            else:
                parts.append(("<", link > 0))
                at = start + 1
            continue
        at, closing, name, attributes = found.end(), found[1], found[2].lower(), found[3]
        if name in RAW and not closing:
            if attributes.endswith("/") and name in ("svg", "math"):
                continue
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name == "a":
            link = 0 if closing else 1
        elif name == "br":
            parts.append((" ", False))
        if name in INLINE and name != "label":
            hides = False if closing or name in VOID else bool(attributes and _HIDDEN.search(attributes))
            if hides or closing and any(n == name for n, _, h in stack if h):
                _open_or_close(stack, name, closing, stack[-1][1] if stack else 0, True)
            continue
        flush()
        if name in HEADINGS:
            heading = 0 if closing else 1
        elif name != "header" or not closing:
            heading = 0
        if name in VOID:
            continue
        zone = stack[-1][1] if stack else 0
        hidden = stack[-1][2] if stack else False
        if not closing:
            own = _zone(name, attributes)
            if name == "header" and not own and zone != 1:
                own = -1
            zone, hidden = own or zone, hidden or bool(attributes and _HIDDEN.search(attributes))
            if name in ("html", "body"):
                zone, hidden = 0, False
        _open_or_close(stack, name, closing, zone, hidden)
        link = 0
    flush()
    return out


#: Elements of which a new one ends an open one beside it.
_ALONE = frozenset("p li dt dd tr td th option".split())


def _open_or_close(stack: list, name: str, closing: str, zone: int, hidden: bool) -> None:
    if not closing:
        if stack and stack[-1][0] == name and name in _ALONE:
            was = stack.pop()
            base = stack[-1] if stack else ("", 0, False)
            if zone == was[1] and hidden == was[2]:
                zone, hidden = base[1], base[2]
        stack.append((name, zone, hidden))
        return
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] == name:
            del stack[k:]
            return


def main_text(page: str | None, tree) -> str:
    """The kept blocks, joined by line feeds."""
    found = blocks(page or "")
    edge = ("", 0, 0, 0, 0)
    kept = []
    for i, (text, words, linked, zone, heading) in enumerate(found):
        before, after = found[i - 1] if i else edge, found[i + 1] if i + 1 < len(found) else edge
        share = lambda b: b[2] / b[1] if b[1] else 0.0
        if decide(tree, (zone, words, linked / words, before[1], share(before), after[1], share(after), heading)):
            kept.append(text)
    return "\n".join(kept)


def _extract(tree):
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p, tree) for p in batch.to_pylist()], pa.string())

    return extract


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars.

    A null or empty page, or one without main text, has the empty text. Rows are handled one by one, so repeated ones come back as often as given;
    an empty table gives an empty result. Columns that are not named are never read. No shuffle.
    """
    small_batches(pages.sparkSession)
    text = F.arrow_udf(_extract(train_tree()), "string")(F.col(html_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
