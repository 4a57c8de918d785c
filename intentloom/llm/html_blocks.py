"""Main text of web pages from flat text blocks and a learned decision tree.

A page is cut into blocks at block-level tags. A block's features are its words and link density,
those of its neighbours, and what surrounds it: an article, or a menu, form, notice or the like by
tag, role or class. A decision tree, grown on a small labelled table of blocks, says which blocks
are main text. Blocks are kept or dropped whole.

Null and empty html give an empty text. Repeated rows get equal answers. Markup that is never closed ends with
the page. Scripts, styles, hidden templates and form fields have no text. Other columns are unused.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# HTML elements by their kind.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style noscript template iframe object svg math head title textarea select option button canvas audio video".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
_ASIDE = frozenset("nav header footer aside form menu dialog".split())
_MAIN = frozenset(("article", "main"))
# Words in class, id and role that mark what is not main text.
_MARKS = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "comment comments disqus reply replies respond widget toolbar pagination pager search complementary contentinfo".split()
)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

# The labelled table outside articles and marks. words, link density, then those of the block
# before and the block after, articles around, marks around, and whether the block is main text.
OPEN = (
    (4, 0.9, 2, 1.0, 3, 1.0, 0, 0, 0), (6, 0.8, 5, 0.9, 2, 1.0, 0, 0, 0), (3, 1.0, 4, 1.0, 2, 1.0, 0, 0, 0), (15, 0.6, 3, 1.0, 4, 1.0, 0, 0, 0),
    (2, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0), (4, 0.0, 2, 1.0, 5, 1.0, 0, 0, 0), (3, 0.0, 0, 0.0, 4, 1.0, 0, 0, 0), (5, 0.0, 6, 0.0, 0, 0.0, 0, 0, 0),
    (4, 0.0, 5, 1.0, 0, 0.0, 0, 0, 0), (40, 0.7, 20, 0.6, 30, 0.8, 0, 0, 0), (90, 0.8, 60, 0.0, 30, 0.8, 0, 0, 0), (3, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0),
    (40, 0.0, 50, 0.05, 60, 0.0, 0, 0, 1), (90, 0.05, 3, 1.0, 70, 0.0, 0, 0, 1), (60, 0.0, 80, 0.0, 3, 1.0, 0, 0, 1), (25, 0.1, 40, 0.0, 50, 0.0, 0, 0, 1),
    (8, 0.0, 60, 0.0, 45, 0.0, 0, 0, 1), (2, 0.0, 60, 0.0, 50, 0.0, 0, 0, 1), (4, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1), (12, 0.0, 2, 1.0, 90, 0.0, 0, 0, 1),
    (200, 0.1, 4, 1.0, 2, 1.0, 0, 0, 1), (35, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (10, 0.0, 50, 0.0, 100, 0.0, 0, 0, 1), (18, 0.2, 70, 0.0, 30, 0.0, 0, 0, 1),
)
#: Inside an article every length and neighbourhood is main text, inside marks none is.
_SIZES = ((1, 0.0), (1, 1.0), (7, 0.0), (9, 1.0), (30, 0.0), (160, 0.0))
LABELLED = OPEN + tuple(
    (*own, *before, *after, article, mark, int(not mark))
    for own, before, after in product(_SIZES, ((0, 0.0), (2, 1.0), (8, 0.0), (90, 0.0)), ((0, 0.0), (3, 1.0), (12, 0.0), (200, 0.0)))
    for article, mark in ((1, 0), (0, 1), (1, 1))
)


def grow(rows: np.ndarray, least: int = 1, depth: int = 8):
    """A decision tree by Gini gain: (feature, threshold, below, above), or a boolean leaf."""
    x, y = rows[:, :-1], rows[:, -1].astype(bool)
    if y.all() or not y.any() or depth == 0:
        return bool(y.mean() >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= t
            if least <= low.sum() <= len(y) - least:
                impure = sum(m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (low, ~low))
                if best is None or impure < best[0] - 1e-12:
                    best = (impure, f, t, low)
    if best is None:
        return bool(y.mean() >= 0.5)
    _, f, t, low = best
    return f, float(t), grow(rows[low], least, depth - 1), grow(rows[~low], least, depth - 1)


@cache
def tree():
    return grow(np.array(LABELLED, float))


def judge(node, features: tuple) -> bool:
    while not isinstance(node, bool):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return node


def _marked(attributes: str) -> bool:
    return bool(attributes) and any(
        part.lower() in _MARKS for m in _NAMED.finditer(attributes) for part in _SPLIT.split(m[1] or m[2] or m[3] or "")
    )


def blocks(page: str) -> list[tuple[str, int, float, int, int]]:
    """(text, words, link density, articles around, marks around) of every block with text."""
    out: list[tuple[str, int, float, int, int]] = []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, article, mark, silent
    main = marks = silent = links = 0

    def close():
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                words = text.count(" ") + 1
                tied = len(html.unescape(" ".join(linked)).split())
                out.append((text, words, min(1.0, tied / words), main, marks))
        pieces.clear()
        linked.clear()

    def said(text: str):
        if text and not silent:
            pieces.append(text)
            if links:
                linked.append(text)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            said(page[at:])
            break
        said(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                said(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        if name == "br":
            said(" ")
        if name not in _INLINE:
            close()
        if m[1]:
            if name == "a":
                links = 0
            if any(s[0] == name for s in stack):
                while True:
                    top, article, mark, mute = stack.pop()
                    main, marks, silent = main - article, marks - mark, silent - mute
                    if top == name:
                        break
            continue
        if name == "a":
            links = 1
        if name in _VOID or name in _INLINE or m[3].rstrip().endswith("/") and name in ("svg", "path"):
            continue
        if name in _RAW:
            end = re.compile(f"</{name}\\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "p" and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            stack.pop()  # neither nests
        inside = main > 0
        aside = name in _ASIDE and not (name == "header" and inside) or "hidden" in m[3].lower().split() or _marked(m[3]) and name not in ("body", "html", *_MAIN)
        entry = (name, name in _MAIN and not marks, aside, name in _SILENT)
        stack.append(entry)
        main, marks, silent = main + entry[1], marks + entry[2], silent + entry[3]
    close()
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    none = ("", 0, 0.0, 0, 0)
    kept = []
    for i, (text, words, density, main, marks) in enumerate(found):
        before, after = found[i - 1] if i else none, found[i + 1] if i + 1 < len(found) else none
        if judge(tree(), (words, density, before[1], before[2], after[1], after[2], min(main, 1), min(marks, 1))):
            kept.append(text)
    return "\n".join(kept)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_rows, "page_id long, url string, text string, n_chars long")
