"""Main text of web pages by line-block distribution.

The markup of a page is stripped to lines, one for each block element. A line weighs its
text; lines of page furniture (by element, role or name), and link lists outside an article,
weigh nothing. An element that holds the page's article, or nearly all its paragraph text, is
no furniture by its name; nor is one inside an article that reads as prose, if its name can
mean content as well, such as the discussion of a study. Weights are summed over sliding windows of three lines: text starts where the
sums rise from nothing (surge) and ends where they fall back to nothing (dive). Stretches
between a surge and its dive are kept if their highest window is not far below the page's
highest one. If the page marks an article, lines outside it weigh nothing and every stretch
inside counts.

Defined cases: null or empty html gives an empty text; pages without markup are one line;
unclosed elements end with the page, and unclosed furniture is taken for content; repeated
rows give repeated results. Text is never cut, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 3
#: A stretch counts if its highest window has this share of the page's highest one, or this many characters.
SHARE, ENOUGH = 0.2, 200

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|canvas|iframe|object|select|textarea|button|title|annotation|annotation-xml)\b.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>"
    r"|<[!?/][^>]*+>"
    r"|</?[a-z][^<>]*+>",
    re.IGNORECASE | re.DOTALL)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr "
                   "math mfrac mi mn mo mover mrow ms msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_FURNITURE_NAME = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menus?|sidebars?|side|aside|footer|foot|header|masthead|topbar|banners?|ads?|adverts?|"
    r"advertisements?|advertising|sponsor(?:ed)?|promos?|promotion|comments?|respond|discussion|disqus|repl(?:y|ies)|cookies?|"
    r"consent|gdpr|notices?|alerts?|newsletter|subscribe|subscription|signup|share|sharing|social|related|recommended|"
    r"breadcrumbs?|login|popup|modal|overlay|widgets?|pagination|pager|skip|toolbar|copyright)(?:$|[\s_-])", re.IGNORECASE)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.IGNORECASE)
#: Names that sections of articles have as well, and how many characters paragraphs of prose have on average.
_DOUBTFUL_NAME = re.compile(r"(?:^|[\s_-])(?:discussion|foot|related|share|side[_-]by[_-]side|social)(?:$|[\s_-])", re.IGNORECASE)
PROSE = 60
ARTICLE = frozenset(("article", "main"))


def _is_furniture(name: str, rest: str, inside: bool, wraps: bool = False, prose: bool = False) -> bool:
    """Whether an element holds page furniture; inside: within an article, whose own header is content;
    wraps: it holds what the page is about, whatever its class or id; prose: it reads as such, and its class or id may be doubtful."""
    if name in FURNITURE or name == "header" and not inside:
        return True
    if not rest or name in ("html", "body", "h1", "h2", "h3", "h4", "h5", "h6") or name in ARTICLE:
        return False
    for key, a, b, c in _NAMED.findall(rest):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and not wraps and _FURNITURE_NAME.search(value):
            if inside:
                value = _HEADER_NAME.sub(" ", value)
                value = _DOUBTFUL_NAME.sub(" ", value) if prose else value
            if _FURNITURE_NAME.search(value):
                return True
    return False


def _shapes(html: str, marks: list[tuple], closed_by: dict[int, int]) -> tuple[Callable[[int], bool], Callable[[int], bool]]:
    """Whether the element opened by a mark wraps the page's subject, and whether it reads as prose.

    It wraps the subject if it holds the page's first article or main, or, if there is none,
    nearly all of its paragraph text (of its text outside links if it has no paragraphs); long comments
    beside a short article hold most of it as well, but not so much. It reads as prose if most of its text
    is that of paragraphs, outside links, of `PROSE` characters on average."""
    paragraphs, unlinked, everything, opened = [0], [0], [0], [0]  # characters and paragraphs before each mark
    within = links = at = 0
    for start, end, kind, name, _ in marks:
        n = len("".join(html[at:start].split()))
        paragraphs.append(paragraphs[-1] + (0 if links else n * within))
        unlinked.append(unlinked[-1] + (0 if links else n))
        everything.append(everything[-1] + n)
        opened.append(opened[-1] + (name == "p" and kind == "+"))
        at = end
        if name == "a":
            links = max(0, links + (1 if kind == "+" else -1))
        elif name and name not in INLINE:
            within, links = int(name == "p" and kind == "+"), 0

    def held(said: list[int], i: int) -> int:
        return said[closed_by.get(i, len(marks) - 1) + 1] - said[i + 1]

    said = paragraphs if paragraphs[-1] else unlinked
    # Articles can also be comments or teasers: the one that counts is not named so, and has a share of the text.
    first = next((i for i, (_, _, kind, name, rest) in enumerate(marks) if kind == "+" and name in ARTICLE and (
        name == "main" or not _is_furniture("div", rest, True) and held(unlinked, i) >= max(1, SHARE * unlinked[-1]))), None)

    def wraps(i: int) -> bool:
        return held(said, i) > (1 - SHARE) * said[-1] if first is None else i < first < closed_by[i]

    def prose(i: int) -> bool:
        n = held(paragraphs, i)
        return n >= PROSE * max(1, held(opened, i)) and 2 * n > held(everything, i)

    return wraps, prose


def lines_of(html: str) -> tuple[list[str], list[int], list[bool]]:
    """The page's lines, the weight of each, and whether it lies in an article."""
    marks = []  # start, end, kind (+ open, - close, | line end, nothing), name, rest
    for m in _MARK.finditer(html):
        name = (m["name"] or "").lower()
        kind = "" if not name else "-" if m["close"] else "+"
        marks.append((m.start(), m.end(), kind, name, m["rest"] or ""))

    closed_by: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for i, (_, _, kind, name, _) in enumerate(marks):
        if kind == "+" and name not in VOID:
            open_at.setdefault(name, []).append(i)
        elif kind == "-" and open_at.get(name):
            closed_by[open_at[name].pop()] = i

    wraps, prose = _shapes(html, marks, closed_by)
    lines, weights, inside_article = [], [], []
    text, linked, total = [], 0, 0
    ends: list[int] = []  # marks that end the furniture we are in
    articles: list[int] = []
    links = at = 0

    def line_end() -> None:
        nonlocal text, linked, total
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                lines.append(joined)
                inside_article.append(bool(articles))
                weights.append(0 if ends else len(joined) if articles or 2 * linked <= total else 0)
        text, linked, total = [], 0, 0

    for i, (start, end, kind, name, rest) in enumerate(marks):
        if start > at:
            part = html[at:start]
            text.append(part)
            n = len(part.strip())
            total += n
            linked += n if links else 0
        at = end
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links + (1 if kind == "+" else -1))
            elif name == "br":
                text.append(" ")
            continue
        line_end()
        links = 0
        while ends and ends[-1] <= i:
            ends.pop()
        while articles and articles[-1] <= i:
            articles.pop()
        if kind == "+" and name not in VOID:
            if name in ARTICLE and not ends:
                articles.append(closed_by.get(i, len(marks)))
            elif i in closed_by and _is_furniture(name, rest, bool(articles), wraps(i), prose(i)):
                ends.append(closed_by[i] if not ends else min(ends[-1], closed_by[i]))
    if at < len(html):
        text.append(html[at:])
        total += len(html[at:].strip())
    line_end()
    return lines, weights, inside_article


def main_text(html: str) -> str:
    """The kept lines, joined by line feeds."""
    lines, weights, inside = lines_of(html)
    if not lines:
        return ""
    weight = np.array(weights, np.int64)
    marked = np.array(inside, bool)
    if (weight[marked] > 0).any():
        weight[~marked] = 0
    sums = np.convolve(np.pad(weight, (0, WINDOW - 1)), np.ones(WINDOW, np.int64), "valid")  # of each line and the next two
    steps = np.flatnonzero(np.diff(np.concatenate(([0], sums > 0, [0]))))
    surges, dives = steps[::2], steps[1::2]
    kept = np.zeros(len(lines), bool)
    least = min(ENOUGH, SHARE * sums.max(initial=0))
    for surge, dive in zip(surges, dives):
        if sums[surge:dive].max() >= least or marked[surge:dive][weight[surge:dive] > 0].any():
            kept[surge:dive] = weight[surge:dive] > 0
    return "\n".join(line for line, keep in zip(lines, kept) if keep)


def extract(html: Column) -> Column:
    """A column of main texts; null html counts as empty."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([main_text(x) for x in part], dtype=object)

    return run(F.coalesce(html, F.lit("")))
