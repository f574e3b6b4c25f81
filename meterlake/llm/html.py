"""Main text of web pages by line-block distribution.

Markup is stripped and each block of text becomes a line. A line's length counts only what is
article text: text of menus, headers, footers, sidebars, notices, adverts, forms and comments
counts nothing, nor does link text where a page does not say where its article is. The lengths
summed over a sliding window of lines form a curve; it surges where the article begins and
dives where it ends, and the counted lines between are kept, short ones too.
"""

from __future__ import annotations

import re
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
#: Without an article or main element: characters in a window at which the curve surges.
SURGE = 80

_RAW = r"script|style|noscript|template|textarea|title|iframe|svg|math|object|xmp"
#: Attributes: a "<" ends them unless it is quoted, so that broken tags cost no scan of the whole page.
_ATTRS = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b{_ATTRS}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRS}(?=>)|[^<>]*+)(?:>|(?=<)|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_LETTER = re.compile(r"\w")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a following element of the same name ends.
SELF_ENDING = frozenset("p li dt dd option tr td th".split())
BOILERPLATE = frozenset("nav footer aside form button select menu dialog figure-caption head input fieldset datalist".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
#: Words of a class or id that name what is not article text.
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
                         "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall sidebar nav navbar navigation "
                         "menu breadcrumb breadcrumbs footer masthead topbar toolbar comment comments commentlist disqus replies reply "
                         "respond share sharing social related recommended widget pagination pager skip login hidden".split())
#: Words of a class or id that say how an element is laid out, not what it holds. Inside an article a
#: name with any other word besides (related-work, notice-period, share price) drops nothing.
FRAME_WORDS = frozenset("area bar block body bottom box button center col column container content desktop first fixed grid group inline inner item items "
                        "js large last left link links list main mobile only outer panel right row section slot small sticky text title top unit "
                        "wide wrap wrapper".split())
ARTICLE = frozenset(("article", "main"))


class Line(NamedTuple):
    text: str
    linked: int      # characters inside links
    article: bool    # inside an article or main element
    boiler: bool
    free: bool       # has letters or digits outside links


def _is_boiler(name: str, attrs: str, in_article: bool) -> bool:
    if name in BOILERPLATE or name == "header" and not in_article:
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key == "role" and value.lower() in BOILER_ROLES:
            return True
        if key in ("class", "id"):
            words = set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
            if words & BOILER_WORDS and not (in_article and words - BOILER_WORDS - FRAME_WORDS):
                return True
    return False


def lines(html: str) -> list[Line]:
    """The page's blocks of text in page order, white space normalised, empty blocks left out."""
    out: list[Line] = []
    text: list[str] = []
    linked = 0
    free = in_link = False
    articles = 0
    skip, depth = "", 0  # the boilerplate element that is open, and how many of its name

    def flush():
        nonlocal linked, free
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                out.append(Line(block, min(linked, len(block)), articles > 0, bool(skip), free))
            text.clear()
        linked, free = 0, False

    def take(part: str):
        nonlocal linked, free
        if part:
            text.append(part)
            if in_link:
                linked += len(part)
            elif not free:
                free = _LETTER.search(unescape(part)) is not None

    at = 0
    for m in _TOKEN.finditer(html):
        take(html[at:m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            if m.group(1) and m.group(1).lower() != "title":
                text.append(" ")
            elif m.group(1):
                flush()
            continue
        closing, name = m.group(2) == "/", name.lower()
        if name == "a":
            in_link = not closing
            if skip != "a":
                if closing or not _is_boiler(name, m.group(4), articles > 0) or skip:
                    continue
        elif name in INLINE:
            if name in ("br", "img"):
                text.append(" ")
            if not (skip and skip == name) and (closing or skip or name in VOID or not _is_boiler(name, m.group(4), articles > 0)):
                continue
        flush()
        if skip:
            if name in ARTICLE and not closing and name != skip and skip in ("nav", "head", "header"):
                skip, depth = "", 0  # it was never closed
            elif name == skip:
                if closing:
                    depth -= 1
                elif name not in SELF_ENDING:
                    depth += 1
                else:
                    skip, depth = "", 0
                if not depth:
                    skip = ""
                if closing or skip:
                    continue
            else:
                continue
        if closing:
            if name in ARTICLE and articles:
                articles -= 1
            continue
        if name in VOID and name != "input":
            continue
        if name != "input" and _is_boiler(name, m.group(4), articles > 0):
            skip, depth = name, 1
        elif name in ARTICLE:
            articles += 1
    take(html[at:])
    flush()
    return out


def all_surges(weights: list[int], least: int, window: int = WINDOW) -> list[bool]:
    """Whether each line lies between a surge of the windowed sums and the dive after it, for every
    surge; the windows are those of ``between_surge_and_dive``, their sums running ones."""
    n = len(weights)
    kept, total, end = [False] * n, sum(weights[:window]), 0
    for i in range(n):
        if total >= least and total:
            end = max(end, min(n, i + window))
        kept[i] = i < end
        total += (weights[i + window] if i + window < n else 0) - weights[i]
    for order in (range(n), range(n - 1, -1, -1)):  # lines of no weight at the ends of a range are left out
        inside = False
        for i in order:
            inside = kept[i] = kept[i] and (inside or weights[i] > 0)
    return kept


def between_surge_and_dive(weights: list[int], least: int, window: int = WINDOW) -> tuple[int, int]:
    """Half-open range of lines from a surge of the windowed sums to the dive after it: the range
    with the largest sum of weights, (0, 0) if the curve never surges. A window at line i holds
    lines i .. i + window - 1; lines of no weight at the ends are left out."""
    n = len(weights)
    upto = [0, *accumulate(weights)]
    sums = [upto[min(n, i + window)] - upto[i] for i in range(n)]
    best, best_sum, i = (0, 0), 0, 0
    while i < n:
        if sums[i] < least:
            i += 1
            continue
        j = i
        while j < n and sums[j] >= least:
            j += 1
        lo, hi = i, min(n, j + window - 1)
        while lo < hi and not weights[lo]:
            lo += 1
        while hi > lo and not weights[hi - 1]:
            hi -= 1
        total = sum(weights[lo:hi])
        if total > best_sum:
            best, best_sum = (lo, hi), total
        i = j
    return best


def main_text(html: str | None) -> str:
    """The page's article: its blocks joined by an empty line; empty if there is none.

    Every range of lines between a surge of the windowed sums and the dive after it is kept; the curve
    surges at SURGE characters, or at half of its own peak where that is lower. Where the page marks its
    article (article or main element), what lies outside weighs nothing and a line inside weighs
    SURGE at least: a short one lifts the curve as well as a long one, so none is lost, and the curve
    dives where a window holds no marked line. Else link text weighs against a line, and lines that are links alone are left out.
    """
    if not html:
        return ""
    page = lines(html)
    marked = any(x.article and not x.boiler for x in page)
    if marked:
        counted = [x.article and not x.boiler for x in page]
        weights = [max(len(x.text), SURGE) if c else 0 for x, c in zip(page, counted)]
    else:
        counted = [x.free and not x.boiler for x in page]
        weights = [max(0, len(x.text) - 2 * x.linked) if not x.boiler else 0 for x in page]
    peak = max((sum(weights[i:i + WINDOW]) for i in range(len(page))), default=0)
    kept = all_surges(weights, max(1, min(SURGE, peak // 2)))
    return "\n\n".join(x.text for x, c, k in zip(page, counted, kept) if c and k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page, from its whole html.

    Null or empty html, and pages without article text, give an empty text and 0. Repeated
    pages give a row each; other columns are ignored. Nothing is shuffled.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                texts = [main_text(h) for h in batch.column(2)[lo:lo + 256].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:lo + 256], batch.column(1)[lo:lo + 256], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
