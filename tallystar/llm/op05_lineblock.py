"""Main-text extraction by line-block distribution.

Markup is stripped to one line per block element (scripts, styles, comments
and elements that are boilerplate by their tag or role, hidden ones and reader
comments are dropped on the way). The line-block distribution decides on every
page: a line weighs its characters outside links (nothing if most of it is
link text), the weights are summed in sliding windows of ``WINDOW`` lines; a
segment surges where a window holds at least ``SURGE`` characters and dives
where the windows fall below that. Markers are evidence with a large weight,
not a verdict: the lines of one outermost article or main element are one
segment, and its weight counts ``MARKED`` times. The heaviest segment and those
of at least 1/``SEGMENT`` of its weight are kept, so a text beside an article
that holds a title only wins over it, and a teaser article beside the main one
goes; a marked segment right before a kept one (a title) stays with it. Where
no kept segment is marked, all lines between the kept ones stay too, without
link lines and, at their edges, without short lines that are neither headings
(in front) nor sentences. Pages without any segment keep all lines.

Class and id words are weak evidence: a token counts if all its words are
boilerplate or layout words (``sidebar-left``, not ``has-sidebar`` or
``legal-analysis``), header words do not count inside an article, and the
element is dropped only if it wraps no main element and holds at most half of
the page's text (of the articles' text where there are any, unless no article
were left). Forms are judged the same way.

White space inside a block becomes one space, character references are
decoded, blocks are joined by a newline. Null and empty pages give an empty
text; unclosed and stray tags are tolerated; a page is handled whole, in time
linear in its length (from the ``BROKEN``-th tag with an unclosed quote on,
quotes no longer hide a ">"). An empty table gives no rows; extra columns pass
through (one of the result's name is replaced) and repeated rows stay.
"""

from __future__ import annotations

import html as html_lib
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.sources.testdata import read_table

WINDOW = 3          # lines summed per window
SURGE = 80          # characters in a window that start the text
EDGE = 24           # characters of a line that may begin or end a segment
SEGMENT = 5         # a kept segment holds 1/5 of the heaviest one
MARKED = 8          # weight of a character inside an article or main element
BROKEN = 16

# HTML element names and words of boilerplate attributes.
BLOCKS = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section
summary table tbody td tfoot th thead title tr ul""".split())
RAW = set("script style noscript template textarea iframe svg math object canvas audio video select button".split())
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
BOILERPLATE = set("head nav header footer aside menu dialog".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOTICES = re.compile(
    r"(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|"
    r"footer|header|masthead|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|sharing|social|"
    r"related|recommend\w*|comments?|commentlist|disqus|replies|pagination|pager|toolbar|widget|login|signup|"
    r"copyright|legal|disclaimer)", re.I)
TITLES = {"header", "masthead", "banner"}
COMMENTS = re.compile(r"comments?|commentlist|disqus|replies|respond", re.I)
READERS = {"user", "users", "reader", "readers", "thread", "threads", "visitor", "visitors", "guest", "tree", "form", "wp", "fb"}
NOT_THIS = {"has", "no", "with", "without", "open", "closed", "allow", "enable", "single"}
LAYOUT = set("""area bar block bottom box btn button buttons col column container content form global group icon icons
info inner item items left link links list main middle outer panel placeholder post posts primary right row secondary
section site slot text top unit wrap wrapper article articles mw wp td js""".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form"}
# A tag, a comment, a declaration; attribute values may hold '>'.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
OPEN_QUOTE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SENTENCE = re.compile(r"[.!?:;\u2026\u3002][\"')\]\u201d\u00bb]*$")
CLOSED_BY = {"a": {"a"}, "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


HARD, WEAK = 1, 2


def _notice(value: str, in_article: bool) -> bool:
    """A class or id with a token of boilerplate and layout words only."""
    for token in value.lower().split():
        words = [w for w in re.split(r"[_-]+", token) if w and not w.isdigit()]
        found = [w for w in words if NOTICES.fullmatch(w)]
        if found and all(w in LAYOUT or NOTICES.fullmatch(w) for w in words) and not (
                in_article and all(w in TITLES for w in found)):
            return True
    return False


def _comments(value: str) -> bool:
    """A class or id of a container of reader comments."""
    for token in value.lower().split():
        words = [w for w in re.split(r"[_-]+", token) if w and not w.isdigit()]
        if any(COMMENTS.fullmatch(w) for w in words) and not any(w in NOT_THIS for w in words) and all(
                COMMENTS.fullmatch(w) or w in LAYOUT or w in READERS for w in words):
            return True
    return False


def _unwanted(tag: str, attributes: str, in_article: bool) -> int:
    """HARD: dropped; WEAK: dropped unless it holds the text; 0: stays."""
    if tag in BOILERPLATE:
        return 0 if tag == "header" and in_article else HARD
    weak = tag == "form"
    for m in ATTRIBUTE.finditer(attributes or ""):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "role" and value.lower() in ROLES - {"form"} or name == "style" and HIDDEN.search(value):
            return HARD
        if name in ("class", "id") and tag not in ("body", "html", "article", "main") and _comments(value):
            return HARD
        if name == "role" and value.lower() == "form" or name in ("class", "id") and tag not in (
                "body", "html", "article", "main") and _notice(value, in_article):
            weak = True
    return WEAK if weak else 0


class _Line(NamedTuple):
    text: str
    inside: int         # number of the outermost article or main element around it, from 1; 0: none
    links: int          # characters of link text
    heading: bool


def _plain(parts) -> str:
    return " ".join(html_lib.unescape("".join(parts)).split())


def lines_of(page: str) -> list[_Line]:
    """Every block line that is not dropped."""
    out: list[tuple[list, int, bool]] = []              # parts, inside, heading
    held: list[tuple[str, bool, int]] = []              # of a line: text, link, innermost weak element or -1
    stack: list[tuple[str, bool, int, bool]] = []       # open elements: name, dropped, weak element around, link
    above: list[int] = []                               # of each weak element: the one around it
    wraps: list[set[str]] = []                          # ... and article or main if it holds one
    counts: dict[str, int] = {}                         # open elements by name
    endless: set[str] = set()                           # raw elements without an end tag from here on
    dropped = article = articles = link = heading = at = broken = 0

    def flush() -> None:
        nonlocal held
        if any(t and not t.isspace() for t, _, _ in held):
            out.append((held, articles if article else 0, heading > 0))
        held = []

    def hold(text: str) -> None:
        if not dropped:
            held.append((text, link > 0, stack[-1][2] if stack else -1))

    def pop() -> None:
        nonlocal dropped, article, link, heading
        name, bad, _, linked = stack.pop()
        counts[name] -= 1
        dropped -= bad
        link -= linked
        article -= name in ("article", "main")
        heading -= name in HEADINGS

    n = len(page)
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            hold(page[at:])
            break
        if mark > at:
            hold(page[at:mark])
        m = TAG.match(page, mark) if broken < BROKEN or page.startswith(("<!", "<?"), mark) else OPEN_QUOTE.match(page, mark)
        if m is None and broken < BROKEN:
            m = OPEN_QUOTE.match(page, mark)
            broken += m is not None
        if m is None:
            hold("<")
            at = mark + 1
            continue
        at = m.end()
        if m.re is TAG and m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            hold(" ")
            continue
        if tag in BLOCKS:
            flush()
        if m[1]:
            if counts.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = None if tag in endless else RAW_END[tag].search(page, at)
            if end is None:
                endless.add(tag)
            at = end.end() if end else (n if tag in ("script", "style") else at)
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            pop()
        if stack and stack[-1][0] == "head" and tag == "body":
            pop()
        kind, weak = _unwanted(tag, m[3], article > 0), stack[-1][2] if stack else -1
        if kind == WEAK:
            above.append(weak)
            wraps.append(set())
            weak = len(above) - 1
        if tag in ("article", "main") and not dropped and weak >= 0:
            wraps[weak].add(tag)
        linked = tag == "a" and re.search(r"\bhref\b", m[3], re.I) is not None
        dropped += kind == HARD
        articles += tag in ("article", "main") and not article
        article += tag in ("article", "main")
        link += linked
        heading += tag in HEADINGS
        counts[tag] = counts.get(tag, 0) + 1
        stack.append((tag, kind == HARD, weak, linked))
    flush()
    return _without_notices(out, above, wraps)


def _without_notices(found: list[tuple[list, int, bool]], above: list[int], wraps: list[set[str]]) -> list[_Line]:
    """The lines outside weak elements that hold neither a main element nor
    more than half of the text."""
    marked = any(inside for _, inside, _ in found)
    weight = [0] * len(above)
    total = 0
    for parts, inside, _ in found if above else ():
        if inside or not marked:
            for text, _, weak in parts:
                size = len(_plain([text]))
                total += size
                if weak >= 0:
                    weight[weak] += size
    for k in range(len(above) - 1, -1, -1):             # an inner element has a larger number
        if above[k] >= 0:
            weight[above[k]] += weight[k]
            wraps[above[k]] |= wraps[k]

    def left(keep) -> list[_Line]:
        gone: list[bool] = []
        for k, up in enumerate(above):
            gone.append(up >= 0 and gone[up] or not keep(k))
        out = []
        for parts, inside, heading in found:
            parts = [x for x in parts if x[2] < 0 or not gone[x[2]]]
            text = _plain(t for t, _, _ in parts)
            if text:
                out.append(_Line(text, inside, sum(len(_plain([t])) for t, linked, _ in parts if linked), heading))
        return out

    out = left(lambda k: "main" in wraps[k] or 2 * weight[k] > total)
    if marked and not any(x.inside for x in out):
        out = left(lambda k: wraps[k] or 2 * weight[k] > total)
    return out


def segments(sizes: np.ndarray, window: int, surge: int) -> list[tuple[int, int]]:
    """First and one past the last line of every stretch between a surge of the
    windowed length distribution and its dive."""
    n = len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    k = np.arange(n)
    up = np.flatnonzero(total[np.minimum(k + window, n)] - total[k] >= surge)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, up, 1)
    np.add.at(change, np.minimum(up + window, n), -1)
    inside = np.concatenate(([0], np.cumsum(change[:-1]) > 0, [0])).astype(np.int8)
    step = np.diff(inside)
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))


def _stretches(lines: list[_Line]):
    """(first, one past the last, element) of runs of lines of one article
    or main element, or of none (0)."""
    first = 0
    for k in range(1, len(lines) + 1):
        if k == len(lines) or lines[k].inside != lines[first].inside:
            yield first, k, lines[first].inside
            first = k


def _body(lines: list[_Line], sizes: np.ndarray, first: int, last: int) -> tuple[int, int] | None:
    """A segment without short lines at its edges that are neither headings in
    front nor sentences; None if nothing is left."""
    body = [k for k in range(first, last) if sizes[k] >= EDGE]
    if not body:
        return None
    low, high = body[0], body[-1]
    while low > first and sizes[low - 1] and (lines[low - 1].heading or SENTENCE.search(lines[low - 1].text)):
        low -= 1
    while high + 1 < last and sizes[high + 1] and SENTENCE.search(lines[high + 1].text):
        high += 1
    return low, high + 1


def text_lines(lines: list[_Line], window: int = WINDOW, surge: int = SURGE) -> list[int]:
    """Numbers of the lines that belong to the text."""
    sizes = np.array([len(x.text) - x.links if 2 * x.links <= len(x.text) else 0 for x in lines], np.int64)
    found: list[tuple[int, int, int, int]] = []                    # first, last, element, weight
    for first, last, element in _stretches(lines):
        if element:
            whole = sum(len(x.text) for x in lines[first:last])
            found.append((first, last, element, MARKED * whole))
            continue
        for a, b in segments(sizes[first:last], window, surge):
            body = _body(lines, sizes, first + a, first + b)
            if body:
                found.append((*body, 0, int(sizes[body[0]:body[1]].sum())))
    if not found:
        return list(range(len(lines)))
    heaviest = max(x[3] for x in found)
    kept = [k for k, x in enumerate(found) if SEGMENT * x[3] >= heaviest]
    if not any(found[k][2] for k in kept):
        low, high = found[kept[0]][0], found[kept[-1]][1]
        out = [k for k in range(low, high) if sizes[k] and not lines[k].inside]
    else:
        out = [k for j in kept for k in range(*found[j][:2]) if found[j][2] or sizes[k]]
    for j in kept:                              # a marked title right in front stays with its text
        if j and j - 1 not in kept and found[j - 1][2] and found[j - 1][1] == found[j][0] and not found[j][2]:
            out += range(*found[j - 1][:2])
    return sorted(set(out))


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of one page: what the line-block distribution finds."""
    lines = lines_of(page or "")
    return "\n".join(lines[k].text for k in text_lines(lines, window, surge))


def extract(pages: DataFrame, html: str = "html", column: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    return pages.withColumn(column, F.pandas_udf(
        lambda s: s.map(main_text), "string")(F.col(html)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
