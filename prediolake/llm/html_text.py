"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import through_arrow

#: Elements whose content isn't text of the page: it ends at their own end tag, whatever stands in between.
_RAW = frozenset("script style noscript template iframe textarea title".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in _RAW}
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
#: Blocks that part a page into regions; the others (paragraphs, items, cells, headings, quotes) are lines of their region.
_REGIONS = frozenset("html body div section article main aside nav header footer form center dialog fieldset menu details".split())
#: Elements that are never the article: menus, footers, sidebars, controls.
_ASIDE = frozenset("nav footer aside menu dialog fieldset select button".split())
_MAIN = frozenset(("article", "main"))
#: Fixed lists of whole class names and ids. Outside main elements the first go; inside, only adverts and lists of comments, and only where a region or list bears them.
_NOT_MAIN = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising advertorial banner sponsor sponsored sponsors promo promos promotion promotions sidebar side-bar widget widgets comment comments commentlist "
    "comment-list replies reply respond disqus disqus_thread cookie cookies cookie-notice cookie-banner consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription menu navbar nav "
    "navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar share sharing social related recommended login signup search skip skip-link paywall hidden".split()
)
_NOT_ARTICLE = frozenset("ad ads adv advert adverts advertisement advertisements advertising sponsored comments commentlist comment-list disqus_thread respond".split())
_MAIN_NAMES = frozenset("article article-body article-content articlebody content entry entry-content main main-content maincontent post post-body post-content story story-body".split())
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())

#: Lines in a window, and the weight of a window at which it surges.
WINDOW, SURGE = 3, 80
#: Main elements are believed unless a region outside them holds so many times their text.
OUTSIDE = 4
#: So many lines of links alone, one after another, are a menu wherever they stand at an edge.
MENU = 3


def _tag_end(html: str, at: int) -> int:
    """Where the > of the tag stands whose name ends at ``at``; -1 if nowhere. Quotes count after = alone, as in a browser."""
    while m := _STOP.search(html, at):
        at = m.start()
        if html[at] == ">":
            return at
        before = at - 1
        while before > 0 and html[before].isspace():
            before -= 1
        close = html.find(html[at], at + 1) if html[before] == "=" else at
        if close < 0:  # never closed: there is no such quote any more, so this is asked once
            close = at
        at = close + 1
    return -1


def _tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of each tag, in page order; comments and the like have no name, and an element of _RAW is one with all that it holds.

    One pass: each search starts where the last one ended, and what isn't ended goes to the end of the page. A < that
    begins no tag is text.
    """
    at, n = 0, len(html)
    while (at := html.find("<", at)) >= 0:
        start = at
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = n if end < 0 else end + 3
            yield start, at, "", False, ""
        elif html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            at = n if end < 0 else end + 1
            yield start, at, "", False, ""
        elif m := _NAME.match(html, at + 1 + html.startswith("</", at)):
            tag, closes = m[0].lower(), html[at + 1] == "/"
            end = _tag_end(html, m.end())
            at = n if end < 0 else end + 1
            given = html[m.end() : end] if end >= 0 else ""
            if tag in _RAW and not closes:
                if last := _END[tag].search(html, at):
                    end = html.find(">", last.end())
                    at = n if end < 0 else end + 1
                else:
                    at = n
                tag = ""
            yield start, at, tag if at < n or end >= 0 else "", closes, given
        else:
            at += 1


def _side(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether the element is left out, and whether it is a main one. inside: it stands in a main element already."""
    if tag in _ASIDE or (tag == "header" and not inside):
        return True, False
    if not attributes:
        return False, tag in _MAIN
    if _HIDDEN.search(attributes):
        return True, False
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(attributes)}
    role = given.get("role", "").strip().lower()
    names = {x.lower() for x in (*given.get("class", "").split(), given.get("id", "").strip())}
    region = tag in _REGIONS or tag in ("ul", "ol", "td")
    if tag in ("html", "body"):
        return False, False
    if role in _ROLES or names & (_NOT_ARTICLE if inside or tag in _MAIN else _NOT_MAIN) and (region or not inside):
        return True, False
    return False, tag in _MAIN or role in ("main", "article") or given.get("itemprop", "").lower() == "articlebody" or (region and bool(names & _MAIN_NAMES))


@dataclass(frozen=True)
class Line:
    """The text of a block, and where it stands.

    free: its characters outside links; main: the number of the outermost main element around it, 0 for none; region,
    depth: its region's number and depth; gap: how many regions end or begin between the line before and this one;
    meet: the depth of the region that holds both.
    """

    text: str
    free: int
    main: int
    region: int
    depth: int
    gap: int
    meet: int


def lines_of(html: str) -> list[Line]:
    """The page without markup, in page order.

    Elements that are left out leave nothing, not even a gap. A form is one of them, unless it holds half of the
    page's text and more (pages that are one form): then it is a region like others.
    """
    parents, depths, forms = [0], [0], [0]
    stack: list[tuple[str, bool, bool, bool]] = []
    opened: Counter = Counter()
    found: list[tuple[str, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    dropped = main = links = here = mains = 0

    def close() -> None:
        nonlocal links
        links = 0
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                found.append((text, max(0, len(text) - len(" ".join(unescape("".join(linked)).split()))), mains if main else 0, here))
            parts.clear()
            linked.clear()

    def pop() -> None:
        nonlocal dropped, main, here
        tag, gone, chief, region = stack.pop()
        opened[tag] -= 1
        dropped -= gone
        main -= chief
        if region:
            here = parents[here]

    at = 0
    for start, end, tag, closes, given in _tags(html):
        if start > at and not dropped:
            parts.append(html[at:start])
            if links:
                linked.append(html[at:start])
        at = end
        if not tag:
            continue
        if tag == "a":
            links = 0 if closes else int(bool(_HREF.search(given)))
        if tag == "br":
            if not dropped:
                parts.append(" ")
        elif closes:
            if tag in _BLOCKS and not dropped:
                close()
            if opened[tag]:
                while True:
                    last = stack[-1][0]
                    pop()
                    if last == tag:
                        break
        else:
            block = tag in _BLOCKS
            if block:
                if not dropped:
                    close()
                if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dd", "dt", "td", "th", "tr")):
                    pop()
            if tag in _VOID or given.endswith("/"):
                continue
            gone, chief = _side(tag, given, main > 0)
            if block or gone:
                region = tag in _REGIONS or chief
                if region:
                    parents.append(here)
                    depths.append(depths[here] + 1)
                    forms.append(forms[here] or (len(forms) if tag == "form" else 0))
                    here = len(parents) - 1
                mains += chief and not main
                stack.append((tag, gone, chief, region))
                opened[tag] += 1
                dropped += gone
                main += chief
    if not dropped:
        parts.append(html[at:])
    close()

    held: Counter = Counter()
    for _, free, _, region in found:
        held[forms[region]] += free
    whole = sum(held.values())
    out: list[Line] = []
    before = 0
    for text, free, number, region in found:
        if forms[region] and 2 * held[forms[region]] < whole:
            continue
        gap, x, y = 0, before, region
        while x != y:
            gap += 1
            if depths[x] >= depths[y]:
                x = parents[x]
            else:
                y = parents[y]
        out.append(Line(text, free, number, region, depths[region], gap if out else 0, depths[x] if out else depths[region]))
        before = region
    return out


def believed(lines: list[Line], parts: list[int]) -> bool:
    """Whether the page's main elements are its article: they hold text, and no part outside them has OUTSIDE times as much."""
    own = sum(x.free for x in lines if x.main)
    others: Counter = Counter()
    for x, part in zip(lines, parts, strict=True):
        if not x.main:
            others[part] += x.free
    return own > 0 and OUTSIDE * own >= max(others.values(), default=0)


def parts_of(lines: list[Line]) -> list[int]:
    """By line, a number of the part of the page that it is in: a region right below the one that holds all lines, or that region's own lines (-1)."""
    top = min((x.meet for x in lines), default=0)
    out: list[int] = []
    for k, x in enumerate(lines):
        out.append(-1 if x.depth == top else k if not k or x.meet == top else out[-1])
    return out


def chosen_lines(lines: list[Line]) -> list[int]:
    """The lines between surges and dives of the weight in sliding windows of WINDOW lines.

    A line weighs its characters outside links. Lines with ``gap`` regions between them lie 2 * gap - 1 empty lines
    apart, so two neighbouring regions part any window. A stretch begins where a window first holds weight and ends
    where a window is empty; stretches of one part of the page are judged as one, by their fullest window: it has to
    surge to SURGE, or to a quarter of the page's fullest window where that is less. A stretch that doesn't, between
    two that do, stays too.

    Where main elements are believed, only their lines weigh, each element is a part, and nothing within one dives:
    the windows choose among the elements. Elsewhere they weigh like any other lines.

    Lines of links alone weigh nothing. They stay within a chosen part, and at its edges where they are in its regions,
    unless MENU of them follow one another there.
    """
    parts = parts_of(lines)
    if believed(lines, parts):
        parts = [x.main if x.main else None for x in lines]
    weights = [0 if part is None else x.free for x, part in zip(lines, parts, strict=True)]
    places, place = [], 0
    for k, x in enumerate(lines):
        same = k > 0 and x.main and parts[k] == parts[k - 1] == x.main
        place += 1 + (min(2 * x.gap - 1, WINDOW - 1) if same else 2 * x.gap - 1 if x.gap else 0) if k else 0
        places.append(place)
    held = [k for k, w in enumerate(weights) if w]
    fullest: list[int] = []  # of the window that begins at each held line, the lines of its part
    stop = total = 0
    for at, k in enumerate(held):
        if stop <= at:
            stop, total = at, 0
        while stop < len(held) and places[held[stop]] < places[k] + WINDOW and parts[held[stop]] == parts[k]:
            total += weights[held[stop]]
            stop += 1
        fullest.append(total)
        total -= weights[k]
    surge = max(1e-9, min(SURGE, max(fullest, default=0) / 4))
    stretches: list[list[int]] = []  # first and last held line, by their places in held
    for at, k in enumerate(held):
        if stretches and places[k] - places[held[at - 1]] <= WINDOW and parts[k] == parts[held[at - 1]]:
            stretches[-1][1] = at
        else:
            stretches.append([at, at])
    peaks: Counter = Counter()
    for a, b in stretches:
        peaks[parts[held[a]]] = max(peaks[parts[held[a]]], *fullest[a : b + 1])
    good = [peaks[parts[held[a]]] >= surge for a, _ in stretches]
    good = [on or 0 < k < len(good) - 1 and good[k - 1] and good[k + 1] for k, on in enumerate(good)]
    chosen: set[int] = set()
    ends: dict[int | None, list[int]] = {}
    for (a, b), on in zip(stretches, good, strict=True):
        if on:
            first, last = held[a], held[b]
            ends.setdefault(parts[first], [first, first])[1] = last
            chosen.update(range(first, last + 1))
    for part, (first, last) in ends.items():
        chosen.update(k for k in range(first, last + 1) if parts[k] == part and not weights[k])
        regions = {lines[k].region for k in (first, last)}
        for step, edge in ((-1, first), (1, last)):
            k = edge + step
            while 0 <= k < len(lines) and parts[k] == part and not weights[k] and (lines[k].region in regions or lines[k].main == part):
                k += step
            if abs(k - edge) - 1 < MENU:
                chosen.update(range(min(edge, k + 1), max(edge + 1, k)))
    return sorted(k for k in chosen if parts[k] is not None)


def main_text(html: str | None) -> str:
    """The main text: the blocks that line-block distribution chooses, joined by line ends.

    Null and empty pages, and pages of links alone: an empty text. What isn't closed (a tag, a comment, a script) goes
    to the end of the page; a link ends with its block.
    """
    lines = lines_of(html or "")
    return "\n".join(lines[k].text for k in chosen_lines(lines))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        last = b.num_columns - 1
        texts = [main_text(x) for x in b.column(last).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(last)), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*b.schema.names[:last], "text", "n_chars"])


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns in ``keep``, text and n_chars (code points) for each row of pages.

    Null and empty html: an empty text. Repeated rows give repeated rows; columns not named are left aside, whatever
    their names. An empty table gives no rows. Each row by itself: no shuffle.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    return through_arrow(pages.select(*keep, F.col(html_col).cast("string").alias("_html")), _extracted, f"{fields}, text string, n_chars long")
