"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element; what is never article text
(scripts, styles, forms, navigation, page headers and footers, sidebars, adverts,
notices, reader comments, by element, role, class or style) leaves empty lines in its place,
unless the lines before and after stand in the element's own container: it does not
split that one. A role, class or style only weighs: an element that holds the densest text by far is text,
whatever it is called (``Lines.spared``). Over the lines' text lengths, links counted apart, sums are taken in a
sliding window of WINDOW lines. A block starts where the window sum surges (becomes
positive) and ends where it dives back to zero; blocks that are mostly links are left
out, whatever their length beside others. This runs on every page. The edges of
``article`` and ``main`` part blocks, and text inside them weighs OUTSIDE times that
outside: blocks outside are left out only where none of them has a window of a like
weight, and blocks inside are kept, links or not, unless a window outside is denser.

End tags that HTML allows to leave out are implied: the body, or anything else that is
not allowed in it, ends the head; a block ends an open paragraph; list items, options,
terms, table rows and cells end their like. ``svg`` and ``math`` may be empty elements.

Character references are decoded once; white space inside a line becomes one space;
kept lines are joined by a line feed. Nulls, empty pages and pages without text give
an empty string. Nothing is capped; time and memory are linear in the page. Repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import html
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow

WINDOW = 3
#: A block is left out if links hold more than this share of its text.
MOST_LINKS = 0.6
#: How many times text outside article and main is outweighed by text inside.
OUTSIDE = 4

# Elements by what they do to lines.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
                   "tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg math".split())
DROPPED = frozenset("nav footer aside form button select option label input menu dialog head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist cookie "
                  "cookies consent disqus footer gdpr menu modal nav navbar navigation newsletter notice notices notification popup "
                  "promo promoted promotion related replies respond share sharing sidebar sponsor sponsored social subscribe "
                  "toolbar widget copyright masthead pager pagination".split())
#: Words that say so only together: the header of a site, unlike that of an article, is none of its text.
SITE, HEADER = frozenset("global site top".split()), "header"
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
CONTENT = frozenset(("article", "main"))
CONTAINERS = frozenset("article blockquote center details div fieldset figure main section td th".split())
FOREIGN, HEAD = frozenset(("svg", "math")), frozenset(("head",))
# End tags that may be left out: what a start tag ends, and the elements beyond which it does not reach.
HEAD_PARTS = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
CELLS = frozenset("table td th caption".split())
ITEM_SCOPE = CELLS | frozenset("article aside blockquote button center details dialog dir dl fieldset figure footer form header main menu nav ol section select ul".split())
PARAGRAPH = (frozenset(("p",)), CELLS | {"button"})
IMPLIED = ({"li": (frozenset(("li",)), ITEM_SCOPE), "option": (frozenset(("option",)), frozenset(("select", "optgroup"))),
            "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))), "tr": (frozenset(("tr", "td", "th", "caption")), frozenset(("table",)))}
           | {x: (frozenset(("dt", "dd")), ITEM_SCOPE) for x in ("dt", "dd")} | {x: (frozenset(("td", "th", "caption")), frozenset(("table",))) for x in ("td", "th")}
           | {x: (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(("table",))) for x in ("tbody", "thead", "tfoot")})
ENDS_PARAGRAPH = BLOCKS - frozenset("html head body title legend caption tbody td tfoot th thead tr".split())
#: Where the search for an end tag's element stops; for other names at a table's cells.
END_SCOPE = ({"p": PARAGRAPH[1], "li": ITEM_SCOPE - {"li"}, "dt": ITEM_SCOPE, "dd": ITEM_SCOPE, "table": frozenset()}
             | {x: frozenset(("table",)) for x in "tbody thead tfoot tr td th caption".split()})
#: Start tags that end an svg or math element which is never closed.
BREAKS_OUT = re.compile(r"<(?:article|aside|b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|footer|h[1-6]|head|header|hr|i|img|li|main|menu|nav|ol|p|"
                        r"pre|ruby|s|section|small|span|strong|sub|sup|table|tt|u|ul|var)(?=[\s/>])", re.I)
SPACE = re.compile(r"\s+")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")  # words of commentSection, too
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
FLAG = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)


def marked(attributes: str) -> bool:
    """Whether class, id or role says that the element is no article text."""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name in ("class", "id"):
            words = {w.lower() for w in WORD.findall(value)}
            if not MARKS.isdisjoint(words) or HEADER in words and not SITE.isdisjoint(words):
                return True
        if name == "role" and value.strip().lower() in ROLES or name == "style" and HIDDEN.search(value):
            return True
    return bool(FLAG.search(ATTRIBUTE.sub(lambda m: " hidden " if m.group(1).lower() == "hidden" else " ", attributes)))


class Lines:
    """A page's lines, in page order: text, characters inside links, whether inside article or main, the
    container they stand in, and the innermost marked element around them (0 is none). A line
    without text (None) is a gap, where an element was dropped, or (-1 characters) the start of a marked one."""

    def __init__(self) -> None:
        self.items: list[tuple[str | None, int, bool, int, int]] = []
        #: Per marked element: the marked element around it, its container, first and last line.
        self.outer, self.container, self.first, self.last = [0], [0], [0], [0]

    def spared(self) -> set[int]:
        """The marked elements that are text all the same: a name in a class says nothing against an
        element that holds the page. One is spared if its densest window outweighs OUTSIDE times all that is
        outside marked elements; then that of its lines is outside, and the marked elements in it are judged likewise."""
        n = len(self.outer)
        if n == 1:
            return set()
        size = np.fromiter((max(len(t) - x, 0) if t else 0 for t, x, *_ in self.items), np.int64, len(self.items))
        total = np.concatenate([[0], np.cumsum(size)])
        window = np.minimum(np.arange(len(size)) + WINDOW, len(size))
        levels = [total[window] - total[:-1]]  # maxima over runs of 1, 2, 4, ... windows
        while 2 ** len(levels) <= len(size):
            half = 2 ** (len(levels) - 1)
            levels.append(np.maximum(levels[-1][:-half], levels[-1][half:]))

        def densest(a: int, b: int) -> int:
            if b - a <= WINDOW:
                return int(total[b] - total[a])
            b -= WINDOW - 1
            k = (b - a).bit_length() - 1
            return int(max(levels[k][a], levels[k][b - 2 ** k]))

        own: list[list[int]] = [[] for _ in range(n)]  # lengths of the lines that no marked element inside holds
        content = [False] * n
        for (t, _, inside, _, mark), length in zip(self.items, size.tolist()):
            if t:
                own[mark].append(length)
                content[mark] = content[mark] or inside
        inner: list[list[int]] = [[] for _ in range(n)]
        for m in range(n - 1, 0, -1):
            inner[self.outer[m]].append(m)
            content[self.outer[m]] = content[self.outer[m]] or content[m]

        def direct(m: int) -> int:
            x = own[m]
            return max((sum(x[i:i + WINDOW]) for i in range(max(1, len(x) - WINDOW + 1))), default=0)

        def offer(marks: list[int]) -> None:
            for m in marks:
                heapq.heappush(heap, (not content[m], -int(total[self.last[m]] - total[self.first[m]]), m))

        free, spared, heap = direct(0), set(), []
        offer(inner[0])
        while heap:  # what holds an article first, then by its text
            m = heapq.heappop(heap)[2]
            if densest(self.first[m], self.last[m]) > OUTSIDE * free:
                spared.add(m)
                free = max(free, direct(m))
                offer(inner[m])
        return spared

    def kept(self) -> list[tuple[str, int, bool]]:
        """``(text, characters inside links, inside article or main)`` per line that no marked element drops,
        with WINDOW empty lines where what was dropped, or the edge of an article, parts blocks."""
        spared = self.spared()
        dropped = [0] * len(self.outer)  # the outermost element that drops it
        for m in range(1, len(self.outer)):
            dropped[m] = dropped[self.outer[m]] or (0 if m in spared else m)
        out: list[tuple[str, int, bool]] = []
        gap: set[int] = set()  # the containers of what was dropped since the last line
        before, was_inside = 0, False
        for text, linked, inside, container, mark in self.items:
            if dropped[mark]:
                gap.add(self.container[dropped[mark]])
            elif text is None:
                if linked == 0:
                    gap.add(container)
            else:
                if inside != was_inside or gap and (gap != {before} or before != container):
                    out.extend([("", 0, inside)] * WINDOW)
                gap.clear()
                before, was_inside = container, inside
                out.append((text, linked, inside))
        return out


def lines_of(page: str) -> Lines:
    """The page's lines; what elements drop by their name leaves a gap."""
    found = Lines()
    now: list[str] = []
    linked = 0
    links = inside = dropping = mark = 0
    open_: list[tuple[str, bool, int, int]] = []  # open elements that matter: name, drops its content, container, mark around it
    places: dict[str, list[int]] = defaultdict(list)  # where in them a name is
    n_containers = 0
    endless: set[str] = set()  # svg or math without any further end tag

    def end_line() -> None:
        nonlocal linked
        if now:
            text = SPACE.sub(" ", html.unescape("".join(now))).strip()
            if text:
                found.items.append((text, linked, inside > 0, open_[-1][2] if open_ else 0, mark))
            now.clear()
            linked = 0

    def close(ends: frozenset, scope: frozenset, outermost: bool = True) -> None:
        """Close the outermost (or innermost) open element named in ``ends``, and all in it."""
        nonlocal dropping, inside, mark
        here = [places[x] for x in ends if places[x]]
        if not here:
            return
        bar = max((places[x][-1] for x in scope if x not in ends and places[x]), default=-1)
        if outermost:
            above = [p[bisect.bisect_right(p, bar)] for p in here if p[-1] > bar]
            place = min(above, default=None)
        else:
            place = max(p[-1] for p in here)
            place = place if place > bar else None
        while place is not None and len(open_) > place:
            x, drops, _, around = open_.pop()
            places[x].pop()
            dropping -= drops
            if around != mark:
                end_line()
                found.last[mark] = len(found.items)
                mark = around
            if x in CONTENT and not drops and not dropping:
                inside = max(0, inside - 1)

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None or m.start() > at:
            text = page[at:m.start() if m else n]
            if open_ and open_[-1][0] == "head" and text.strip():
                close(HEAD, frozenset())
            if not dropping:
                now.append(text)
                linked += len(text.strip()) if links else 0
        if m is None:
            break
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if not m.group(1):
            if places["head"] and name not in HEAD_PARTS:
                close(HEAD, frozenset())
            if name in FOREIGN and m.group(3).endswith("/"):
                continue
            if name in RAW:  # its content is no markup; it ends at its end tag
                end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if not end:
                    endless.add(name)
                out_of = BREAKS_OUT.search(page, at) if not end and name in FOREIGN else None
                at = end.end() if end else out_of.start() if out_of else n
                continue
            if name in BLOCKS and not dropping:
                end_line()
            if name in IMPLIED:
                close(*IMPLIED[name])
            if name in ENDS_PARAGRAPH:
                close(*PARAGRAPH)
            elif name == "br" and not dropping:
                now.append(" ")
            if name in VOID or m.group(3).endswith("/"):
                continue
            drops = name in DROPPED or (name == "header" and not inside)
            marks = not drops and not dropping and name in _MARKABLE and bool(m.group(3)) and marked(m.group(3))
            container = open_[-1][2] if open_ else 0
            if (drops or marks) and not dropping:
                end_line()
            if drops:
                if not dropping:
                    found.items.append((None, 0, inside > 0, container, mark))
                dropping += 1
            if drops or name in TRACKED:
                n_containers += name in CONTAINERS
                places[name].append(len(open_))
                open_.append((name, drops, n_containers if name in CONTAINERS else container, mark))
            if marks:
                mark = len(found.outer)
                found.outer.append(open_[-1][3])
                found.container.append(container)
                found.first.append(len(found.items))
                found.last.append(len(found.items))
                found.items.append((None, -1, inside > 0, container, mark))  # a gap if it is dropped, however empty
            links += name == "a" and not dropping
            inside += name in CONTENT and not dropping
        else:
            if name in BLOCKS and not dropping:
                end_line()
            close(frozenset((name,)), END_SCOPE.get(name, CELLS), outermost=False)
            if name == "a" and not dropping:
                links = max(0, links - 1)
    end_line()
    for _, _, _, around in reversed(open_):  # what was never closed
        if around != mark:
            found.last[mark], mark = len(found.items), around
    return found


_MARKABLE = frozenset("div section ul ol aside article main header nav footer form table span p blockquote dl figure details "
                      "button select option label menu dialog head li".split())
TRACKED = _MARKABLE | CONTENT | CELLS | frozenset("caption center dd dir dt fieldset optgroup tbody tfoot thead tr".split())


def keep(lines: list[tuple[str, int, bool]]) -> np.ndarray:
    """Which lines lie between surge and dive of a kept block."""
    size = np.fromiter((len(t) for t, _, _ in lines), np.int64, len(lines))
    linked = np.fromiter((x for _, x, _ in lines), np.int64, len(lines))
    inside = np.fromiter((x for _, _, x in lines), bool, len(lines))
    if not size.any():
        return np.zeros(len(size), bool)

    def windows(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return total[np.minimum(np.arange(len(x)) + WINDOW, len(x))] - total[:-1]

    window, plain = windows(size), windows(np.maximum(size - linked, 0))
    surge = np.flatnonzero((window > 0) & np.concatenate([[True], window[:-1] == 0]))
    dive = np.flatnonzero((window > 0) & np.concatenate([window[1:] == 0, [True]])) + 1
    # a block's lines with text are all inside or all outside: the edges of article and main part blocks
    blocks = [(a, b, bool((inside[a:b] & (size[a:b] > 0)).any()), linked[a:b].sum() > MOST_LINKS * size[a:b].sum(), plain[a:b].max())
              for a, b in zip(surge, dive)]
    best_in = max((x for *_, within, _, x in blocks if within), default=0)
    best_out = max((x for *_, within, links, x in blocks if not within and not links), default=0)
    out = np.zeros(len(size), bool)
    for a, b, within, links, _ in blocks:
        if (within and best_in >= best_out) or (not links and (within or OUTSIDE * best_out >= best_in)):
            out[a:b] = True
    return out & (size > 0)


def main_text(page: str | None) -> str:
    lines = lines_of(page or "").kept()
    return "\n".join(t for (t, _, _), k in zip(lines, keep(lines).tolist()) if k)


def _extract(batches):
    for b in batches:
        text = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                                          pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    s = rows.schema
    return map_arrow(rows, _extract, f"page_id {s['page_id'].dataType.simpleString()}, url {s['url'].dataType.simpleString()}, text string, n_chars bigint")
