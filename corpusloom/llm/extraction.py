"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block that carries text. Lines of menus, adverts, forms and the like, and text of
links, count as empty; markup without text makes no line. The lengths summed over a sliding window of lines surge where the main text begins and dive to nothing where
it ends; the text between is kept, on pages with and without article marks alike. Short blocks beside it in the same element
belong to it.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import narrow

#: Lines summed at each position, and the sum from which a rise counts as a surge.
WINDOW, SURGE = 3, 80

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)/?>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_RAW = frozenset(("script", "style", "noscript", "template", "svg", "math", "textarea", "title", "iframe", "object"))
_BLOCKS = frozenset(
    (
        "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
        "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
        "select summary table tbody td tfoot th thead tr ul"
    ).split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ASIDE = frozenset("nav footer aside form header menu button select dialog head label fieldset".split())
#: Open elements that end where one of these opens, unless the second kind lies between.
_ENDED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS, _TABLES, _CELLS = ("ul", "ol", "menu", "dir", "dl"), ("table",), ("table", "td", "th", "caption")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_WHOLE = frozenset(("", "html", "body"))
_ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert)\b", re.I)
_NAMED = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|masthead|site-?header|page-?header|"
    r"top-?bar|foot(?:er)?\w*|side-?bar\w*|aside|related|recommend\w*|comment\w*|disqus\w*|repl(?:y|ies)|cookie\w*|consent|"
    r"gdpr|notices?|newsletter|subscri\w*|shar(?:e|ing)|social|breadcrumbs?|pop-?up|modal|overlay|login|signup|search|"
    r"pagination|pager|widget\w*|copyright|legal|skip)(?:$|[\s_-])",
    re.I,
)


def _set_aside(name: str, attributes: str, in_article: bool) -> bool:
    if name in _ASIDE:
        return not (name == "header" and in_article)
    if not attributes or name in ("body", "html", "article", "main") and "comment" not in attributes.lower():
        return False
    if _ROLES.search(attributes) or re.search(r"\b(?:hidden|aria-hidden\s*=\s*[\"']?true)\b(?!-)", attributes, re.I):
        return True
    return any(_BOILERPLATE.search(a or b or c or "") for a, b, c in _NAMED.findall(attributes))


class Line(NamedTuple):
    """Text of a block ("" if it is set aside), characters not in links, whether in an article, the element it is in."""

    text: str
    size: int
    in_article: bool
    element: Element


class Element:
    """An element that is or was open: its parent, and the numbers of its lines from ``first`` to below ``end``."""

    __slots__ = ("name", "parent", "first", "end")

    def __init__(self, name: str, parent: Element | None, first: int):
        self.name, self.parent, self.first, self.end = name, parent, first, -1


class _Open:
    """The open elements of a page, outermost first, and where each name occurs among them."""

    def __init__(self):
        self.elements = [Element("", None, 0)]
        self.places: dict[str, list[int]] = {}
        self.skipped = -1  # place of the element that is set aside
        self.linked = 0  # how many elements were open where the open link began

    def last(self, names: tuple[str, ...]) -> int:
        return max((places[-1] for n in names if (places := self.places.get(n))), default=-1)

    def push(self, name: str, first: int) -> None:
        self.places.setdefault(name, []).append(len(self.elements))
        self.elements.append(Element(name, self.elements[-1], first))

    def cut(self, place: int, end: int) -> None:
        """Ends the element at this place and all in it."""
        while len(self.elements) > place:
            gone = self.elements.pop()
            gone.end = end
            self.places.get(gone.name, [0]).pop()
        if self.skipped >= place:
            self.skipped = -1
        if self.linked > place:
            self.linked = 0  # what was around an unclosed link has ended

    def before(self, name: str, end: int) -> None:
        """Ends what the start tag of a block ends: paragraphs, and items and cells of its own kind."""
        if name in _ENDED:
            own = self.last(_ENDED[name])
            if own > self.last(_CELLS if name in ("li", "dt", "dd") else _TABLES) and (name[0] == "t" or own > self.last(_LISTS)):
                self.cut(own, end)
        own = self.last(("p",))
        if own > self.last(_CELLS):
            self.cut(own, end)

    def after(self, name: str, end: int) -> None:
        """Ends the innermost element of this name, and all in it, if it may end here."""
        own = self.last((name,))
        if own < 0 or name in ("html", "body"):
            return
        inner = () if name in ("article", "main", "table") else _TABLES if name in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption") else _CELLS
        if own > self.last(inner) and not (name == "li" and own < self.last(_LISTS)):
            self.cut(own, end)


def lines_of(page: str) -> list[Line]:
    """Lines in page order, one per block that carried text and one per block of text that was set aside."""
    out: list[Line] = []
    text: list[str] = []
    linked, hidden, opened = 0, False, _Open()

    def close() -> None:
        nonlocal linked, hidden
        line = " ".join("".join(text).split())
        text.clear()
        if line or hidden:
            inside = opened.last(("article", "main")) >= 0
            out.append(Line(line, max(0, len(line) - linked), inside, opened.elements[-1]))
        linked, hidden = 0, False

    def add(piece: str) -> None:
        nonlocal linked, hidden
        if opened.skipped >= 0:
            hidden = hidden or not piece.isspace()
            return
        piece = entities.unescape(piece)
        text.append(piece)
        if opened.linked:
            linked += len(" ".join(piece.split()))

    at, size = 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        start = found.start() if found else size
        if start > at:
            add(page[at:start])
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if name in _RAW and not closing:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if end or name in ("script", "style", "textarea", "title"):
                at = end.end() if end else size
            continue
        block = name in _BLOCKS
        if block:
            close()
            if closing:
                opened.after(name, len(out))
            elif name != "br":
                opened.before(name, len(out))
        skipped = opened.elements[opened.skipped].name if opened.skipped >= 0 else ""
        if closing:
            if skipped == name and not block:
                close()
                opened.cut(opened.last((name,)), len(out))
        elif name not in _VOID:
            if skipped and name in ("article", "main") and skipped not in ("article", "main") and "comment" not in attributes.lower():
                opened.skipped = -1  # an element that was never closed does not swallow the text
                opened.push(name, len(out))
            elif not skipped and _set_aside(name, attributes, opened.last(("article", "main")) >= 0):
                close()
                opened.push(name, len(out))
                opened.skipped = len(opened.elements) - 1
            elif (block and not (name in ("html", "body") and name in opened.places)) or name == skipped:
                opened.push(name, len(out))
        if name == "a" and opened.skipped < 0:
            opened.linked = 0 if closing else len(opened.elements)
    close()
    opened.cut(0, len(out))
    return out


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Stretches in which no ``window`` lines in a row are empty: first and last line, largest sum over a window."""
    out, first, last = [], -1, -1

    def most(a: int, b: int) -> int:
        total = best = sum(lengths[a : a + window])
        for i in range(a + window, b + 1):
            total += lengths[i] - lengths[i - window]
            best = max(best, total)
        return best

    for i, n in enumerate([*lengths, *[0] * window]):
        if n:
            first, last = (i if first < 0 else first), i
        elif first >= 0 and i - last >= window:
            out.append((first, last, most(first, last)))
            first = -1
    return out


def _around(lines: list[Line], a: int, b: int) -> Element:
    """The element around a stretch; of a stretch that is all of one text block, the element around that block."""
    own = e = lines[a].element
    while e.parent and not (e.first <= a and b < e.end):
        e = e.parent
    return e.parent if e is own and e.parent and e.name not in _WHOLE else e


def _beside(line: Line, e: Element) -> bool:
    return line.element is e or line.element.parent is e


def chosen_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> set[int]:
    """Numbers of the lines that the distribution of lengths takes for main text; article marks play no part.

    A stretch is kept if the sum over some window reaches ``surge``; where none does, the one with the most text is. A
    shorter stretch beside it in the same element, lines between two kept ones of the same element, and blocks of link
    text at its edge belong to it. Of the page's body only blocks directly in it count as the same element.
    """
    lengths = [line.size for line in lines]
    found = stretches(lengths, window)
    if not found:
        return set()
    if all(best < surge for _, _, best in found):
        a, b, _ = max(found, key=lambda s: (sum(lengths[s[0] : s[1] + 1]), -s[0]))
        kept = {(a, b): _around(lines, a, b)}
    else:
        kept = {(a, b): _around(lines, a, b) for a, b, best in found if best >= surge}

    def belongs(a: int, b: int, e: Element) -> bool:
        if e.name in _WHOLE:
            return all(_beside(lines[i], e) for i in range(a, b + 1) if lines[i].text)
        return e.first <= a and b < e.end

    # nearest kept stretch on either side of each short one
    for way in (1, -1):
        near = None
        for a, b, _ in found[::way]:
            if (a, b) in kept:
                near = kept[a, b]
            elif near and belongs(a, b, near):
                kept[a, b] = near
    chosen: set[int] = set()
    end, around = -1, None
    for (a, b), e in sorted(kept.items(), key=lambda s: s[0]):
        if e is around and e.name not in _WHOLE:
            chosen.update(range(end + 1, a))
        chosen.update(range(a, b + 1))
        end, around = b, e
        for way, i in ((-1, a - 1), (1, b + 1)):
            while 0 <= i < len(lines) and lines[i].text and not lines[i].size and _beside(lines[i], e):
                if e.name in _WHOLE and lines[i].element.name not in _HEADINGS:
                    break
                chosen.add(i)
                i += way
    return chosen


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of one page, its blocks separated by an empty line; empty if there is none.

    Surge and dive points choose the text of every page. A check afterwards adds lines of marked articles that they
    missed; it never takes a line away.
    """
    if not page:
        return ""
    lines = lines_of(page)
    chosen = chosen_lines(lines, window, surge)
    return "\n\n".join(line.text for i, line in enumerate(lines) if line.text and (i in chosen or line.in_article))


def extract_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    window: int = WINDOW,
    surge: int = SURGE,
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    Null or empty html and pages without text give an empty text; malformed markup is read as far as it goes; repeated
    rows are handled each on its own; other columns are ignored; an empty table gives no rows. Narrow, row by row.
    """

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return page.map(lambda p: main_text(p, window, surge), na_action=None)

    rows = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    found = rows.select("page_id", "url", text_of("html").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
