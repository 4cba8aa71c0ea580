"""Main text of web pages by the line-block distribution.

Markup is stripped, page furniture with it, and what is left is one line per
block element. Each line block sums the text of a few lines in a row; the
article lies between the points where that sum surges and where it dives.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import map_texts

# Elements that end a line.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is never part of the article.
FURNITURE = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frameset head iframe input map menu nav "
    "noframes noscript object script search select style svg template textarea title video".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not markup.
RAW = frozenset("script style textarea title iframe noframes xmp noembed".split())
# Words of a class or id that make an element weigh less, and roles that mark page furniture.
LABELS = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert alerts banner banners breadcrumb breadcrumbs "
    "captcha comment comments commentlist consent cookie cookies copyright disclaimer disqus footer footnav gdpr "
    "header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification outbrain "
    "overlay pager paging pagination popup promo promotion promotions recommended related replies reply respond "
    "search share sharing sidebar sidenav signup skyscraper social sponsor sponsored sponsors subscribe taboola "
    "teaser toolbar topbar widget widgets".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# Those of them that mark comments, and that mark lists of other pages' texts.
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
OTHERS = frozenset(
    "outbrain promo promotion promotions recommended related sidebar sidenav sponsor sponsored sponsors taboola teaser "
    "widget widgets".split()
)
# Words before a label that say it is elsewhere, absent or a topic.
MODIFIERS = frozenset("category has have hide hides no non not tag topic with without".split())
# Elements that hold texts which belong together.
HOLDERS = frozenset("article center details div fieldset main section td th".split())
# Elements whose id is an anchor for links, not a label.
ANCHORED = frozenset("blockquote dd dt h1 h2 h3 h4 h5 h6 p pre".split())
#: Elements that hold the article where a page names one.
ARTICLE = frozenset(("article", "main"))
# Elements that end tags of others do not reach out of, and end tags that do all the same.
CELLS = frozenset(("caption", "td", "th"))
# Starts that end an open element of certain names, unless one of the others lies between.
SECTIONS = ("tbody", "tfoot", "thead", "tr", "caption", "colgroup")
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "caption", "td", "th", *ARTICLE)),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl", "caption", "td", "th", *ARTICLE))),
    **dict.fromkeys(("td", "th"), (("td", "th", "caption"), ("table", "tr"))),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    **dict.fromkeys(("tbody", "tfoot", "thead"), (SECTIONS, ("table",))),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
# Starts that end a paragraph, and what a paragraph around does not end at.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd li fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
AROUND_P = ("applet", "button", "caption", "marquee", "object", "table", "td", "template", "th")
# Elements of a head; any other start ends it.
OF_HEAD = frozenset("base basefont bgsound link meta noframes noscript object script style template title".split())
ACROSS = CELLS | ARTICLE | frozenset(("body", "html", "table", "tbody", "tfoot", "thead", "tr"))

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.DOTALL,
)
MARK = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)

#: Lines summed to one line block.
WINDOW = 3
#: The article surges where a line block weighs this much, or this share of the page's largest one if that is less.
TEXT, SURGE = 120, 0.2
#: The parts (one in so many) of their length that links in an article, and text outside one that the page names, weigh.
LINKED, OUTSIDE = 4, 4
#: The part (one in so many) that text in a labelled element weighs.
LABELLED = 10


def labels_of(name: str, attributes: str) -> set[str]:
    """The words of class and id that mark furniture. What a has- or no- names is elsewhere or nowhere."""
    found: set[str] = set()
    for key, *values in MARK.findall(attributes):
        key = key.lower()
        if key == "class" or key == "id" and name not in ANCHORED:
            for token in "".join(values).lower().split():
                words = re.split(r"[^a-z0-9]+", token)
                plain = next((i for i, word in enumerate(words) if word in MODIFIERS), len(words))
                found.update(LABELS.intersection(words[:plain]))
    return found


def is_furniture(name: str, attributes: str, inside: bool) -> bool:
    """``inside``: within an article, where a header holds its title."""
    if name in FURNITURE or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, *values in MARK.findall(attributes):
        if key.lower() == "role" and "".join(values).lower().strip() in ROLES or key.lower() == "hidden":
            return True
    return not COMMENTS.isdisjoint(labels_of(name, attributes))


def is_labelled(name: str, attributes: str, inside: bool) -> bool:
    """Whether class or id mark this as furniture, which weighs less than other text."""
    if not attributes or name in ("html", "body") or inside and name == "header":
        return False
    return bool(labels_of(name, attributes))


def keeps_articles(name: str, attributes: str, ended: bool) -> bool:
    """Whether articles in this furniture are comments or teasers, not the page's own.

    Furniture without an end tag (``ended``) was left open, unless it holds comments.
    """
    labels = labels_of(name, attributes)
    return not COMMENTS.isdisjoint(labels) or ended and (name == "aside" or not OTHERS.isdisjoint(labels))


class Open:
    """The open elements, innermost last. Each has a number, and what else the caller keeps of it."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}

    def nearest(self, *names: str) -> int:
        """Where the innermost element of one of these names lies, -1 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, name: str, number: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, number))

    def cut(self, place: int) -> list[int]:
        """Close the element at ``place`` and all within it; their numbers, innermost first."""
        closed = []
        while len(self.stack) > place:
            name, number = self.stack.pop()
            self.places[name].pop()
            closed.append(number)
        return closed

    def implied(self, name: str) -> list[int]:
        """A start tag: the numbers of the elements that it ends, as their end tags may be left out."""
        closed: list[int] = []
        if name not in OF_HEAD and self.nearest("head") > self.nearest("noscript", "object", "template"):
            closed += self.cut(self.nearest("head"))
        if name in SIBLINGS:
            names, bounds = SIBLINGS[name]
            places = [self.nearest(n) for n in names]
            bound = self.nearest(*bounds)
            if max(places) > bound:
                closed += self.cut(min(i for i in places if i > bound))
        if name in ENDS_P and self.nearest("p") > self.nearest(*AROUND_P):
            closed += self.cut(self.nearest("p"))
        return closed

    def ended(self, name: str) -> list[int]:
        """An end tag: the numbers of the elements it closes, none if no such element is open here."""
        place = self.nearest(name)
        return self.cut(place) if place >= 0 and (name in ACROSS or place > self.nearest(*CELLS)) else []


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """Texts as ``(text, "", "", False)`` and tags as ``("", name, attributes, closing)``.

    An element whose content is not markup comes as a tag that closes itself.
    """
    place, n = 0, len(page)
    while place < n:
        tag = TAG.search(page, place)
        if tag is None:
            yield page[place:], "", "", False
            return
        if tag.start() > place:
            yield page[place : tag.start()], "", "", False
        place = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        attributes = tag[3] or tag[6] or ""
        if name in RAW and not closing and not attributes.endswith("/"):
            # Up to the end tag nothing is markup.
            stop = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, place)
            place = stop.end() if stop else n
            attributes += "/"
        yield "", name, attributes, closing


def structure(page: str) -> tuple[list[tuple[str, str, str, int]], set[int]]:
    """The page in order, and which elements have an end tag of their own.

    Its parts are kind, name, attributes and number. Kinds are ``text`` (the
    text for a name), ``open``, ``close``, ``empty``, and ``stray`` for an end
    tag of nothing.
    """
    found: list[tuple[str, str, str, int]] = []
    ended: set[int] = set()
    names: list[str] = []
    open_ = Open()
    for text, name, attributes, closing in tokens(page):
        if not name:
            found.append(("text", text, "", -1))
        elif closing:
            closed = [] if name in VOID else open_.ended(name)
            found += [("close", names[i], "", i) for i in closed] or [("stray", name, "", -1)]
            ended.update(closed[-1:])
        elif name in VOID or attributes.endswith("/"):
            found += [("close", names[i], "", i) for i in open_.implied(name)]
            found.append(("empty", name, attributes, -1))
        else:
            found += [("close", names[i], "", i) for i in open_.implied(name)]
            open_.push(name, len(names))
            found.append(("open", name, attributes, len(names)))
            names.append(name)
    found += [("close", names[i], "", i) for i in open_.cut(0)]
    return found, ended


class Line(NamedTuple):
    """``text`` is empty where furniture was, so that the distribution dives."""

    text: str
    #: Characters that are links.
    linked: int
    #: The numbers of the outermost article and of the innermost labelled element, or -1.
    article: int
    label: int
    #: How many labelled elements it lies in.
    labels: int
    #: The number of the element that holds it, -1 for the body.
    holder: int


def lines_of(page: str) -> tuple[list[Line], dict[int, tuple[int, int]]]:
    """The lines, and between which two each holder begins and ends."""
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    anchors = 0
    articles: list[int] = []
    # Open furniture and labelled elements, outermost first: the number, and whether articles in it are others' too.
    skipped: list[tuple[int, bool]] = []
    labelled: list[tuple[int, bool]] = []
    holders: list[tuple[int, int]] = []
    spans: dict[int, tuple[int, int]] = {}

    def add(text: str) -> None:
        within = articles[0] if articles else -1, labelled[-1][0] if labelled else -1, len(labelled)
        lines.append(Line(text, min(len(text), linked), *within, holders[-1][0] if holders else -1))

    def end() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                add(text)
            parts.clear()
        linked = 0

    def gap() -> None:
        end()
        if lines and lines[-1].text:
            add("")

    found, ended = structure(page)
    for kind, name, attributes, number in found:
        if kind == "text":
            if not skipped:
                parts.append(name)
                linked += len(name) * (anchors > 0)
            continue
        if kind == "open":
            furniture = is_furniture(name, attributes, bool(articles))
            label = not furniture and is_labelled(name, attributes, bool(articles))
            if name in ARTICLE and not (furniture or label) and not any(keeps for _, keeps in skipped + labelled):
                gap()
                skipped.clear()
                labelled.clear()
            if furniture or label:
                gap()
                keeps = keeps_articles(name, attributes, number in ended)
                (skipped if furniture else labelled).append((number, keeps))
        elif kind == "close" and labelled and number == labelled[-1][0]:
            gap()
            labelled.pop()
        if skipped:
            if kind == "close" and number == skipped[-1][0]:
                skipped.pop()
                gap()
            continue
        if name in BLOCKS:
            end()
            anchors = 0
        if name in HOLDERS and kind == "open":
            holders.append((number, len(lines)))
        elif holders and number == holders[-1][0] and kind == "close":
            spans[number] = holders.pop()[1], len(lines)
        if name in ARTICLE:
            if kind == "open" and not labelled:
                articles.append(number)
            elif number in articles:
                articles.remove(number)
        elif name == "a" and kind != "empty":
            anchors = kind == "open"
    end()
    return lines, spans


def connected(lines: list[Line], weights: list[float], spans: dict[int, tuple[int, int]]) -> list[list[int]]:
    """Runs of lines with weight, each of one article and labelled element, between two dives.

    Outside articles a line with text and no weight is a dive. So is a gap,
    except between lines of one holder or where the holder on one side has the
    line on the other side, too. Inside an article neither ends a run.
    """
    runs: list[list[int]] = []
    # Of each article and label: the run that is open, its holders, and where the last of them ends.
    open_: dict[tuple[int, int], tuple[list[int], set[int], int]] = {}
    for i, (line, weight) in enumerate(zip(lines, weights, strict=True)):
        region = line.article, line.label
        if weight <= 0:
            if line.text and line.article < 0:
                open_.pop(region, None)
            continue
        first, stop = spans.get(line.holder, (len(lines), 0))
        run, holders, reach = open_.get(region, ([], set(), 0))
        near = run and (run[-1] + 1 == i or line.holder in holders or i < reach or first <= run[-1])
        if not near and not (run and line.article >= 0):
            run, holders, reach = [], set(), 0
            runs.append(run)
        run.append(i)
        holders.add(line.holder)
        open_[region] = run, holders, max(reach, stop)
    return runs


def main_text(page: str | None) -> str:
    """The article's lines, joined by line breaks; empty if the page has none.

    A line weighs as much as its text outside links; a line that is mostly
    links weighs nothing. The article surges where a line block reaches
    ``TEXT``, or on pages of short lines ``SURGE`` of the largest block, and
    extends to both sides up to the next dive (see ``connected``). Where a page
    names its article, that is a weight: links inside weigh a ``LINKED`` of
    their text, and text outside an ``OUTSIDE``. A label makes text weigh a
    ``LABELLED``. A line block does not reach across the border of an article
    or labelled element.
    """
    lines, spans = lines_of(page or "")
    named = any(line.article >= 0 for line in lines)
    weights: list[float] = []
    for line in lines:
        rest = len(line.text) - line.linked
        if line.article >= 0:
            rest += line.linked / LINKED
        elif line.linked > rest:
            rest = 0
        elif named:
            rest /= OUTSIDE
        weights.append(rest / LABELLED ** min(line.labels, 9))
    regions = [(line.article, line.label) for line in lines]
    blocks = [
        sum(w for w, r in zip(weights[i : i + WINDOW], regions[i : i + WINDOW], strict=True) if r == regions[i])
        for i in range(len(weights))
    ]
    least = max(1.0, min(TEXT, SURGE * max(blocks, default=0)))
    kept = [i for run in connected(lines, weights, spans) if any(blocks[i] >= least for i in run) for i in run]
    return "\n".join(lines[i].text for i in sorted(kept))


def extracted(
    pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html"
) -> DataFrame:
    """Per page: the key, the address, ``text`` and ``n_chars`` (code points).

    A null or empty page has the empty text; repeated rows come back as often
    as they came in; an empty table gives an empty table.
    """

    def make():
        def each(found: list[str | None]) -> dict[str, list]:
            texts = [main_text(p) for p in found]
            return {"_text": texts, "_n": [len(t) for t in texts]}

        return each

    out = map_texts(pages, [key, url], [F.col(f"`{markup}`")], "_text string, _n long", make)
    return out.withColumnsRenamed({"_text": "text", "_n": "n_chars"})
