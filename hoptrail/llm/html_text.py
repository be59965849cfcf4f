"""Main text of web pages by tree scoring.

A page becomes a tree. Elements that are never part of an article (menus, forms,
adverts, scripts, ...) leave it, by tag, role or the words of a class or id. Every
paragraph then passes points for its length and commas to its ancestors, fewer with
each level, and an element's points are discounted by the share of its text that lies
in links. The element with the most points is the container; it grows to the article
element around it. Without one it grows upwards, at each level by plain paragraphs,
headings, lists and sections beside it and by further containers whose points come near its own.

Words of names count like this. Words of reader comments drop an element anywhere.
Plain words (``ad``, ``menu``, ``sidebar``) do so in any compound but for layout flags
(``no-sidebar``); ambiguous words (``share``, ``related``) only if the whole name
consists of such words. Headings and paragraphs are never dropped by name, nor is what
holds an article element or most of the page's text, nor a section with a heading by
its id, which is the heading's slug.

Defined cases: null, empty and text-free pages give an empty text; broken markup
is read as browsers read it (open elements end with their parent, an unknown
declaration is a comment up to ``>``, a comment ends with ``--!>`` too, an unfinished
tag at the end is dropped); a page without paragraphs falls back to its body;
repeated rows are each extracted. Work is per row and linear in the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.workers import ship

BATCH_ROWS = 256

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img br".split()
)
_DROPPED = frozenset(
    "head script style noscript template nav footer aside form button input select option textarea iframe"
    " svg canvas object embed audio video dialog menu map title".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
_HOLDERS = frozenset("div section article main body".split())
_ARTICLES = frozenset(("article", "main"))
# Kinds of elements that one of their kind ends, up to the given limits.
_SCOPES = frozenset("html body table td th caption button object".split())
_KINDS = (
    (frozenset(("p",)), _SCOPES),
    (frozenset(("a",)), _SCOPES),
    (frozenset(("li",)), frozenset("ul ol menu".split())),
    (frozenset(("dt", "dd")), frozenset(("dl",))),
    (frozenset(("tr",)), frozenset(("table",))),
    (frozenset(("td", "th")), frozenset("tr table".split())),
)
_KIND_OF = {tag: kind for kind, (tags, _) in enumerate(_KINDS) for tag in tags}

_COMMENTS = frozenset("comment comments commentlist commentary commenter disqus respond replies".split())
_PLAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies"
    " gdpr newsletter popup modal breadcrumb breadcrumbs menu nav navbar navigation pagination pager sidebar"
    " masthead footer".split()
)
_AMBIGUOUS = frozenset(
    "consent subscribe subscription banner overlay share sharing social related recommended recommendations"
    " toolbar login signup search skip header foot side notice notices alert widget rail meta tags copyright".split()
)
_FILLERS = frozenset(
    "left right top bottom bar bars box boxes block blocks container wrapper wrap inner outer area list item items"
    " link links button buttons form site page global primary secondary section column media post posts article"
    " articles story stories content contents news more column panel slot icons follow us".split()
)
_FLAGS = frozenset("no not has with without is enabled disabled hide hidden show layout theme on off".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
_START_POINTS = {"article": 10.0, "main": 10.0, "section": 3.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0}
_LEVELS = 5

_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = (
        "tag", "attrs", "parent", "children", "points", "length", "linked", "commas", "near", "article", "plain", "heading"
    )

    def __init__(self, tag: str, attrs: dict, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []
        self.points, self.length, self.linked, self.commas = 0.0, 0, 0, 0
        # The open element of each kind that a tag in here would end.
        self.near: tuple[Element | None, ...] = (None,) * len(_KINDS)
        self.article, self.plain, self.heading = False, 0, False


_COMMENT_END = re.compile("--!?>")


class _Tree(HTMLParser):
    """The whole page is fed at once, so what has no end runs to the end of the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Element("#root", {}, None)
        self.depths: dict[str, int] = {}

    def _end(self, element: Element) -> None:
        """Close an open element and all in it."""
        while self.open is not element.parent:
            self.depths[self.open.tag] -= 1
            self.open = self.open.parent

    def handle_starttag(self, tag, attrs):
        ends = [0] if tag not in _INLINE else []
        if tag in _KIND_OF and tag != "p":
            ends.append(_KIND_OF[tag])
        for kind in ends:
            if (element := self.open.near[kind]) is not None:
                self._end(element)
        element = Element(tag, dict(attrs), self.open)
        self.open.children.append(element)
        if tag not in _VOID:
            element.near = tuple(
                element if tag in tags else None if tag in limits else held
                for (tags, limits), held in zip(_KINDS, self.open.near)
            )
            self.depths[tag] = self.depths.get(tag, 0) + 1
            self.open = element

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        at = self.open if self.depths.get(tag) else self.root
        while at.parent is not None:
            if at.tag == tag:
                self._end(at)
                return
            if tag in _INLINE and at.tag not in _INLINE:
                return
            at = at.parent

    def handle_data(self, data):
        self.open.children.append(data)

    def parse_comment(self, i, report=1):
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        return self.parse_pi(i)

    def parse_bogus_comment(self, i, report=1):
        return self.parse_pi(i)

    def parse_pi(self, i):
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else len(self.rawdata)


def parse(html: str) -> Element:
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match(r"[A-Za-z/!?]", html[last + 1 :]):
        html = html[:last]
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _words(name: str) -> set[str]:
    return {x.lower() for x in _NAME_PARTS.findall(name)}


def _says_comments(words: set[str]) -> bool:
    return bool(words & _COMMENTS) and not words & _FLAGS


def _says_boilerplate(words: set[str]) -> bool:
    if words & _FLAGS:
        return False
    known = _PLAIN | _AMBIGUOUS
    return bool(words & _PLAIN) or (bool(words & _AMBIGUOUS) and words <= known | _FILLERS)


def boilerplate(element: Element, in_article: bool, whole: int) -> bool:
    """``whole`` is the length of the page's text outside links."""
    tag, attrs = element.tag, element.attrs
    if tag in _DROPPED or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    if "hidden" in attrs or re.search(r"display\s*:\s*none", attrs.get("style") or ""):
        return True
    if (attrs.get("role") or "").lower() in _ROLES:
        return True
    if tag in _ARTICLES or tag in _HEADINGS or tag in _PARAGRAPHS - {"td", "li"} or element.article:
        return False
    names = [_words(x) for x in (attrs.get("class") or "").split()]
    slug = _words(attrs.get("id") or "")
    # A slug of comments alone is theirs, of more words it may be a heading's.
    if any(map(_says_comments, names)) or (_says_comments(slug) and (not element.heading or slug <= _COMMENTS | _FILLERS)):
        return True
    if not element.heading:
        names.append(slug)
    return any(map(_says_boilerplate, names)) and 2 * element.plain <= whole


def survey(root: Element) -> None:
    """What each element holds: an article, a heading, text outside links."""
    for element in reversed(_in_order(root)):
        element.article = element.tag in _ARTICLES
        for child in element.children:
            if isinstance(child, str):
                element.plain += len(child.strip())
            elif child.tag not in _DROPPED:
                element.article |= child.article
                element.heading |= child.heading or child.tag in _HEADINGS
                element.plain += 0 if child.tag == "a" else child.plain


def prune(root: Element) -> None:
    """Take out what is never part of an article."""
    survey(root)
    waiting = [(root, False)]
    while waiting:
        element, inside = waiting.pop()
        inside = inside or element.tag in _ARTICLES
        element.children = [
            c for c in element.children if isinstance(c, str) or not boilerplate(c, inside, root.plain)
        ]
        waiting.extend((c, inside) for c in element.children if not isinstance(c, str))


def _in_order(root: Element) -> list[Element]:
    found, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        found.append(element)
        waiting.extend(c for c in reversed(element.children) if not isinstance(c, str))
    return found


def score(elements: list[Element]) -> None:
    """Measure all elements, children first, and pass the paragraphs' points up."""
    for element in reversed(elements):
        for child in element.children:
            if isinstance(child, str):
                element.length += len(child.strip())
                element.commas += child.count(",")
            else:
                element.length += child.length
                element.commas += child.commas
                element.linked += child.length if child.tag == "a" else child.linked
    for element in elements:
        element.points += _START_POINTS.get(element.tag, 0.0) if element.length else 0.0
    for element in elements:
        if element.tag in _PARAGRAPHS:
            length, commas = element.length, element.commas
        elif element.tag in _HOLDERS:
            own = [c for c in element.children if isinstance(c, str)]
            length, commas = sum(len(c.strip()) for c in own), sum(c.count(",") for c in own)
        else:
            continue
        if not length:
            continue
        points = (length >= 25) + commas + min(length / 100, 3.0)
        points *= 1 - element.linked / max(1, element.length)
        above, level = element.parent if element.tag in _PARAGRAPHS else element, 0
        while above is not None and level < _LEVELS:
            above.points += points / (1, 2, 6, 9, 12)[level]
            above, level = above.parent, level + 1


def _final(element: Element) -> float:
    return element.points * (1 - element.linked / max(1, element.length))


_BESIDE = _PARAGRAPHS | _HEADINGS | frozenset("ul ol dl table figure tbody tr th dt details section".split())


def _belongs(element: Element | str, best: Element) -> bool:
    """Whether what stands beside the container is a part of the article: paragraphs,
    headings, lists and sections that are not mostly links, and containers near it in
    points."""
    if isinstance(element, str) or element.tag in _INLINE:
        return True
    if 2 * element.linked > element.length:
        return False
    return element.tag in _BESIDE or _final(element) >= max(10.0, 0.2 * _final(best))


def _with_surroundings(best: Element) -> Element:
    """The container with what belongs to it on each level, up to the body."""
    at, whole = best, best
    while at.parent is not None and at.tag not in ("body", "html"):
        group = Element(at.parent.tag, {}, None)
        for c in at.parent.children:
            if c is at:
                group.children.append(whole)
            elif _belongs(c, best):
                group.children.append(c)
        at, whole = at.parent, group
    return whole


def containers(root: Element) -> list[Element]:
    """The best container and the siblings that belong to it, in page order."""
    elements = _in_order(root)
    score(elements)
    candidates = [e for e in elements if e.points > 0 and e.length and e.tag not in ("#root", "html")]
    if not candidates:
        return [root]
    best = max(candidates, key=_final)
    above, around = best.parent, best if best.tag in _ARTICLES else None
    while above is not None:
        around = above if above.tag in _ARTICLES and not (above.tag == "main" and around) else around
        above = above.parent
    if around is None:
        return [_with_surroundings(best)]
    best = around
    if best.parent is None:
        return [best]
    least, kept = max(10.0, 0.2 * _final(best)), []
    for sibling in best.parent.children:
        if sibling is best:
            kept.append(sibling)
        elif not isinstance(sibling, str) and sibling.length:
            plain = sibling.linked < 0.25 * sibling.length
            more = sibling.tag in ("article", "section") and _final(sibling) >= least
            if plain and (more or (sibling.tag == "p" and sibling.length > 80)):
                kept.append(sibling)
    return kept


def blocks(element: Element) -> list[str]:
    """The text of each block, white space turned into single spaces."""
    found: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join("".join(line).split()):
            found.append(text)
        line.clear()

    waiting: list = [element]
    while waiting:
        at = waiting.pop()
        if at is None:
            end()
        elif isinstance(at, str):
            line.append(at)
        elif at.tag == "br":
            line.append(" ")
        else:
            if at.tag not in _INLINE:
                end()
                waiting.append(None)
            waiting.extend(reversed(at.children))
    end()
    return found


def main_text(html: str | None) -> str:
    root = parse(html or "")
    prune(root)
    return "\n".join(t for c in containers(root) for t in blocks(c))


def extract_text(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every page with its ``text`` and ``n_chars``."""
    ship(pages.sparkSession)
    keep = ["page_id", "url"] if keep is None else keep
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                texts = [main_text(h) for h in part.column("_page_html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*keep, "text", "n_chars"],
                )

    source = pages.select(*keep, F.col("html").alias("_page_html"))
    return source.mapInArrow(extract, f"{kept}, text string, n_chars long")
