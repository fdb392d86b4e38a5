"""A small HTML tree: elements, the text under them, and their features.

Only what text extraction needs: comments, declarations, scripts, styles and
other elements without readable text are skipped; void elements and the usual
implied end tags are known; a tag cut off at the end of a page is dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = set("script style noscript template head title svg iframe object select textarea button option canvas".split())
RAW = set("script style title textarea noscript iframe".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSE_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "p": set()}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
# Looked for in the page itself: lowering it may change its length (U+0130).
_ENDS = {t: re.compile("</head|<body" if t == "head" else f"</{t}", re.IGNORECASE | re.ASCII) for t in RAW | UNREAD}
_ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")

# Kinds of attribute tokens, by what page authors call the parts of a page.
TOKENS = {
    "content": "article content main story post entry body text prose blog news page",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs links toc tabs pager pagination",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner adsbygoogle teaser offer",
    "comment": "comment comments reply replies discussion respond disqus reader feedback",
    "notice": "cookie cookies notice alert consent gdpr popup modal overlay message warning newsletter subscribe",
    "side": "sidebar aside side widget related recommended popular trending rail more also",
    "head": "header masthead top logo brand topbar hero",
    "foot": "footer foot bottom copyright legal colophon credits",
    "form": "form login search signup contact subscribe",
    "share": "share social sharing tools meta byline tags",
}
_KIND = {t: k for k, ts in TOKENS.items() for t in ts.split()}
KINDS = list(TOKENS)
TAGS = {
    "article": ("article",), "main": ("main",), "section": ("section",), "div": ("div",), "p": ("p",),
    "heading": ("h1", "h2", "h3", "h4", "h5", "h6"), "list": ("ul", "ol", "dl"), "item": ("li", "dt", "dd"), "a": ("a",),
    "nav": ("nav",), "aside": ("aside",), "header": ("header",), "footer": ("footer",), "form": ("form", "fieldset"),
    "quote": ("blockquote", "pre", "figure", "figcaption"), "table": ("table", "tr", "td", "th", "tbody", "thead"), "body": ("html", "body"),
}
_TAG_KIND = {t: i for i, ts in enumerate(TAGS.values()) for t in ts}


@dataclass
class Page:
    """Elements in page order (parents first) and pieces of text with their element."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    kinds: list[set[str]] = field(default_factory=lambda: [set()])
    mark: list[str] = field(default_factory=lambda: [""])
    # (element, text); text None is a block boundary.
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _text_kinds(attributes: str) -> tuple[set[str], str]:
    kinds, mark = set(), ""
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name == "data-y":
            mark = value
        else:
            kinds |= {_KIND[t] for t in _NAME.findall(value) if t in _KIND}
    return kinds, mark


class _Open:
    """The open elements, with the places of each name, so that no end tag has to
    walk up a deep page."""

    def __init__(self, page: Page):
        self.page = page
        self.stack = [0]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of elements that aren't inline

    def push(self, element: int) -> None:
        tag = self.page.tag[element]
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def last(self, names: Iterable[str]) -> int:
        """The innermost place of an element of these names; 0 if none is open."""
        return max((self.places[t][-1] for t in names if self.places.get(t)), default=0)

    def close(self, place: int) -> None:
        """Closes the element at ``place`` and all in it."""
        for element in reversed(self.stack[place:]):
            tag = self.page.tag[element]
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
        del self.stack[place:]

    def close_to(self, names: set[str], scope: set[str]) -> None:
        """Closes the innermost of ``names``, unless one of ``scope`` (none given: any
        element that isn't inline) stands further in."""
        place = self.last(names)
        if place and place >= (self.last(scope) if scope else self.blocks[-1] if self.blocks else 0):
            self.close(place)

    def end(self, tag: str) -> None:
        """The end tag of ``tag``: one of an inline element doesn't leave its block."""
        place = self.last((tag,))
        if place and not (tag in INLINE and self.blocks and self.blocks[-1] > place):
            self.close(place)


def parse(source: str) -> Page:
    page = Page()
    open_ = _Open(page)
    at, n = 0, len(source)
    unended: set[str] = set()  # elements whose end tag doesn't come any more

    def text(s: str) -> None:
        if s:
            page.pieces.append((open_.stack[-1], html.unescape(s)))

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        text(source[at:lt])
        following = source[lt + 1 : lt + 2]
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if following in ("!", "?"):
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(source, lt) or _LOOSE_TAG.match(source, lt)
        if not m:
            if following.isalpha() or following == "/" or not following:
                at = n if source.find(">", lt) < 0 else source.find(">", lt) + 1
            else:
                text("<")
                at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if tag not in INLINE:
            page.pieces.append((open_.stack[-1], None))
        if m[1]:
            if tag not in ("html", "body"):
                open_.end(tag)
            continue
        if tag in RAW or tag in UNREAD:
            end = None if tag in unended else _ENDS[tag].search(source, at)
            if end is None:
                unended.add(tag)
            if tag == "head":
                at = end.start() if end else at
                continue
            if end:
                gt = source.find(">", end.start())
                at = n if gt < 0 else gt + 1
            elif tag in RAW:
                at = n
            continue
        if tag in CLOSE_P:
            open_.close_to({"p"}, SCOPES["p"])
        if tag in CLOSES:
            open_.close_to(CLOSES[tag], SCOPES.get(tag, set()))
        if tag in VOID:
            if tag == "br":
                text(" ")
            continue
        kinds, mark = _text_kinds(m[3])
        page.tag.append(tag)
        page.parent.append(open_.stack[-1])
        page.kinds.append(kinds)
        page.mark.append(mark)
        if not m[3].endswith("/"):
            open_.push(len(page.tag) - 1)
    return page


FEATURES = (
    [f"tag_{t}" for t in TAGS]
    + [f"own_{k}" for k in KINDS]
    + [f"above_{k}" for k in KINDS]
    + ["above_content_tag", "above_other_tag", "depth", "children", "own_chars", "chars", "share", "share_of_parent", "link_share", "chars_per_element", "stops", "sibling", "siblings", "siblings_same", "paragraphs"]
)
_OTHER = {"nav", "aside", "footer", "header", "form", "fieldset"}


def features(page: Page) -> np.ndarray:
    """One row per element: its tag, attribute tokens and those above it, depth,
    text and link density of its subtree, and its place among its siblings."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own, stops, linked, paragraphs = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tag[i] == "a" or in_link[page.parent[i]]
        paragraphs[i] = page.tag[i] == "p"
    for i, s in page.pieces:
        if s is not None and (k := len(s.strip())):
            own[i] += k
            stops[i] += s.count(".") + s.count(",")
            linked[i] += k * in_link[i]
    chars, links, marks, elements = own.copy(), linked.copy(), stops.copy(), np.ones(n)
    children = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        elements[p] += elements[i]
        paragraphs[p] += paragraphs[i]
        children[p] += 1
    out = np.zeros((n, len(FEATURES)))
    t, k = len(TAGS), len(KINDS)
    depth = np.zeros(n)
    nth: dict[int, int] = {}
    same: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        same[page.parent[i], page.tag[i]] = same.get((page.parent[i], page.tag[i]), 0) + 1
    above, base = t + k, t + 2 * k
    index = {kind: j for j, kind in enumerate(KINDS)}
    for i in range(n):
        if page.tag[i] in _TAG_KIND:
            out[i, _TAG_KIND[page.tag[i]]] = 1
        for kind in page.kinds[i]:
            out[i, t + index[kind]] = 1
        p = page.parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            out[i, above : above + k] = np.maximum(out[p, above : above + k], out[p, t : t + k])
            out[i, base] = max(out[p, base], page.tag[p] in ("article", "main"))
            out[i, base + 1] = max(out[p, base + 1], page.tag[p] in _OTHER)
            nth[p] = nth.get(p, -1) + 1
            out[i, base + 11] = nth[p]
            out[i, base + 13] = same[p, page.tag[i]]
    up = np.maximum(parent, 0)
    total = max(chars[0], 1)
    out[:, base + 2 : base + 11] = np.stack(
        [depth, children, np.log1p(own), np.log1p(chars), chars / total, chars / np.maximum(chars[up], 1), links / np.maximum(chars, 1), chars / elements, 100 * marks / np.maximum(chars, 1)], axis=1
    )
    out[:, base + 12], out[:, base + 14] = children[up], paragraphs
    return out


def blocks(page: Page, chosen: np.ndarray) -> list[str]:
    """Text of the chosen elements, a string a block, white space made one space."""
    out, current = [], []
    for i, s in page.pieces:
        if s is None:
            out.append("".join(current))
            current = []
        elif chosen[i]:
            current.append(s)
    out.append("".join(current))
    return [b for b in (" ".join(b.split()) for b in out) if b]
