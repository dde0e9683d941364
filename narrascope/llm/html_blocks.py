"""Blocks of text of an HTML page, with the elements around them.

Tags are read as browsers do it where that decides what text is: end tags may be missing, raw
elements hide their markup, comments end late, an unfinished tag at the end is dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

# Elements of HTML and the words that name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("noscript template svg math object canvas video audio select datalist button head map".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "caption tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the second kind inside an element of the third.
ENDED_BY = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
SCOPE = frozenset("html table td th caption object template button".split())

CONTENT_TAGS = frozenset(["article", "main"])
CONTENT_ROLES = frozenset(["article", "main"])
OTHER_TAGS = frozenset("nav aside footer menu dialog search".split())
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split()
)
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot alert banner breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies copyright disqus foot footer gdpr login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notification overlay pager pagination popup promo promoted promotion "
    "rail recommendations recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
HEAD_WORDS = frozenset(["header", "head"])
CONTENT_WORDS = frozenset("article content entry main post prose story".split())
#: Words that say of the next one that it only is, or is not, somewhere else in the page.
ABOUT_WORDS = frozenset("has no with without".split())

_TAG = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>"
    r"|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([^\s/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_WORD = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    #: 1 in the text proper, -1 not, -2 not unless most of the page is in it, -3 not unless
    #: it is in an article, 0 nothing is known.
    hint: int
    weak: bool = False  # named like content only
    chars: int = 0
    holds_article: bool = False


@dataclass
class Block:
    element: int
    tag: str
    text: str
    link_chars: int


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _name_words(name: str) -> set[str]:
    words, skip = set(), False
    for word in (w.lower() for w in _WORD.findall(name)):
        if not skip:
            words.add(word)
        skip = word in ABOUT_WORDS
    return words


@lru_cache(1 << 14)
def _hint(tag: str, attributes: str) -> tuple[int, bool]:
    """What a tag says of the text inside it, and whether it is only named like content."""
    found = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    role = found.get("role", "").strip().lower()
    words = set()
    if tag not in ("html", "body"):
        for name in (*found.get("class", "").split(), found.get("id", "")):
            words |= _name_words(name)
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    if tag in OTHER_TAGS or role in OTHER_ROLES:
        return -1, False
    if tag == "form" or hidden or words & OTHER_WORDS:
        return -2, False
    if tag in CONTENT_TAGS or role in CONTENT_ROLES:
        return 1, False
    if tag == "header" or words & HEAD_WORDS:
        return -3, False
    return 0, bool(words & CONTENT_WORDS)


class _Reader:
    """Open elements and the text of the block that is being read."""

    def __init__(self):
        self.page = Page()
        self.page.elements.append(Element("", -1, 0, 0))
        self.open = [0]
        self.parts: list[str] = []
        self.unseen = 0  # open elements that are not shown
        self.link = 0  # open elements when a link began
        self.link_chars = 0

    def text(self, text: str) -> None:
        if self.unseen or not text:
            return
        if "&" in text:
            text = unescape(text)
        self.parts.append(text)
        if self.link:
            self.link_chars += len(text) - text.count(" ")

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            at = self.open[-1]
            self.page.blocks.append(Block(at, self.page.elements[at].tag, text, self.link_chars))
        self.parts.clear()
        self.link_chars = 0

    def pop_to(self, place: int) -> None:
        """Close the open element at ``place`` and all inside it."""
        self.flush()
        for at in self.open[place:]:
            self.unseen -= self.page.elements[at].tag in UNSEEN
        del self.open[place:]
        if self.link > len(self.open):
            self.link = 0

    def close(self, names, limits=frozenset(), first: int = 1) -> None:
        """Close the innermost open element of ``names`` that no element of ``limits`` is around."""
        for place in range(len(self.open) - 1, first - 1, -1):
            tag = self.page.elements[self.open[place]].tag
            if tag in names:
                self.pop_to(place)
                return
            if tag in limits:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
        elif tag == "a":
            self.link = len(self.open)
        elif tag == "body":
            self.close(("head",))
        if tag not in BLOCK and tag not in UNSEEN:
            return
        if tag in BLOCK:
            self.flush()
            if tag in ENDED_BY:
                self.close(*ENDED_BY[tag])
            else:
                self.close(("p",), SCOPE)
            if tag in HEADINGS and self.page.elements[self.open[-1]].tag in HEADINGS:
                self.pop_to(len(self.open) - 1)
        if tag in VOID:
            return
        parent = self.open[-1]
        hint, weak = _hint(tag, attributes)
        self.page.elements.append(Element(tag, parent, self.page.elements[parent].depth + 1, hint, weak))
        self.open.append(len(self.page.elements) - 1)
        self.unseen += tag in UNSEEN

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        elif tag in HEADINGS:
            self.close(HEADINGS, SCOPE)
        elif tag in ("body", "html"):
            self.flush()  # what comes behind is still read
        elif tag in BLOCK:
            self.close((tag,), () if tag in ("table", "td", "th", "caption") else SCOPE)
        elif tag in UNSEEN:
            self.close((tag,))


def read_page(html: str) -> Page:
    """Elements and blocks of a page, in page order."""
    reader, at = _Reader(), 0
    while found := _TAG.search(html, at):
        if found.start() > at:
            reader.text(html[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            reader.end(tag)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.start() if end else len(html)
            continue
        reader.start(tag, attributes)
    rest = _UNFINISHED.search(html, at)
    reader.text(html[at : rest.start()] if rest else html[at:])
    reader.flush()
    page = reader.page
    for block in page.blocks:
        step = block.element
        while step >= 0:
            page.elements[step].chars += len(block.text)
            step = page.elements[step].parent
    for element in reversed(page.elements):
        if element.parent >= 0 and (element.hint == 1 or element.tag == "h1" or element.holds_article):
            page.elements[element.parent].holds_article = True
    return page
