"""Text lines of a page's blocks, with what the markup says about them."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
#: Elements whose content is no running text, wherever they stand.
_MUTE = frozenset("script style title textarea xmp iframe noembed noframes noscript head template svg math canvas audio video object select option button datalist meter progress map dialog".split())
_FURNITURE = frozenset("nav aside footer form menu search".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup td th time tt u var wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of these closes an open p.
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Where the search for an open sibling stops.
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select", "datalist")}
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
_READERS = frozenset("comment comments commentlist disqus respond replies discussion".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar topbar masthead sidebar footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager widget widgets toolbar paywall banner skip".split()
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"'>]|$)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Line(NamedTuple):
    """A block's text, how much of it is links, whether it is in an article or main element, and under what it goes (nothing
    for running text)."""

    text: str
    linked: int
    article: bool
    heading: bool
    furniture: str


class _Open:
    __slots__ = ("article", "furniture", "name", "named", "voided")

    def __init__(self, name: str, furniture: str, named: bool, article: bool) -> None:
        self.name, self.furniture, self.named, self.article, self.voided = name, furniture, named, article, False


def _furniture(name: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """What furniture an element is, and whether only its names say so."""
    if name in _MUTE:
        return name, False
    if name in _FURNITURE or (name == "header" and not in_article):
        return name, False
    if not attributes or name in ("html", "body"):
        return "", False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return "hidden", False
        if key == "role" and value.lower() in _ROLES:
            return value.lower(), False
        if key in ("class", "id"):
            for one in value.split():
                parts = {p.lower() for p in _PART.findall(one)}
                if parts & _READERS:
                    return "comments", True
                if name not in ("main", "article", *_HEADINGS, "p") and not parts & {"no", "has", "with", "without", "content", "article", "main", "body", "entry", "post"} and parts & _NAMES:
                    return one, True
                if name in ("p", "article") and parts & {"ad", "ads", "advert", "advertisement", "sponsored"}:
                    return one, True
    return "", False


def lines(html: str) -> list[Line]:
    """The blocks of ``html`` that have text, in page order.

    Character references are decoded, white space in a block is one space, a line break too. Comments, declarations and the
    elements of _MUTE have no text. Tags that lack are closed as browsers do for paragraphs, list items and table cells; what follows a tag that
    never ends is dropped. An article or main element inside a container that only its class or id makes furniture, say an
    unclosed advert, takes that back.
    """
    out: list[Line] = []
    held: list[str] = []
    stack: list[_Open] = []
    count: dict[str, int] = {}
    tags: list[list[_Open]] = []
    state = {"a": 0, "linked": 0, "heading": 0}

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append(Line(text, state["linked"], any(o.article for o in stack), state["heading"] > 0, ""))
                tags.append([o for o in stack if o.furniture])
        state["linked"] = 0

    def pop() -> None:
        gone = stack.pop()
        count[gone.name] -= 1
        if gone.name == "a":
            state["a"] -= 1
        if gone.name in _HEADINGS:
            state["heading"] -= 1

    def close(name: str) -> None:
        if count.get(name):
            while stack[-1].name != name:
                pop()
            pop()

    def add(raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        if state["a"]:
            state["linked"] += len(text.strip())
        held.append(text)

    at, end = 0, len(html)
    while at < end:
        tag = html.find("<", at)
        if tag < 0:
            add(html[at:])
            break
        if tag > at:
            add(html[at:tag])
        if html.startswith("<!--", tag):
            stop = html.find("-->", tag + 4)
            at = end if stop < 0 else stop + 3
            continue
        follow = html[tag + 1 : tag + 2]
        if follow in ("!", "?"):
            stop = html.find(">", tag)
            at = end if stop < 0 else stop + 1
            continue
        if not (follow.isascii() and follow.isalpha()) and not (follow == "/" and html[tag + 2 : tag + 3].isascii() and html[tag + 2 : tag + 3].isalpha()):
            add("<")
            at = tag + 1
            continue
        m = _TAG.match(html, tag)
        if not m:
            break
        at, name = m.end(), m[2].lower()
        if name not in _INLINE:
            flush()
        elif name in ("br", "td", "th", "img"):
            held.append(" ")
        if m[1]:
            close(name)
            continue
        if name in _CLOSES_P and count.get("p"):
            flush()
            close("p")
        if name in _SIBLINGS:
            for o in reversed(stack[-32:]):
                if o.name in _SCOPE[name]:
                    break
                if o.name in _SIBLINGS[name]:
                    flush() if name not in ("td", "th") else None
                    close(o.name)
                    break
        if name in _HEADINGS or (name == "a" and count.get("a")):
            for h in _HEADINGS if name in _HEADINGS else ("a",):
                close(h)
        article = name in ("article", "main")
        furniture, named = _furniture(name, m[3], any(o.article for o in stack))
        if article and not named:
            for o in stack:
                o.voided = o.voided or (o.named and o.furniture != "comments")
        if name in _VOID or (m[3].endswith("/") and name in ("svg", "math", "path")):
            continue
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            at = end if stop is None else stop.start()
        if name in _RAW and furniture:
            if at < end:
                shut = html.find(">", at)
                at = end if shut < 0 else shut + 1
            continue
        stack.append(_Open(name, furniture, named, article))
        count[name] = count.get(name, 0) + 1
        if name == "a":
            state["a"] += 1
        if name in _HEADINGS:
            state["heading"] += 1
    flush()
    return [line._replace(furniture=next((o.furniture for o in under if not o.voided), "")) for line, under in zip(out, tags, strict=True)]
