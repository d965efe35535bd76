"""Leaf blocks of a page's element tree: their text and the elements around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

# Fixed values of the HTML standard: elements without content, elements that start a new block, elements whose
# content is no text of the page, and start tags that close an open element of the same group.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img".split()
)
UNSEEN = set("script style template noscript iframe object svg head title canvas audio video".split())
RAW = set("script style title textarea noscript iframe".split())
CLOSERS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul".split()
)
# An open element of these is not closed by a tag outside of it.
WALLS = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}

# Elements that may stand in a head; the first other one, or text, ends a head whose end tag was left out.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
# Start tags that end an open svg or math element, as they do in the standard.
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr"
    " ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN = {"svg", "math"}

# A tag's name up to its attributes, a comment, or another declaration.
OPENING = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?])")
# What ends a tag or holds a value in quotes: quotes count after an equals sign alone, elsewhere they belong to a name.
INSIDE = re.compile(r">|=\s*(?:\"[^\"]*(\"?)|'[^']*('?))")
NAMES = re.compile(r"(?<![^\s/\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # of the elements around it, the outermost first
    names: tuple[str, ...]  # words of their classes, ids and roles
    linked: int  # characters inside links


@dataclass(frozen=True)
class Element:
    """An open element, with the one around it."""

    name: str
    words: tuple[str, ...]
    outer: Element | None
    depth: int
    hidden: bool
    linked: bool


# Elements around a block of which tags and names are told: the innermost of them.
INNER = 48


def _around(element: Element | None) -> list[Element]:
    chain = []
    while element is not None and len(chain) < INNER:
        chain.append(element)
        element = element.outer
    return chain[::-1]


def _tag_end(page: str, at: int) -> tuple[int, int]:
    """Where the attributes of a tag end and where the page goes on; a value whose quote is never closed is passed over
    by the next ``>``, and a tag that never ends takes the rest."""
    place = at
    while match := INSIDE.search(page, place):
        if match[0] == ">":
            return match.start(), match.end()
        if not (match[1] or match[2]):
            end = page.find(">", match.start())
            return (end, end + 1) if end >= 0 else (len(page), len(page))
        place = match.end()
    return len(page), len(page)


def blocks(page: str | None) -> list[Block]:
    """Blocks with visible text, in page order; white space inside is one space, character references are decoded.

    Unclosed and misplaced tags are taken as browsers do for heads, paragraphs, list items, cells and drawings inside
    text; an end tag without its start is passed over. What is neither tag nor comment is text. Time grows with the
    page's length, whatever is left open in it. A formula (``math``) is text of the page, a drawing (``svg``) is not.
    """
    page = page or ""
    out: list[Block] = []
    top: Element | None = None
    open_names: dict[str, int] = {}
    held: list[str] = []
    linked = 0
    place: Element | None = None

    def close() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                chain = _around(place)
                names = tuple(word for e in chain for word in e.words)
                out.append(Block(text, tuple(e.name for e in chain), names, linked))
            held.clear()
        linked = 0

    def push(name: str, words: tuple[str, ...]) -> None:
        nonlocal top
        hidden = name in UNSEEN or (top is not None and top.hidden)
        link = name == "a" or (top is not None and top.linked)
        top = Element(name, words, top, (top.depth if top else 0) + 1, hidden, link)
        open_names[name] = open_names.get(name, 0) + 1

    def pop(to: Element) -> None:
        """Close an element and all inside of it."""
        nonlocal top
        while top is not None:
            name, last = top.name, top is to
            open_names[name] -= 1
            top = top.outer
            if last:
                return

    def nearest(names: set[str]) -> Element | None:
        if not any(open_names.get(n) for n in names):
            return None
        element = top
        while element is not None and element.name not in names:
            element = element.outer
        return element

    def leave_head() -> None:
        head = nearest({"head"})
        if head is not None:
            close()
            pop(head)

    def add(text: str) -> None:
        nonlocal linked, place
        if not text:
            return
        if top is not None and top.name == "head" and not text.isspace():
            leave_head()
        if top is not None and top.hidden:
            return
        if not held:
            if text.isspace():
                return
            place = top
        held.append(text)
        if top is not None and top.linked:
            linked += len(text)

    at = 0
    while match := OPENING.search(page, at):
        add(page[at : match.start()])
        if match[3]:
            end = page.find("-->", match.end())
            at = end + 3 if end >= 0 else len(page)
            continue
        if not match[2]:
            end = page.find(">", match.end())
            at = end + 1 if end >= 0 else len(page)
            continue
        stop, at = _tag_end(page, match.end())
        name = match[2].lower()
        if match[1]:
            if name not in INLINE:
                close()
            elif name == "br":
                add(" ")
            found = nearest({name})
            if found is not None:
                element = top
                while element is not None and element.name in INLINE and element is not found:
                    element = element.outer
                if element is not found or found.name not in INLINE:
                    close()
                pop(found)
            continue
        if name not in IN_HEAD and name not in ("html", "head"):
            leave_head()
        if name in ENDS_FOREIGN and any(open_names.get(n) for n in FOREIGN):
            pop(nearest(FOREIGN))
        if name not in INLINE:
            close()
            group = {"p"} if name in CLOSES_P else CLOSERS.get(name)
            if group and any(open_names.get(n) for n in group):
                element = top
                while element is not None:
                    if element.name in group:
                        pop(element)
                        break
                    if element.name in WALLS.get(name, ()) or (name in CLOSES_P and element.name not in INLINE):
                        break
                    element = element.outer
        elif name in ("br", "wbr", "img"):
            add(" " if name == "br" else "")
        if name in VOID:  # a closing slash in other start tags has no meaning
            continue
        words = tuple(
            x
            for m in NAMES.finditer(page, match.end(), stop)
            for x in PARTS.findall((m[1] or m[2] or m[3] or "").lower())
        )
        push(name, words)
        if name in RAW:
            end = _raw_end(name).search(page, at)
            stop = end.start() if end else len(page)
            add(page[at:stop])
            at = stop
    add(page[at:])
    close()
    return out


@lru_cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])", re.I)
