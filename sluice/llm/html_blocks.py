"""Leaf blocks of a page: stretches of text between the borders of block elements, with the elements they are in.

Any text is a page: tags without an end are text, elements that are left open end with the page. Time and memory are in proportion to a page's length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

#: Elements that don't end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of a page's text.
_SILENT = frozenset("head script style template noscript svg math iframe object select textarea canvas audio video".split())
#: Elements that close an open one of the same kind: lists' items, paragraphs, rows.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: What may stand in a head: the first other element or text ends it, as both of its tags can be left out.
_IN_HEAD = frozenset("html head title meta link style script base template noscript".split())
_KEEPS_OPEN = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
#: Elements whose content is no markup, up to their end.
_RAW = frozenset("script style textarea title iframe noscript".split())
_NAME = re.compile(r"<(/?)([a-z][^\s/>]*)", re.IGNORECASE)
#: The rest of a tag, as it usually is.
_REST = re.compile(r"(?:[^<>\"']|\"[^<\"]*\"|'[^<']*')*+>")
#: As browsers do, elements within so many open ones are taken as a part of the last.
DEEPEST = 512
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str  # white space as one space, trimmed
    path: tuple[str, ...]  # elements from the root, each with its class and id words: "div.side.box"
    link_chars: int
    article: int = 0  # the number on the page of the innermost <article> it is in, from 1


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> str:
    words = [w.lower() for m in _NAMES.finditer(attributes) for w in _TOKEN.findall(m[1] or m[2] or m[3] or "")]
    return ".".join([tag, *dict.fromkeys(words)])


@dataclass(slots=True)
class _Markup:
    start: int
    end: int
    tag: str = ""  # "" for comments, declarations and elements whose content is no markup
    closing: bool = False
    attributes: str = ""


class _Tags:
    """Where tags end: at the first `>` that is in no quotes, or at the first one of all if a quote has no end.

    Where a scan outside of quotes ends depends on its place alone, so places that were passed are kept, and a page takes time in
    proportion to its length whatever is in it.
    """

    def __init__(self, html: str) -> None:
        self.html, self._ends = html, {}
        self._at: dict[str, list[int]] | None = None

    def end(self, at: int) -> int:
        """After the `>` of the tag whose name ends at `at`; -1 if no `>` follows."""
        usual = _REST.match(self.html, at)
        if usual:
            return usual.end()
        passed, place = [], at
        while place not in self._ends:
            passed.append(place)
            found = self._next(">\"'", place)
            if found < 0 or self.html[found] == ">":
                self._ends[place] = found
                break
            close = self._next(self.html[found], found + 1)
            if close < 0:
                self._ends[place] = -1
                break
            place = close + 1
        for p in passed:
            self._ends[p] = self._ends[place]
        end = self._ends[at] if self._ends[at] >= 0 else self._next(">", at)
        return end + 1 if end >= 0 else -1

    def _next(self, signs: str, at: int) -> int:
        if self._at is None:
            self._at = {s: [m.start() for m in re.finditer(f"[{s}]", self.html)] for s in (">", '"', "'", ">\"'")}
        places = self._at[signs]
        k = bisect_left(places, at)
        return places[k] if k < len(places) else -1


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.IGNORECASE)


def _markups(html: str) -> Iterator[_Markup]:
    """Tags, comments and the like in the page's order. What looks like a tag but has no end is text."""
    tags, at, last = _Tags(html), 0, html.rfind(">")
    while True:
        at = html.find("<", at)
        if at < 0:
            return
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield _Markup(at, end)
        elif at > last:  # only a comment needs no `>`
            at = html.find("<!--", at)
            if at < 0:
                return
            continue
        elif html.startswith(("<!", "<?"), at):
            end = html.find(">", at) + 1
            yield _Markup(at, end)
        elif name := _NAME.match(html, at):
            tag, closing = name[2].lower(), bool(name[1])
            if tag in _RAW and not closing:
                begin = html.find(">", at) + 1
                close = _end_of(tag).search(html, begin)
                end = close.end() if close else len(html)
                yield _Markup(at, end)
            else:
                end = tags.end(name.end())
                if end < 0:
                    return
                yield _Markup(at, end, tag, closing, html[name.end() : end - 1])
        else:
            end = at + 1
        at = end


def _ends_head(text: str, markup: _Markup) -> bool:
    return bool(text.strip()) or bool(markup.tag) and not markup.closing and markup.tag not in _IN_HEAD


def blocks(html: str | None) -> list[Block]:
    """All blocks with text in the page's order."""
    found: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # tag, element, number of the article; block elements only
    parts: list[str] = []
    links = silent = link_chars = at = articles = 0
    open_tags, deeper = Counter(), Counter()  # how many are in the stack, and within its last element

    def end_block() -> None:
        nonlocal parts, link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, tuple(e for _, e, _ in stack), min(link_chars, len(text)), stack[-1][2] if stack else 0))
        parts, link_chars = [], 0

    def close(k: int) -> None:
        """The last open elements, from the k-th on."""
        nonlocal silent
        for tag, _, _ in stack[k:]:
            open_tags[tag] -= 1
            silent -= tag in _SILENT
        del stack[k:]

    html = html or ""
    for m in _markups(html):
        if stack and stack[-1][0] == "head" and _ends_head(html[at : m.start], m):
            close(-1)
        if m.start > at and not silent:
            text = unescape(html[at : m.start])
            parts.append(text)
            if links:
                link_chars += len(text)
        at = m.end
        tag, closing = m.tag, m.closing
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        end_block()
        if tag in _VOID:
            continue
        if closing:
            if deeper[tag]:
                deeper[tag] -= 1
            elif open_tags[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
                deeper.clear()
            continue
        if tag == "body":
            while stack and stack[-1][0] == "head":
                close(-1)
        if stack and stack[-1][0] == "p":  # a block element ends an open paragraph
            close(-1)
        for k in range(len(stack) - 1, -1, -1) if tag in _CLOSES else ():
            if stack[k][0] in _KEEPS_OPEN.get(tag, ()):
                break
            if stack[k][0] in _CLOSES[tag]:
                close(k)
                deeper.clear()
                break
        if not m.attributes.endswith("/") or tag not in ("svg", "math"):
            if len(stack) >= DEEPEST:
                deeper[tag] += 1
                continue
            articles += tag == "article"
            article = articles if tag == "article" else stack[-1][2] if stack else 0
            stack.append((tag, _element(tag, m.attributes) if m.attributes else tag, article))
            open_tags[tag] += 1
            silent += tag in _SILENT
        links = 0
    if stack and stack[-1][0] == "head" and html[at:].strip():
        close(-1)
    if at < len(html) and not silent:
        parts.append(unescape(html[at:]))
    end_block()
    return found
