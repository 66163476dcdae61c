"""HTML as a flat list of elements, tolerant of missing and stray tags."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_NEXT = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",),
    "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
}
NAME = r"<(/?)([a-zA-Z][^\s/>]*+)"
# A comment, a tag, another kind of markup, or the sign of a tag whose end is not found.
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|{NAME}((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[!?/][^>]*>|<(?=[a-zA-Z])", re.S
)
# The same without the ends of tags.
SIGN = re.compile(rf"<!--.*?(?:-->|\Z)|{NAME}|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Tree:
    """Element i has a tag, raw attributes and a parent before it (-1: none). ``events`` are
    in page order: (element, text), or (element, None) where a block begins or ends."""

    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    events: list[tuple[int, str | None]] = field(default_factory=list)

    def named(self, i: int) -> dict[str, str]:
        found = ATTRIBUTE.findall(self.attributes[i])
        return {name.lower(): a or b or c for name, a, b, c in found}

    def hashes(self) -> list[bytes]:
        """A hash per element, of its tag, texts and the hashes of the elements inside it."""
        parts: list[list[bytes]] = [[] for _ in self.tags]
        inside: list[list[int]] = [[] for _ in self.tags]
        for i, text in self.events:
            if text and (said := " ".join(text.split())):
                parts[i].append(said.encode("utf-8", "replace"))
        for i, parent in enumerate(self.parents):
            if parent >= 0:
                inside[parent].append(i)
        out = [b""] * len(self.tags)
        for i in range(len(self.tags) - 1, -1, -1):
            whole = b"\0".join([self.tags[i].encode(), *parts[i], *(out[c] for c in inside[i])])
            out[i] = blake2b(whole, digest_size=8).digest()
        return out


class Markup:
    """The tags of a page, one after another. One pattern reads them as long as it finds their
    ends; the first tag that has none makes a table of the ends for the rest of the page, from
    the back, so that a page of unclosed tags or quotes is not scanned again for each of them."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">") + 1  # behind it there are only comments
        self.at: list[int] | None = None

    def _table(self, start: int) -> None:
        marks = [(m.start(), m[0]) for m in re.compile("[\"'>]").finditer(self.page, start)]
        self.at = [at for at, _ in marks]
        self.end = [-1] * (len(marks) + 1)
        following = {}
        for i in range(len(marks) - 1, -1, -1):
            at, mark = marks[i]
            if mark == ">":
                self.end[i] = at
            elif mark in following:  # the quote is closed there
                self.end[i] = self.end[following[mark] + 1]
            if mark != ">":
                following[mark] = i

    def next(self, at: int) -> tuple[int, int, str | None, str | None, str | None] | None:
        """Start and end of the next markup; slash, name and attributes of a tag."""
        while self.at is None:
            found = MARKUP.search(self.page, at, self.last)
            if not found:
                return self._comment(at)
            if found.end() > found.start() + 1:
                return self._whole(found) if found[2] is None else (*found.span(), *found.groups())
            self._table(found.start())
            at = found.start()
        while found := SIGN.search(self.page, at, self.last):
            if found[2] is None:
                return self._whole(found)
            end = self.end[bisect_left(self.at, found.end())]
            if end >= 0:
                return found.start(), end + 1, found[1], found[2], self.page[found.end() : end]
            if found[1]:
                return found.start(), self.page.index(">", found.end()) + 1, None, None, None
            at = found.start() + 1  # the sign itself
        return self._comment(at)

    def _whole(self, found: re.Match) -> tuple[int, int, None, None, None]:
        """A comment that is not closed before the last sign may be closed nowhere."""
        start, end = found.span()
        if end == self.last and found[0].startswith("<!--") and not found[0][4:].endswith("-->"):
            end = len(self.page)
        return start, end, None, None, None

    def _comment(self, at: int) -> tuple[int, int, None, None, None] | None:
        start = self.page.find("<!--", max(at, self.last))
        return None if start < 0 else (start, len(self.page), None, None, None)


class Open:
    """Open elements from the page inwards, and where each tag is among them."""

    def __init__(self, tree: Tree):
        self.tree, self.elements = tree, []
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, i: int) -> None:
        tag, depth = self.tree.tags[i], len(self.elements)
        self.elements.append(i)
        self.depths.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)

    def last(self, tag: str) -> int:
        """Depth of the innermost open element with this tag; 0 if none."""
        depths = self.depths.get(tag)
        return depths[-1] if depths else 0

    def close_to(self, depth: int) -> None:
        while len(self.elements) > depth:
            i = self.elements.pop()
            tag = self.tree.tags[i]
            self.depths[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
                self.tree.events.append((i, None))


def parse(page: str) -> Tree:
    """Text is decoded; scripts, styles and the like keep theirs out of the tree. The time is in
    proportion to the page, however broken it is."""
    tree = Tree()
    tags, events = tree.tags, tree.events
    open_, markup, at, end = Open(tree), Markup(page), 0, len(page)

    def begin(tag: str, attributes: str) -> int:
        tags.append(tag)
        tree.attributes.append(attributes)
        tree.parents.append(open_.elements[-1] if open_.elements else -1)
        return len(tags) - 1

    def say(start: int, stop: int) -> None:
        if start < stop:
            text = page[start:stop]
            events.append((open_.elements[-1], unescape(text) if "&" in text else text))

    open_.push(begin("#page", ""))
    while found := markup.next(at):
        start, stop, closes, name, attributes = found
        say(at, start)
        at = stop
        if name is None:
            continue
        tag = name.lower()
        if closes:
            if depth := open_.last(tag):
                open_.close_to(depth)
            continue
        if tag == "br":
            events.append((open_.elements[-1], " "))
        if tag not in INLINE and tag not in VOID:
            depth = open_.last("p")  # a block ends an open paragraph
            if depth and depth == open_.blocks[-1]:
                open_.close_to(depth)
        if tag in CLOSED_BY_NEXT:
            alike = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            depth = max(map(open_.last, alike))
            if depth > max(map(open_.last, CLOSED_BY_NEXT[tag])):
                open_.close_to(depth)
        i = begin(tag, attributes)
        if tag not in INLINE and tag != "br":
            events.append((i, None))
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = closing.end() if closing else end
        elif tag not in VOID and not (tag in ("svg", "path") and attributes.endswith("/")):
            open_.push(i)
    say(at, end)
    open_.close_to(0)
    return tree
