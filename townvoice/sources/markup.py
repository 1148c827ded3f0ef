"""Small helper for tasks: an element tree from the standard library's HTML parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = ("script", "style")


class Element:
    """A node knows what is inside it, not what it is in: without cycles a tree is freed with its page."""

    __slots__ = ("tag", "attrs", "classes", "children", "elements", "leading")

    def __init__(self, tag: str, attrs: dict[str, str], leading: bool = True):
        self.tag = tag
        self.attrs = attrs
        self.classes = attrs["class"].split() if "class" in attrs else ()
        self.children = []
        self.elements = []
        self.leading = leading

    def add(self, tag: str, attrs: dict[str, str]) -> Element:
        element = Element(tag, attrs, not self.elements)
        self.children.append(element)
        self.elements.append(element)
        return element

    def strings(self) -> Iterator[str]:
        pending = self.children[::-1]
        while pending:
            item = pending.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in NOT_TEXT:
                pending += item.children[::-1]

    def text(self, separator: str | None = None) -> str:
        """All text inside; with a separator, its stripped non-empty pieces."""
        pieces = self.strings() if self.elements else self.children
        if separator is None:
            return "".join(pieces)
        return separator.join(piece for piece in map(str.strip, pieces) if piece)

    def first_child(self) -> bool:
        return self.leading

    def find(self, step: str, *inner: str) -> Iterator[Element]:
        """Descendants matching the path; a step is ``tag``, ``tag.class.class`` or ``tag#id``."""
        tag, classes, name = read_step(step)
        seen = set()
        pending = self.elements[::-1]
        while pending:
            element = pending.pop()
            if element.elements:
                pending += element.elements[::-1]
            if element.tag != tag or (name and element.attrs.get("id") != name):
                continue
            if classes and not classes.issubset(element.classes):
                continue
            if not inner:
                yield element
                continue
            for found in element.find(*inner):
                if id(found) not in seen:
                    seen.add(id(found))
                    yield found

    def first(self, *path: str) -> Element | None:
        return next(self.find(*path), None)


STEPS: dict[str, tuple[str, frozenset[str], str]] = {}


def read_step(step: str) -> tuple[str, frozenset[str], str]:
    if step not in STEPS:
        rest, _, name = step.partition("#")
        tag, *classes = rest.split(".")
        STEPS[step] = tag, frozenset(classes), name
    return STEPS[step]


# Tags as nearly all are written; any other form is left to the library.
START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_:-]*="[^"]*")*)>')
# Text and the tag after it, a start or an end.
NEXT = re.compile(r'([^<]*)<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_:-]*="[^"]*")*))>')
END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z0-9_:-]*)="([^"]*)"')
OTHER_REFERENCE = re.compile("&(?!(?:amp|lt|gt|quot);)")
# What is inside these is not read as markup, in some versions of the library.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())


def read_attributes(inside: str) -> dict[str, str]:
    if not inside:
        return {}
    found = ATTRIBUTE.findall(inside)
    if "&" in inside:
        return {name.lower(): unescape(value) for name, value in found}
    return {name.lower(): value for name, value in found}


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]

    def parse_starttag(self, i):
        simple = START.match(self.rawdata, i)
        if simple is None:
            return super().parse_starttag(i)
        tag, inside = simple.groups()
        tag = tag.lower()
        if tag in RAW or ("&" in inside and OTHER_REFERENCE.search(inside)):
            return super().parse_starttag(i)
        self.start(tag, read_attributes(inside))
        return self.parse_plain(simple.end())

    def parse_endtag(self, i):
        simple = END.match(self.rawdata, i)
        if simple is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(simple[1].lower())
        return self.parse_plain(simple.end())

    def parse_plain(self, i):
        """Read on while all is text and plain tags; where it ends, the library goes on."""
        rawdata, path = self.rawdata, self.open
        while True:
            plain = NEXT.match(rawdata, i)
            if plain is None:
                return i
            text, end, tag, inside = plain.groups()
            if end is None:
                tag = tag.lower()
                if tag in RAW or ("&" in inside and OTHER_REFERENCE.search(inside)):
                    return i
            top = path[-1]
            if text:
                top.children.append(unescape(text) if "&" in text else text)
            if end is None:
                self.start(tag, read_attributes(inside))
            elif top.tag == end and len(path) > 1:
                path.pop()
            else:
                self.handle_endtag(end.lower())
            i = plain.end()

    def updatepos(self, i, j):  # lines are not counted
        return j

    def start(self, tag, attrs):
        element = self.open[-1].add(tag, attrs)
        if tag not in VOID:
            self.open.append(element)

    def handle_starttag(self, tag, attrs):
        self.start(tag, {name: value or "" for name, value in attrs})

    def handle_startendtag(self, tag, attrs):
        self.open[-1].add(tag, {name: value or "" for name, value in attrs})

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):  # an end tag without a start is ignored
            if self.open[depth].tag == tag:
                del self.open[depth:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def text_of(element: Element | None, separator: str | None = None) -> str | None:
    return None if element is None else element.text(separator)


def attr_of(element: Element | None, name: str) -> str | None:
    return None if element is None else element.attrs.get(name)
