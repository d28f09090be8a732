"""A small element tree for HTML, enough to find elements by tag, class and id."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from furlong.sources.html import VOID

#: Elements that a following one of the same kind, or of a kind that holds them, ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
#: Elements inside which those above are at home, so that nothing beyond them is ended.
HOMES = {"table", "ul", "ol", "dl", "select", "div", "body", "html"}


class Element:
    def __init__(self, tag: str, attributes: dict[str, str | None], parent: Element | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return (self.attributes.get("class") or "").split()

    def get(self, name: str) -> str | None:
        return self.attributes.get(name)

    def walk(self) -> Iterator[Element]:
        for child in self.children:
            if isinstance(child, Element):
                yield child
                yield from child.walk()

    def all(self, tag: str | None = None, cls: str | None = None, id: str | None = None) -> list[Element]:
        return [e for e in self.walk() if (tag is None or e.tag == tag) and (cls is None or cls in e.classes) and (id is None or e.get("id") == id)]

    def first(self, tag: str | None = None, cls: str | None = None, id: str | None = None) -> Element | None:
        return next(iter(self.all(tag, cls, id)), None)

    def own(self, tag: str) -> list[Element]:
        """Children of this kind."""
        return [c for c in self.children if isinstance(c, Element) and c.tag == tag]

    def pieces(self, drop: tuple[str, ...] = ()) -> Iterator[str]:
        """Texts in order; a break is a new line; elements of a class in ``drop`` are left out."""
        for child in self.children:
            if isinstance(child, str):
                yield child
            elif child.tag == "br":
                yield "\n"
            elif child.tag not in ("script", "style") and not set(drop) & set(child.classes):
                yield from child.pieces(drop)

    def text(self, drop: tuple[str, ...] = ()) -> str:
        """Texts joined by spaces, white space collapsed."""
        return " ".join(" ".join(self.pieces(drop)).split())

    def tight(self, drop: tuple[str, ...] = ()) -> str:
        """Texts as they stand, white space collapsed."""
        return " ".join("".join(self.pieces(drop)).split())

    def lines(self) -> list[str]:
        return [x for line in "".join(self.pieces()).split("\n") if (x := " ".join(line.split()))]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        for_end, node = ENDS.get(tag, set()), self.at
        while for_end and node.parent is not None and node.tag not in HOMES:
            if node.tag in for_end:
                self.at = node.parent
            node = node.parent
        element = Element(tag, dict(attrs), self.at)
        self.at.children.append(element)
        if tag not in VOID:
            self.at = element

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str) -> Element:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root
