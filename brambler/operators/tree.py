"""A page as a tree of elements. Only this and what reads a tree's nodes is Python; rules on people are columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

#: Elements without content, and elements whose content is no text of the page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "noscript", "iframe"}
#: Elements that tell of no people.
FRAME = {"nav", "header", "footer"}
#: What an element that opens ends, looking outwards, and where it stops looking.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "table"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Elements that end an open paragraph.
BLOCKS = {"p", "div", "section", "article", "aside", "main", "header", "footer", "nav", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "form", "hr", "pre", "blockquote", "address", "figure", "fieldset"}


class Element:
    """A tag with its attributes, parent and items (texts and elements in page order)."""

    __slots__ = ("attrs", "items", "parent", "place", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[str | Element] = []
        self.place = -1  # among the parent's items
        if parent is not None:
            self.place = len(parent.items)
            parent.items.append(self)

    def walk(self, leave: frozenset[str] | set[str] = frozenset()) -> Iterator[Element]:
        """Elements below, in page order, without those of some tags and what is in them."""
        for x in self.nodes(leave):
            if isinstance(x, Element):
                yield x

    def nodes(self, leave: frozenset[str] | set[str] = frozenset()) -> Iterator[str | Element]:
        todo = [iter(self.items)]  # no recursion: pages may nest deeply
        while todo:
            x = next(todo[-1], None)
            if x is None:
                todo.pop()
            elif isinstance(x, str):
                yield x
            elif x.tag not in leave:
                yield x
                todo.append(iter(x.items))

    def text(self, between: str = "", strip: bool = False, leave: frozenset[str] | set[str] = frozenset(SILENT)) -> str:
        """Texts below, joined; with strip each without blanks around it, and none that is blank."""
        found = [x for x in self.nodes(leave) if isinstance(x, str)]
        return between.join(filter(None, map(str.strip, found))) if strip else between.join(found)

    def following(self, tags: set[str], n: int, leave: set[str] = frozenset()) -> list[Element]:
        """The next n elements of some tags beside this one, behind it."""
        out: list[Element] = []
        beside = self.parent.items if self.parent else []
        for k in range(self.place + 1, len(beside)):
            x = beside[k]
            if isinstance(x, Element) and x.tag in tags and x.tag not in leave:
                out.append(x)
                if len(out) == n:
                    break
        return out


#: Tags in the plain form that nearly all have: a name, attributes in quotes. And elements in whose content tags are text.
PLAIN = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][a-zA-Z0-9_:.-]*=(?:"[^"<>]*"|'[^'<>]*'))*)[ \t\r\n]*/?>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_:.-]*)=(?:"([^"]*)"|'([^']*)')""")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def _end(self, tags: set[str], stop: set[str]) -> None:
        """Ends the outermost open element of some tags, and all in it, on the way out to an element that stops this."""
        found, x = None, self.at
        while x is not self.root and x.tag not in stop:
            if x.tag in tags:
                found = x
            x = x.parent
        if found is not None:
            self.at = found.parent

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end({"p"}, {"td", "th", "table", "button"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        own = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        if tag not in VOID:
            self.at = own

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # <div/> opens: only void elements have no content

    def handle_endtag(self, tag):
        stop = {"table"} if tag in ("td", "th", "tr", "thead", "tbody", "tfoot") else set() if tag == "table" else {"td", "th", "table"}
        x = self.at
        while x is not self.root and x.tag != tag:
            if x.tag in stop:
                return  # nothing in a cell ends what stands around its table
            x = x.parent
        if x is not self.root:
            self.at = x.parent

    def handle_data(self, data):
        self.at.items.append(data)


def _plain(html: str) -> Element | None:
    """The tree of a page all of whose tags are plain, as the parser gives it in several times the time; None for other pages."""
    parts = PLAIN.split(html)
    if any("<" in text for text in parts[::4]) or not RAW.isdisjoint(map(str.lower, parts[2::4])):
        return None
    builder = _Builder()
    for k, text in enumerate(parts[::4]):
        if k:
            shut, tag, attrs = parts[4 * k - 3 : 4 * k]
            if not shut:
                builder.handle_starttag(tag.lower(), [(n.lower(), unescape(v or w)) for n, v, w in ATTRIBUTE.findall(attrs)] if attrs else ())
            elif attrs:
                return None
            else:
                builder.handle_endtag(tag.lower())
        if text:
            builder.handle_data(unescape(text))
    return builder.root


def tree(html: str | None) -> Element:
    """The root of a page's tree; tags are repaired as they come, null is an empty page."""
    found = _plain(html or "")
    if found is not None:
        return found
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
