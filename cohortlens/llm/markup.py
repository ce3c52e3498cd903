"""A small reader of HTML as it occurs: a tree of elements and their text.

It follows the parts of the HTML rules that text extraction needs: void
elements, elements whose content is raw, elements that close an open one of
their kind, end tags without a beginning, and pages that end anywhere."""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp template".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split())
_CLOSES_P = BLOCK - frozenset("body html caption legend option optgroup td th tr tbody thead tfoot dd dt li summary".split())
# What an opening tag ends, if it is open and nearer than the limit.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
_STOPS = frozenset("table td th caption button".split())


class Element:
    __slots__ = ("children", "hidden", "mark", "names", "parent", "tag", "words")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.names, self.words, self.hidden = (), "", False
        if attributes:
            words = []
            for name, value in _NAMES.findall(attributes):
                name, value = name.lower(), html.unescape(value.strip("\"'")).strip().lower()
                if name == "class":
                    self.names = tuple(value.split())
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    self.hidden = True
                elif name in ("class", "id", "role"):
                    words.append(value)
            self.words = " ".join(words)
        #: crc32 of the path, continued from the parent's: a path is written out only where it is wanted
        self.mark = 0 if parent is None else zlib.crc32((step(self) if parent.parent is None else ">" + step(self)).encode(), parent.mark)


class _Open:
    """The open elements, and where those of each tag stand among them."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Element) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all in it."""
        for node in self.stack[place:]:
            self.places[node.tag].pop()
        del self.stack[place:]

    def last(self, tags) -> int:
        """Where the innermost of the tags stands; 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def outermost(self, tags, after: int) -> int:
        """Where the outermost of the tags after a place stands; 0 without any."""
        found = [p[k] for t in tags if (p := self.places[t]) and (k := bisect_right(p, after)) < len(p)]
        return min(found, default=0)


def parse(page: str) -> Element:
    """The root, with the elements and texts (as decoded strings) below it."""
    root = Element("#page", None)
    opened = _Open(root)
    at, n = 0, len(page)
    while at < n:
        here = opened.stack[-1]
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else n]
        if text:
            if not m and "<" in text and re.match(r"</?[a-zA-Z]", text[text.rfind("<"):]):
                text = text[:text.rfind("<")]  # the page ends within a tag
            here.children.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<![CDATA["):
                here.children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if place := opened.last((tag,)):
                opened.cut(place)
            continue
        if tag in _CLOSES_P:
            if (place := opened.last(("p",))) > opened.last(_STOPS):
                opened.cut(place)
        elif tag in _ENDS:
            ended, limit = _ENDS[tag]
            if place := opened.outermost(ended, opened.last(limit)):
                opened.cut(place)
        if tag in ("html", "body") and opened.places[tag]:
            continue
        here = opened.stack[-1]
        element = Element(tag, here, m[3] or m[6] or "")
        here.children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            opened.push(element)
    return root


def ancestors(node: Element) -> Iterator[Element]:
    """The node and what it stands in, without the root."""
    while node.parent is not None:
        yield node
        node = node.parent


_DIGITS = re.compile(r"\d+")


def step(node: Element) -> str:
    """Tag and classes; numbers are generalised."""
    return ".".join([node.tag, *sorted({_DIGITS.sub("0", c) for c in node.names})])


def path(node: Element) -> str:
    """The steps from the page down to the node."""
    return ">".join(reversed([step(a) for a in ancestors(node)]))


def path_mark(written: str) -> int:
    """The mark of the elements at a path (and, rarely, of some others)."""
    return zlib.crc32(written.encode())
