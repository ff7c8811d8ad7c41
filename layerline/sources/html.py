"""Tag soup -> adjacency rows: one row per element, the only Python step of page parsing.

The tree builder supplies what browsers imply: void elements, the end of ``p`` before block tags, the ends
of ``li``, ``tr``, ``td`` and the like before their siblings. Script, style and comments have no text; entities
are decoded. Everything after it (sections, records, lists, tables) is expressions over these rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Element names of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "template"}
#: Elements that enclose a page or most of it: their rows carry no text, or each page would be stored once more for each.
WHOLE = {"html", "body", "main"}
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: An opening tag ends these open elements, unless one of the second set lies between.
ENDS = {
    "li": ({"li"}, {"ol", "ul"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}), "thead": ({"caption"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}),
}

NODES = (
    "pos int, parent int, depth int, tag string, attr_id string, href string, ancestors array<int>, outline array<int>, text string, own string, strong string, rest string"
)
_COLUMNS = [c.split(" ")[0] for c in NODES.split(", ")]
#: Elements in one Arrow batch, or a page's if it has more.
BATCH = 4096
_TYPES = {"int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


class Element:
    __slots__ = ("attrs", "children", "parent", "pos", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Element | None):
        self.tag, self.attrs, self.parent, self.children, self.pos = tag, attrs, parent, [], -1

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", {}, None)

    def _close(self, tags: set[str], until: set[str]) -> None:
        e = self.here
        last = None
        while e is not self.root and e.tag not in until:
            if e.tag in tags:
                last = e
            e = e.parent
        if last is not None:
            self.here = last.parent

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close({"p"}, {"table", "td", "th", "li", "div", "section", "article", "main", "body", "blockquote"})
        if tag in ENDS:
            self._close(*ENDS[tag])
        e = Element(tag, dict(attrs), self.here)
        self.here.children.append(e)
        if tag not in VOID:
            self.here = e

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.here.tag == tag and tag not in VOID and tag in ("svg", "path"):
            self.here = self.here.parent

    def handle_endtag(self, tag):
        e = self.here
        while e is not self.root and e.tag != tag:
            if tag not in ("table", "body", "html", "main", "article", "div", "section", "ol", "ul") and e.tag in ("td", "th", "li", "table", "div", "main"):
                return  # a stray end tag does not close what encloses it
            e = e.parent
        if e is not self.root:
            self.here = e.parent

    def handle_data(self, data):
        if self.here.tag not in SILENT:
            self.here.children.append(data)


def parse(page: str) -> Element:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def strings(e: Element, skip: set[str] = frozenset()) -> Iterator[str]:
    stack = [iter(e.children)]
    while stack:
        for c in stack[-1]:
            if isinstance(c, str):
                yield c
            elif c.tag not in skip and c.tag not in SILENT:
                stack.append(iter(c.children))
                break
        else:
            stack.pop()


def joined(parts: Iterator[str]) -> str:
    """Strings with one space between them, white space collapsed."""
    return " ".join(" ".join(parts).split())


def element_rows(page: str) -> list[tuple]:
    """A row of NODES for every element, in document order."""
    root = parse(page)
    out: list[tuple] = []
    stack: list[tuple[Element, list[int], list[int] | None]] = [(c, [], None) for c in reversed(root.elements())]
    while stack:
        e, ancestors, outline = stack.pop()
        e.pos = len(out)
        kids = e.elements()
        lead = next((c for c in kids if c.tag == "strong"), None)
        text = None if e.tag in WHOLE else joined(strings(e))
        own = None if e.tag in WHOLE else joined(s for c in e.children for s in ([c] if isinstance(c, str) else () if c.tag in ("ol", "ul") else strings(c)))
        strong = rest = None
        if lead is not None and text is not None:
            strong = joined(strings(lead))
            rest = text[len(strong) :].strip() if text.startswith(strong) else text
        out.append((e.pos, ancestors[-1] if ancestors else -1, len(ancestors), e.tag, e.attrs.get("id"), e.attrs.get("href"), ancestors, outline if e.tag == "li" else None, text, own, strong, rest))
        below = [*ancestors, e.pos]
        items = 0
        pushed = []
        for c in kids:
            if c.tag == "li" and e.tag in ("ol", "ul"):
                pushed.append((c, below, [*(outline or []), items]))
                items += 1
            else:
                # A list right under an item goes on with the item's outline; any other starts afresh.
                pushed.append((c, below, outline if e.tag == "li" and c.tag in ("ol", "ul") else None))
        stack.extend(reversed(pushed))
    return out


def page_nodes(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """The element rows of every page, with the page's keys. A null page has none; a broken one what can be read."""
    schema = StructType([*pages.select(*keys).schema.fields, *StructType.fromDDL(NODES).fields])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(of: list[int], found: list[tuple]) -> pa.RecordBatch:
            values = [pa.array(column, _TYPES[c.split(" ")[1]]) for column, c in zip(zip(*found, strict=True), NODES.split(", "), strict=True)]
            return pa.RecordBatch.from_arrays([*[b.column(k).take(pa.array(of)) for k in range(len(keys))], *values], names=[*keys, *_COLUMNS])

        for b in batches:
            of, found = [], []
            for i, page in enumerate(b.column(b.num_columns - 1).to_pylist()):
                if page is None:
                    continue
                more = element_rows(page.decode("utf-8", "replace") if isinstance(page, bytes) else page)
                if found and len(found) + len(more) > BATCH:
                    yield batch(of, found)
                    of, found = [], []
                of += [i] * len(more)
                found += more
            if found:
                yield batch(of, found)

    return pages.select(*keys, html).mapInArrow(rows, schema)


def slug(href: str) -> str:
    return re.sub(r"[?#].*$", "", href).rstrip("/").rsplit("/", 1)[-1]
