"""HTML papers: title, abstract and blocks in document order, from a small tree built by the standard library's parser.

Elements that HTML lets stand open (p, li, table rows and cells) end where the standard says so; end tags without
a start are ignored. Null, empty and plain text give no title, no abstract and no blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Which open elements a start tag ends, up to the nearest of the second set.
_ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
#: What is no content, by tag and by class; classes of notes in a title; classes of displayed equations.
NO_CONTENT = {"script", "style", "noscript", "nav"}
NO_CONTENT_CLASSES = {"ltx_page_logo", "ltx_page_navbar", "ltx_page_footer", "ltx_TOC", "ltx_error", "ltx_authors", "ltx_role_affiliation", "ltx_dates"}
TITLE_NOTES = {"ltx_role_thanks", "ltx_note", "ltx_dates", "ltx_role_affiliation", "ltx_role_author"}
EQUATIONS = {"ltx_equation", "ltx_equationgroup", "ltx_equation_table"}
ROOTS = [("article", "ltx_document"), ("div", "ltx_document"), ("main", "ltx_document"), ("article", None), ("main", None), ("body", None)]
_THANKS = re.compile(r"\s+(?:Thanks|Project page)\s*:.*", re.I | re.S)


class Node:
    __slots__ = ("attrs", "children", "classes", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = set((attrs.get("class") or "").split())
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def above(self) -> Iterator[Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent

    def find(self, tag: str | None = None, cls: str | None = None) -> Node | None:
        return next((n for n in self.walk() if n is not self and (tag is None or n.tag == tag) and (cls is None or cls in n.classes)), None)

    def strings(self, math: bool = True, skip=lambda n: False) -> Iterator[str]:
        """Pieces of text; with math a formula is one piece, its best form."""
        stack: list[Node | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n is not self and skip(n):
                continue
            elif math and n.tag == "math":
                yield formula(n)
            else:
                stack.extend(reversed(n.children))

    def text(self, **kw) -> str:
        return " ".join(" ".join(self.strings(**kw)).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def _close(self, tags: set, until: set) -> None:
        n = self.at
        while n.parent is not None and n.tag not in until:
            if n.tag in tags:
                self.at = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._close({"p"}, {"li", "td", "th", "blockquote", "figcaption", "button"})
        if tag in _ENDS:
            ends, until = _ENDS[tag]
            self._close(ends, until)
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(source: str) -> Node:
    b = _Builder()
    try:
        b.feed(source)
        b.close()
    except AssertionError:  # a broken declaration: what was read so far counts
        pass
    return b.root


def formula(math: Node) -> str:
    """A formula's alternative text, else its TeX annotation, else what is seen of it."""
    alt = " ".join((math.attrs.get("alttext") or "").split())
    if alt:
        return alt
    for n in math.walk():
        if n.tag == "annotation" and "tex" in (n.attrs.get("encoding") or "").lower() and (t := n.text(math=False)):
            return t
    return " ".join(" ".join(math.strings(math=False, skip=lambda n: n.tag == "annotation")).split())


def _content(n: Node) -> bool:
    return n.tag in NO_CONTENT or bool(n.classes & NO_CONTENT_CLASSES)


def title(root: Node) -> str:
    """The citation title, else the document's title without its notes, else the first h1, else the page's title."""
    for n in root.walk():
        if n.tag == "meta" and n.attrs.get("name") == "citation_title" and (t := " ".join((n.attrs.get("content") or "").split())):
            return t
    marked = root.find("h1", "ltx_title_document") or root.find(None, "ltx_title_document")
    if marked is None:
        marked = next((n for n in root.walk() if n.tag == "h1" and "ltx_title" in n.classes and any(a.tag in ("article", "main") for a in n.above())), None)
    for n in (marked, root.find("h1")):
        if n is not None and (t := _THANKS.sub("", n.text(skip=lambda c: bool(c.classes & TITLE_NOTES) or c.tag == "small")).strip()):
            return t
    page = root.find("title")
    return page.text(math=False) if page else ""


def abstract(root: Node) -> str:
    n = root.find(None, "ltx_abstract")
    if n is None:
        return ""
    return re.sub(r"^Abstract\s*[:.\-]?\s*", "", n.text(skip=lambda c: re.fullmatch("h[1-6]", c.tag) is not None), flags=re.I)


def document_root(root: Node) -> Node:
    """The element that holds the paper; the whole source where it has none of the usual ones."""
    for tag, cls in ROOTS:
        n = root.find(tag, cls)
        if n is not None:
            return n
    return root


def _equation(n: Node) -> str:
    parts = list(dict.fromkeys(t for m in n.walk() if m.tag == "math" and (t := formula(m))))
    return " ".join(parts) or n.text()


def _in_references(n: Node) -> bool:
    for a in (n, *n.above()):
        names = " ".join(a.classes).lower()
        if "bibliography" in names or "biblist" in names or "bibitem" in names or "bibliography" in (a.attrs.get("id") or "").lower():
            return True
    return False


def blocks(source: str | None) -> list[tuple[str, int, str, bool]]:
    """(type, level, text, in_bibliography) in document order. A block repeated in its document counts once. Title
    and abstract aren't part of it; a displayed equation is one block, the outermost; list items that hold paragraphs
    or lists are told by these."""
    if not source or "<" not in source:
        return []
    top = tree(source)
    out, seen = [], set()

    def add(kind, level, text, node):
        if text and (kind, text) not in seen:
            seen.add((kind, text))
            out.append((kind, level, text, _in_references(node)))

    stack = [document_root(top)]
    while stack:
        n = stack.pop()
        if _content(n) or n.classes & {"ltx_abstract", "ltx_title_document"}:
            continue
        if n.classes & EQUATIONS or n.tag == "math" and not any(a.tag in ("p", "li", "figcaption", "td", "th") or re.fullmatch("h[1-6]", a.tag) for a in n.above()):
            add("equation", 0, _equation(n) if n.tag != "math" else formula(n), n)
            continue
        if re.fullmatch("h[1-6]", n.tag):
            t = n.text()
            if t.lower() not in ("contents", "table of contents"):
                add("heading", int(n.tag[1]), t, n)
            continue
        if n.tag in ("figcaption", "caption") or "ltx_caption" in n.classes:
            add("table_caption" if n.tag == "caption" else "figure_caption", 0, n.text(), n)
            continue
        if n.tag == "p" or n.tag == "li" and not any(c.tag in ("p", "ul", "ol") for c in n.walk() if c is not n):
            t = n.text()
            if len(t) > 1:
                add("paragraph" if n.tag == "p" else "list_item", 0, t, n)
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))
    return out


def html_blocks(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, pos, type, level, text, in_bibliography)."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows += [(i, k, *x) for k, x in enumerate(blocks(t))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[ident, "pos", "type", "level", "text", "in_bibliography"])

    return df.select(ident, text).mapInArrow(run, f"{ident} bigint, pos int, type string, level int, text string, in_bibliography boolean")


def html_heads(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, title, abstract) of HTML sources; null where there is none."""

    def run(batches):
        for b in batches:
            trees = [tree(t) if t and "<" in t else None for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([f(t) or None if t else None for t in trees], pa.string()) for f in (title, abstract))], names=[ident, "title", "abstract"])

    return df.select(ident, text).mapInArrow(run, f"{ident} bigint, title string, abstract string")
