"""A tolerant tree of an HTML page on the standard parser, and the block table of its elements."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "table", "ul", "ol", "dl", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre", "hr", "form", "body"}
#: A tag that closes an open one of these kinds when it begins (fixed values).
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
SILENT = {"script", "style", "head", "title"}
SKIPPED_P = {"bglang", "hd-date", "hd-lg", "hd-oj", "hd-ti"}


class Node:
    __slots__ = ("tag", "cls", "id", "parent", "items", "pos", "attrs")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.cls, self.id = " ".join((attrs.get("class") or "").split()), attrs.get("id") or ""
        self.items: list[Node | str] = []
        self.pos = -1

    @property
    def children(self) -> list["Node"]:
        return [x for x in self.items if isinstance(x, Node)]

    def walk(self):
        """All elements below, in document order."""
        stack = self.children[::-1]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(n.children[::-1])

    def find(self, tag: str | None = None, cls: str | None = None):
        return [n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.cls.split())]

    def strings(self):
        stack: list = self.items[::-1]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                if x.strip():
                    yield x.strip()
            elif x.tag not in SILENT:
                stack.extend(x.items[::-1])

    def text(self) -> str:
        """Non-blank text nodes joined by one space, normalised."""
        return clean(" ".join(self.strings()))

    def inside(self, test) -> bool:
        n = self.parent
        while n is not None:
            if test(n):
                return True
            n = n.parent
        return False

    def following(self):
        """Later siblings, in order."""
        if self.parent is None:
            return []
        sib = self.parent.children
        return sib[sib.index(self) + 1 :]


def clean(s: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", s).replace("­", "")).strip()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _close_to(self, stop) -> None:
        self.at = stop.parent or self.root

    def handle_starttag(self, tag, attrs):
        tag = tag.split(":")[-1]
        if tag in BLOCKS or tag in CLOSES:
            n = self.at
            while n is not self.root and n.tag not in ("td", "th", "div", "body", "table", "li", "dd") or n.tag in CLOSES.get(tag, ()):
                if (n.tag == "p" and tag in BLOCKS) or n.tag in CLOSES.get(tag, ()):
                    self._close_to(n)
                    break
                n = n.parent
                if n is None:
                    break
        node = Node(tag, dict(attrs), self.at)
        self.at.items.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.items.append(Node(tag.split(":")[-1], dict(attrs), self.at))

    def handle_endtag(self, tag):
        tag = tag.split(":")[-1]
        n = self.at
        while n is not self.root:
            if n.tag == tag:
                self._close_to(n)
                return
            n = n.parent

    def handle_data(self, data):
        self.at.items.append(data)


def _strict(page: str) -> Node | None:
    """The tree of a page that is well-formed XML, names without their namespace; else None."""
    try:
        top = ElementTree.fromstring(page)
    except (ElementTree.ParseError, ValueError):
        return None
    root = Node("#root", {}, None)
    stack = [(top, root)]
    while stack:
        e, parent = stack.pop()
        node = Node(e.tag.rpartition("}")[2].lower(), {k.rpartition("}")[2].lower(): v for k, v in e.attrib.items()}, parent)
        node.items = [e.text] if e.text else []
        at = [i for i, x in enumerate(parent.items) if x is e]
        if at:
            parent.items[at[0]] = node
        else:
            parent.items.append(node)
        for k in e:
            node.items.append(k)  # its place, until it is made
            if k.tail:
                node.items.append(k.tail)
            stack.append((k, node))
    return root


def parse(page: str) -> Node:
    """The tree of a page: as XML if it is well-formed, else by the tolerant reader."""
    root = _strict(page) if page.lstrip()[:5].lower() in ("<?xml", "<html", "<!doc") else None
    if root is None:
        b = _Builder()
        b.feed(page)
        b.close()
        root = b.root
    for i, n in enumerate(root.walk()):
        n.pos = i
    return root


def flatten_content(root: Node) -> None:
    """Children of div.content take its place; its own strings are dropped."""
    for n in list(root.walk()):
        if n.tag == "div" and n.cls == "content" and n.parent is not None:
            at = n.parent.items.index(n)
            kids = n.children
            for k in kids:
                k.parent = n.parent
            n.parent.items[at : at + 1] = kids


def table_text(table: Node) -> str:
    """Cells joined by ' | ', rows by line ends, blank rows dropped."""
    rows = []
    for tr in table.find("tr"):
        cells = [c.text() for c in tr.children if c.tag in ("td", "th")]
        if any(cells):
            rows.append(" | ".join(cells))
    return "\n".join(rows)


def drop_footnote_marks(root: Node) -> None:
    for n in list(root.walk()):
        if (n.tag == "a" and {"footnoteRef", "FootnoteReference"} & set(n.cls.split())) or (n.tag == "span" and "FootnoteReference" in n.cls.split()):
            n.parent.items.remove(n)


def leaf_paragraphs(root: Node) -> list[Node]:
    return [p for p in root.find("p") if not any(c.tag == "p" for c in p.walk())]


def full_text(root: Node) -> str | None:
    return " ".join(t for p in leaf_paragraphs(root) if not SKIPPED_P & set(p.cls.split()) and (t := p.text())) or None


BLOCK = StructType(
    [StructField("pos", IntegerType()), StructField("end_pos", IntegerType()), StructField("depth", IntegerType()), StructField("parent_pos", IntegerType())]
    + [StructField(n, StringType()) for n in ("tag", "cls", "id", "text")]
    + [StructField("is_leaf_p", BooleanType())]
)


def blocks(page: str) -> list[tuple]:
    """Elements in document order; pos..end_pos spans an element and all it holds."""
    root = parse(page)
    out, last = [], {}
    order = list(root.walk())
    for n in reversed(order):
        last[n.pos] = max([n.pos, *(last[c.pos] for c in n.children)])
    depth = {-1: -1}
    for n in order:
        depth[n.pos] = depth[n.parent.pos] + 1
        out.append((n.pos, last[n.pos], depth[n.pos], n.parent.pos, n.tag, n.cls, n.id, n.text(), n.tag == "p" and not any(c.tag == "p" for c in n.walk())))
    return out


@F.pandas_udf(ArrayType(BLOCK))
def _blocks(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else [dict(zip(BLOCK.names, b)) for b in blocks(x)])


def html_blocks(c: Column) -> Column:
    return _blocks(c)


@F.pandas_udf(StringType())
def html_full_text(s: pd.Series) -> pd.Series:
    """Text of the leaf paragraphs of a page; null where there is none."""
    return s.map(lambda x: None if x is None else full_text(parse(x)))
