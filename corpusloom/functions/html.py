"""HTML to title, text and links: an Arrow UDF over the standard library's tolerant parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .urls import normalize_reference

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript svg canvas form iframe header footer nav aside".split())
#: An open element of the first kind is closed by the start of one of the second.
IMPLIED = {"p": frozenset("p div ul ol li table section article h1 h2 h3 h4 h5 h6 pre blockquote form header footer nav aside main".split()), "li": frozenset(["li"]), "tr": frozenset(["tr"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "option": frozenset(["option"])}
ROOTS = ("main", "article", ("role", "main"), *(f"div.{c}" for c in "document body content container markdown-body".split()), "section.content", *(("id", x) for x in "content __next root".split()))
_LINK = StructType().add("url", StringType()).add("anchor_text", StringType())
RESULT = StructType().add("title", StringType()).add("content", StringType()).add("links", ArrayType(_LINK)).add("link_count", IntegerType())


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs=()):
        self.tag, self.attrs, self.children = tag, {k: v or "" for k, v in attrs}, []

    def walk(self):
        """Elements below, in document order, without recursion (pages may nest deeply)."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def strings(self):
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    stack.append(iter(child.children))
                    break
                if child.strip():
                    yield child.strip()
            else:
                stack.pop()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("document")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        while len(self.open) > 1 and tag in IMPLIED.get(self.open[-1].tag, ()):
            self.open.pop()
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, attrs))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def tidy(text: str) -> str:
    """The text's filled lines, squeezed; of equal neighbours one stays."""
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace("\u00a0", " ").replace("\u200b", "")
    out: list[str] = []
    for line in (x.strip() for x in re.sub("[\x0b\x0c\t ]+", " ", text).split("\n")):
        if line and (not out or out[-1] != line):
            out.append(line)
    return "\n".join(out)


def _matches(node: Node, selector) -> bool:
    if isinstance(selector, tuple):
        return node.attrs.get(selector[0]) == selector[1]
    tag, _, css = selector.partition(".")
    return node.tag == tag and (not css or css in node.attrs.get("class", "").split())


def _prune(node: Node) -> None:
    stack = [node]
    while stack:
        top = stack.pop()
        top.children = [c for c in top.children if not (isinstance(c, Node) and c.tag in DROPPED)]
        stack += [c for c in top.children if isinstance(c, Node)]


def links_of(root: Node, base: str | None) -> list[dict]:
    """Absolute links by URL; the first non-empty anchor text of each."""
    found: dict[str, str] = {}
    for a in root.walk():
        if a.tag == "a" and "href" in a.attrs and (url := normalize_reference(a.attrs["href"], base)):
            found[url] = found.get(url) or tidy(" ".join(a.strings()))[:300]
    return [{"url": u, "anchor_text": found[u]} for u in sorted(found)]


def extract(html: str | None, base: str | None, links_after_pruning: bool = False) -> dict:
    """Title, text and links of a page. Links come before navigation is pruned, or after (the older order)."""
    root = parse(html)
    count = sum(a.tag == "a" and "href" in a.attrs for a in root.walk())
    links = [] if links_after_pruning else links_of(root, base)
    _prune(root)
    if links_after_pruning:
        links = links_of(root, base)
    first = lambda test: next((n for n in root.walk() if test(n)), None)
    title = ""
    for tag in ("h1", "title"):
        node = first(lambda n, t=tag: n.tag == t)
        if node is not None and not title:
            title = tidy(" ".join(node.strings()))
    body = next((n for s in ROOTS if (n := first(lambda n, s=s: _matches(n, s))) is not None), None) or first(lambda n: n.tag == "body") or root
    for table in [n for n in body.walk() if n.tag == "table"]:
        rows = []
        for tr in (n for n in table.walk() if n.tag == "tr"):
            cells = [c for c in (tidy(" ".join(td.strings())) for td in tr.walk() if td.tag in ("td", "th")) if c]
            if cells:
                rows.append(" | ".join(cells))
        if rows:
            table.children = ["\n" + "\n".join(rows) + "\n"]
    return {"title": title, "content": tidy("\n".join(body.strings())), "links": links, "link_count": count}


@F.pandas_udf(RESULT)
def extract_html(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([extract(h, b) for h, b in zip(html, base, strict=True)], columns=["title", "content", "links", "link_count"])


@F.pandas_udf(RESULT)
def extract_html_pruned(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    """The older order: links are read after navigation is gone."""
    return pd.DataFrame([extract(h, b, links_after_pruning=True) for h, b in zip(html, base, strict=True)], columns=["title", "content", "links", "link_count"])
