"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over block-level elements: a sequence of elements, each
once, optional or repeated, with text slots.  Pages of a host are aligned with its wrapper one after the
other: a mismatch becomes an optional element, a run of equal siblings (or of equal groups of siblings)
a repeated one, a text that differs a variable slot.  Wrappers can be aligned with each other, so tasks
infer from their own pages and only wrappers are shuffled, salted first, then per host.

The wrapper then says which element of a host's pages holds the article: the innermost that has most of the
text in slots that vary and repeat, or stand in paragraphs; slots that are constant or mostly links count
nothing.  Names such as ``article`` or ``nav`` settle what the slots leave open.  Pages are read through it.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from retailmarts.llm.common import Scratch

#: Fixed values of HTML: elements without content, with raw content, and those that run inside a line.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
    "wbr",
}
PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption"}
#: Elements that say nothing about what they hold, unless they have a name.
PLAIN = {"div", "section", "span", "center"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "svg", "math"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img",
}
#: Elements that end an open element of the first name when they start.
CLOSERS = {
    "p": {
        "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
        "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
        "table", "ul", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead",
    },
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody"}, "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"}, "option": {"option"},
}
#: Elements and names (in class, id, role) that are no article.  A header element inside the article is
#: part of it.
NO_TEXT = {
    "head", "header", "nav", "aside", "footer", "form", "script", "style", "noscript", "template", "iframe",
    "svg", "math", "button", "select", "textarea", "input", "menu", "dialog", "title", "object", "embed",
    "canvas", "audio", "video",
}
NO_ARTICLE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored",
    "promo", "promotion", "banner", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "masthead", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup",
    "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
    "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus",
    "respond", "reply", "replies", "pagination", "pager", "widget", "toolbar", "copyright", "skip", "search",
    "complementary", "contentinfo", "hidden",
}
ARTICLE = {"article", "main", "content", "post", "entry", "story", "body", "text"}
#: Distinct pages on which a slot must be the same to be constant, and hosts whose wrappers a task holds at once.
LEAST = 8
HOSTS = 2000
#: Wrappers that are merged in one task.
FAN = 64
#: What a character of a slot that is no paragraph and does not repeat counts, and the share of all that an
#: article has at least.
SINGLE = 0.1
MOST = 0.6

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_CUT_OFF = re.compile(r"</?[a-zA-Z][^>]*\Z")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NAMES = re.compile(r"[a-z]+")


@dataclass
class Element:
    """A block-level element of a page: label, names, and texts and elements in order."""

    tag: str
    names: frozenset[str] = frozenset()
    children: list = field(default_factory=list)  # str or Element
    links: int = 0  # characters inside links

    @cached_property
    def label(self) -> str:
        """Tag and telling names; of a plain element without such names, what it holds."""
        own = sorted(self.names & (NO_ARTICLE | ARTICLE))
        return ".".join([self.tag, *own]) if own or self.tag not in PLAIN else f"{self.tag}:{self.holds}"

    @cached_property
    def size(self) -> tuple[int, int]:
        """Characters of all text, and of those the ones inside links."""
        chars, links = 0, self.links
        for c in self.children:
            if isinstance(c, str):
                chars += len(c.strip())
            else:
                chars, links = chars + c.size[0], links + c.size[1]
        return chars, links

    @property
    def holds(self) -> str:
        """``links``, ``paragraphs`` of its own, other ``blocks``, ``text`` alone, or nothing."""
        chars, links = self.size
        if not chars:
            return ""
        inner = [c for c in self.children if isinstance(c, Element) and c.size[0]]
        if 2 * links > chars:
            return "links"
        if any(c.tag in PARAGRAPHS and 2 * c.size[1] <= c.size[0] for c in inner):
            return "paragraphs"
        return "blocks" if inner else "text"

    @property
    def outside(self) -> bool:
        return self.tag in NO_TEXT or bool(self.names & NO_ARTICLE)


def parse(page: str | None) -> Element:
    """The block-level tree of a page; broken and cut-off pages give what is there."""
    page, root = page or "", Element("#page")
    stack, position, link = [root], 0, 0

    def text(raw: str) -> None:
        if raw:
            decoded = html.unescape(raw)
            stack[-1].children.append(decoded)
            if link:
                stack[-1].links += len(decoded)

    while position < len(page):
        at = page.find("<", position)
        if at < 0:
            text(page[position:])
            break
        text(page[position:at])
        token = _TOKEN.match(page, at) or _CUT_OFF.match(page, at)
        if not token:
            text("<")
            position = at + 1
            continue
        position = token.end()
        if token.re is _CUT_OFF:
            break
        if not token[2]:
            if token[0].startswith("<![CDATA["):
                text(" ")
            continue
        tag, closing = token[2].lower(), bool(token[1])
        if not closing and tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, position)
            position = end.end()
            continue
        if tag in INLINE:
            if tag == "a":
                link = max(0, link - 1) if closing else 1
            elif tag == "br":
                text(" ")
            continue
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            link = 0
            continue
        while len(stack) > 1 and tag in CLOSERS.get(stack[-1].tag, ()):
            stack.pop()
        names = set()
        for m in _ATTRIBUTE.finditer(token[3] or ""):
            names |= set(_NAMES.findall((m[2] or m[3] or m[4] or "").lower()))
        if _HIDDEN.search(token[3] or ""):
            names.add("hidden")
        element = Element(tag, frozenset(names))
        stack[-1].children.append(element)
        link = 0
        if tag not in VOID and not (token[3] or "").endswith("/"):
            stack.append(element)
    return root


# ---------------------------------------------------------------- wrappers


@dataclass
class Node:
    """An element of a wrapper.  ``text`` marks the text of a constant slot, None if it varies; ``pages`` holds
    marks of the distinct pages that have it, ``MANY`` if there are ``LEAST`` or more."""

    label: str
    pages: frozenset[int] = frozenset()
    optional: bool = False
    repeated: bool = False
    text: str | None = ""
    chars: int = 0
    links: int = 0
    children: list[Node] = field(default_factory=list)

    def expression(self) -> str:
        inner = " ".join(["#"] * (self.text is None) + [c.expression() for c in self.children])
        return self.label.split(":")[0] + (f"({inner})" if inner else "") + ("+" if self.repeated else "") + ("?" if self.optional else "")

    def packed(self) -> list:
        return [self.label, sorted(self.pages), int(self.optional), int(self.repeated), self.text, self.chars, self.links,
                [c.packed() for c in self.children]]

    @staticmethod
    def unpacked(x: list) -> Node:
        return Node(x[0], frozenset(x[1]), bool(x[2]), bool(x[3]), x[4], x[5], x[6], [Node.unpacked(c) for c in x[7]])


#: Stands for LEAST pages or more, whichever they are.
MANY = frozenset(range(-LEAST, 0))


def mark(text: str) -> str:
    """Length and hash of a whole text; of none, nothing."""
    whole = text.encode("utf-8", "surrogatepass")
    return f"{len(text)}:{hashlib.blake2b(whole, digest_size=12).hexdigest()}" if text else ""


def _page_mark(element: Element) -> int:
    """A hash of all texts of a page: copies have the same."""
    digest = hashlib.blake2b(digest_size=6)

    def walk(x: Element) -> None:
        for c in x.children:
            if isinstance(c, str):
                digest.update(c.encode("utf-8", "surrogatepass") + b"\0")
            else:
                walk(c)

    walk(element)
    return int.from_bytes(digest.digest(), "big")


def _united_pages(a: frozenset[int], b: frozenset[int]) -> frozenset[int]:
    if a is b or a == MANY or b == MANY:
        return MANY if b == MANY else a
    both = a | b
    return both if len(both) < LEAST else MANY


def from_page(element: Element, pages: frozenset[int] | None = None) -> Node:
    """The page as a wrapper that matches it alone, runs of equal siblings folded."""
    pages = frozenset([_page_mark(element)]) if pages is None else pages
    text = " ".join(" ".join(c for c in element.children if isinstance(c, str)).split())
    children = [from_page(c, pages) for c in element.children if isinstance(c, Element)]
    return Node(element.label, pages, text=mark(text), chars=len(text), links=element.links, children=fold(children))


def merge(a: Node, b: Node) -> Node:
    """The wrapper that matches what either matches."""
    return Node(
        a.label, _united_pages(a.pages, b.pages), a.optional or b.optional, a.repeated or b.repeated,
        a.text if a.text == b.text else None, a.chars + b.chars, a.links + b.links, align(a.children, b.children),
    )


def _again(a: Node, b: Node) -> Node:
    """Two occurrences in one page as one repeated element."""
    both = merge(a, b)
    both.repeated = True
    return both


def fold(nodes: list[Node]) -> list[Node]:
    """Folds neighbouring groups of siblings with equal labels into one repeated group: a single element,
    then pairs, up to groups of four.  The members of a longer group are each marked as repeated."""
    for size in range(1, 5):
        out: list[Node] = []
        for node in nodes:
            out.append(node)
            while len(out) >= 2 * size and all(
                x.label == y.label for x, y in zip(out[-2 * size : -size], out[-size:])
            ):
                out[-2 * size :] = [_again(x, y) for x, y in zip(out[-2 * size : -size], out[-size:])]
        nodes = out
    return nodes


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Longest common subsequence of labels; what only one side has becomes optional."""
    if [x.label for x in a] == [x.label for x in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    for x in a[i:] + b[j:]:
        x.optional = True
        out.append(x)
    return fold(out)


def _tag(node: Node) -> str:
    return re.split("[.:]", node.label, maxsplit=1)[0]


def evidence(node: Node) -> float:
    """What a node's own slot says for an article: its characters, if the slot varies or may vary, is not mostly
    links, and is a paragraph or repeats; a share of them if it is neither."""
    if 2 * node.links > node.chars or (node.text and not node.optional and not node.repeated and node.pages == MANY):
        return 0
    return node.chars * (1 if node.repeated or _tag(node) in PARAGRAPHS else SINGLE)


def article(wrapper: Node) -> list[str]:
    """The path of labels of the element that holds the article.

    The innermost element with ``MOST`` of the evidence, or the parent if that has evidence in paragraphs of its
    own.  Where elements around it have telling names, an article or main element, or one named so, is taken
    instead.  Without any evidence it is the page."""
    found: list[tuple[tuple, float, Node]] = []

    def walk(node: Node, path: tuple) -> float:
        if _outside(node.label):
            return 0
        path = (*path, node.label)
        at = len(found)
        found.append((path, 0, node))
        total = evidence(node) + sum(walk(c, path) for c in node.children)
        found[at] = (path, total, node)
        return total

    whole = walk(wrapper, ())
    able = [p for p in found if p[1] >= MOST * whole and _tag(p[2]) not in PARAGRAPHS]
    if not able or not whole:
        return _named(found) or [wrapper.label]
    path, _, _ = max(able, key=lambda p: (len(p[0]), p[1]))
    around = [p for p in found if p[0] == path[: len(p[0])]]
    named = _named(around)
    if named:
        return named
    known = {p[0]: p[2] for p in around}
    while len(path) > 1 and any(_tag(c) in PARAGRAPHS and evidence(c) for c in known[path[:-1]].children):
        path = path[:-1]
    return list(path)


def _named(paths: list[tuple[tuple, float, Node]]) -> list[str]:
    """Of elements that are named as an article, the one with most evidence."""
    for match in (
        lambda n: _tag(n) == "article", lambda n: _tag(n) == "main",
        lambda n: bool(set(n.label.split(".")[1:]) & ARTICLE),
    ):
        found = [p for p in paths if match(p[2])]
        if found:
            return list(max(found, key=lambda p: (p[1], -len(p[0]), p[0]))[0])
    return []


def _outside(label: str) -> bool:
    tag, *names = label.split(":")[0].split(".")
    return tag in NO_TEXT or bool(set(names) & NO_ARTICLE)


def constant(wrapper: Node) -> set[tuple[tuple, str]]:
    """Marks of text slots with the same text on at least ``LEAST`` distinct pages, all that have the slot.
    What lies in an article element or below the article's path is text of the article, even if equal."""
    found: set[tuple[tuple, str]] = set()
    chosen = tuple(article(wrapper))

    def walk(node: Node, path: tuple) -> None:
        path = (*path, node.label)
        if _tag(node) == "article" or path == chosen:
            return
        if node.text and not node.repeated and not node.optional and node.pages == MANY:
            found.add((path, node.text))
        for c in node.children:
            walk(c, path)

    walk(wrapper, ())
    return found


# ---------------------------------------------------------------- extraction


def main_text(page: str | None, path: list[str], fixed: set[tuple[tuple, str]]) -> str:
    """Blocks of the article in page order, one a line.  A page that lacks the wrapper's article element
    is read as a whole."""
    root = parse(page)
    found: list[tuple[Element, tuple]] = []

    def locate(element: Element, at: tuple, exact: bool) -> None:
        at = (*at, element.label)
        if (list(at) == path) if exact else element.tag == "article":
            found.append((element, at))
            return
        for c in element.children:
            if isinstance(c, Element) and not c.outside:
                locate(c, at, exact)

    for exact in (True, False):
        if not found:
            locate(root, (), exact)
    blocks: list[str] = []
    header = bool(found) and found[0][0].tag in ("article", "main")

    def read(element: Element, at: tuple) -> None:
        line: list[str] = []

        def flush() -> None:
            text = " ".join("".join(line).split())
            if text and (at, mark(text)) not in fixed:
                blocks.append(text)
            line.clear()

        for c in element.children:
            if isinstance(c, str):
                line.append(c)
            else:
                flush()
                if not c.outside or (header and c.tag == "header" and not c.names & NO_ARTICLE):
                    read(c, (*at, c.label))
        flush()

    for element, at in found or [(root, (root.label,))]:
        read(element, at)
    return "\n".join(blocks)


# ---------------------------------------------------------------- jobs


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """A wrapper per host of a task, from all its pages."""
    seen: dict[str, Node] = {}

    def out() -> pd.DataFrame:
        return pd.DataFrame({"host": list(seen), "wrapper": [json.dumps(w.packed()) for w in seen.values()]})

    for pdf in batches:
        for host, page in zip(pdf["host"], pdf["html"]):
            node = from_page(parse(page))
            seen[host] = merge(seen[host], node) if host in seen else node
        if len(seen) > HOSTS:
            yield out()
            seen.clear()
    if seen:
        yield out()


def _united(pdf: pd.DataFrame) -> pd.DataFrame:
    nodes = [Node.unpacked(json.loads(w)) for w in sorted(pdf["wrapper"])]
    wrapper = nodes[0]
    for node in nodes[1:]:
        wrapper = merge(wrapper, node)
    return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [json.dumps(wrapper.packed())]})


def with_host(pages: DataFrame) -> DataFrame:
    """Host in lower case; of a null url or one without a host, empty."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.withColumn("host", host)


def infer(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, wrapper) from all pages (host, html).

    Tasks infer from their own pages.  Their wrappers are merged in a tree: no task merges more than about
    ``FAN`` of a host at once, however many tasks have pages of it."""
    partial = scratch.save(pages.select("host", F.col("html").cast("string").alias("html")).mapInPandas(
        _infer, "host STRING, wrapper STRING"
    ))
    while True:
        most = partial.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= FAN:
            return partial.groupBy("host").applyInPandas(_united, "host STRING, wrapper STRING")
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2 * most // FAN))
        partial = scratch.save(
            partial.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(_united, "host STRING, wrapper STRING")
        )


def extract(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    A null or empty html gives an empty text; pages without a host form a host of their own; repeated rows
    give repeated results; a cut-off page gives what is there; an empty table gives no row; other columns
    are ignored.
    """
    hosted = with_host(pages.select("page_id", "url", F.col("html").cast("string").alias("html")))
    inferred = scratch.save(infer(hosted, scratch)).withColumnRenamed("host", "_host")
    rows = hosted.join(inferred, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "wrapper")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list[str], set]] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch["html"].to_pylist(), batch["wrapper"].to_pylist()):
                if wrapper not in known:
                    if len(known) >= HOSTS:
                        known.clear()
                    node = Node.unpacked(json.loads(wrapper))
                    known[wrapper] = article(node), constant(node)
                texts.append(main_text(page, *known[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = StructType([
        pages.schema["page_id"], pages.schema["url"], StructField("text", StringType()), StructField("n_chars", LongType()),
    ])
    return rows.mapInArrow(read, schema)
