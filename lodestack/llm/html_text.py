"""Main text of web pages by composite text density.

A page is read into a tree of block elements; inline formatting belongs to its block. What HTML
itself marks as no content goes first: scripts, styles, forms, menus, headers, footers, asides,
hidden elements. For every other node, characters a tag are adjusted by the share of characters
and tags in links; a node's sum adds the densities of its children. The subtree of the greatest
sum holds the text, and others whose density reaches the least density on the way from it up to
the body. Class names decide after that: an element named as an advert, menu, sidebar, notice or
comments is neither chosen as that subtree nor kept inside it.

Reading is linear in the page: from a quote that never closes on, tags end at the next ">".
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
# Names of elements and of parts of pages.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
NO_CONTENT = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "fieldset", "dialog", "menu", "object", "canvas", "audio", "video", "map"}
NO_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
#: Words of a class or id, whole between spaces, hyphens and underscores, that name a part as no article text.
NO_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert|adverts|advertisement|advertising|adsense|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|popup|modal|newsletter|subscribe|paywall|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|pagination|pager|sidebar|footer|masthead|topbar|toolbar|comments?|commentlist|disqus|replies|login|signup)(?:$|[\s_-])",
    re.I,
)
KEEP = {"article", "main", "body", "html"}
#: Elements that end an open paragraph, and those that end an open one of their own kind.
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
P_SCOPE = {"table", "td", "th", "button", "object"}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Node:
    __slots__ = ("tag", "parent", "level", "in_p", "parts", "noise", "named", "link", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: bool = False, named: bool = False):
        self.tag, self.parent, self.noise, self.named = tag, parent, noise, named
        self.level = parent.level + 1 if parent else 0
        self.in_p = parent is not None and tag not in P_SCOPE and (parent.in_p or parent.tag == "p")
        self.parts: list = []  # text, None (a break) and nodes, in page order
        self.link = 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _kind(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether HTML itself marks an element as no content, and whether its class or id names it so."""
    if tag in NO_CONTENT:
        return True, False
    named = False
    if not attributes or attributes.isspace():
        return False, False
    for name, a, b, c, bare in ATTRIBUTE.findall(attributes):
        name, value = (name or bare).lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "role" and value.lower() in NO_ROLE:
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        named = named or (name in ("class", "id") and tag not in KEEP and NO_NAME.search(value) is not None)
    return False, named


def tokens(page: str) -> Iterator[tuple[str, str, str, str, int]]:
    """(text before, "/" of an end tag, name, attributes, position behind); a last one without a name.

    Comments, declarations and processing instructions are left out. Linear: a scan that finds no
    closing quote or bracket is not made again.
    """
    at = start = 0
    quotes, pending = True, []
    while (at := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), at):
            pending.append(page[start:at])
            end, width = (page.find("-->", at + 4), 3) if page.startswith("<!--", at) else (page.find(">", at), 1)
            if end < 0:
                start = at = len(page)
                break
            start = at = end + width
            continue
        m = TAG.match(page, at)
        if m is None:
            at += 1
            continue
        rest = REST.match(page, m.end()) if quotes else None
        if rest is None:  # an unclosed quote, or an unclosed tag
            quotes = False
            end = page.find(">", m.end())
            if end < 0:
                break  # the page ends inside a tag
            attributes, behind = page[m.end() : end], end + 1
        else:
            attributes, behind = rest[1], rest.end()
        pending.append(page[start:at])
        at = yield "".join(pending), m[1], m[2].lower(), attributes, behind
        pending, start = [], at
    else:
        at = len(page)
    yield "".join(pending) + page[start:at], "", "", "", len(page)


def parse(page: str) -> Node:
    """Tree of block elements; text of raw elements and of what is no content is left out."""
    root = here = Node("html", None)
    opened: Counter = Counter({"html": 1})
    quiet: list = []  # open inline elements that are no content: [node, like elements open inside]
    unclosed: set[str] = set()  # raw elements that have no end tag any more

    def move(to: Node) -> None:
        nonlocal here
        while here.level > to.level:
            opened[here.tag] -= 1
            here = here.parent
        while quiet and quiet[-1][0].level > here.level:
            quiet.pop()

    def close(tags: set[str], stop: set[str]) -> None:
        if not any(opened[t] > 0 for t in tags):
            return
        node = here
        while node.parent is not None and node.tag not in stop:
            if node.tag in tags:
                return move(node.parent)
            node = node.parent

    def put(node: Node) -> None:
        nonlocal here
        here.parts.append(node)
        opened[node.tag] += 1
        here = node

    reader = tokens(page)
    token = next(reader)
    while True:
        text, slash, tag, attributes, at = token
        if text:
            here.parts.append(text)
            if here.link:
                here.link_chars += len(text.strip())
        if not tag:
            return root
        if slash:
            if tag in INLINE:
                if quiet and quiet[-1][0].tag == tag:
                    quiet[-1][1] -= 1
                    if not quiet[-1][1]:
                        move(quiet[-1][0].parent)
                elif tag == "a" and here.link:
                    here.link -= 1
            elif tag == "br":
                here.parts.append(None)
            elif opened[tag] > 0 and tag != "html":
                node = here
                while node.tag != tag:
                    node = node.parent
                move(node.parent)
        elif tag in RAW:
            stop = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(page, at)
            if stop is None:
                unclosed.add(tag)
            at = stop.end() if stop else len(page)
            here.parts.append(None if tag not in ("script", "style", "template") else "")
        elif tag in INLINE:
            noise, named = _kind(tag, attributes)
            if noise or named:  # a block of its own, without content
                put(Node(tag, here, True))
                quiet.append([here, 1])
            else:
                if quiet and quiet[-1][0].tag == tag:
                    quiet[-1][1] += 1
                here.tags += 1
                if tag == "a":
                    here.link += 1
                    here.link_tags += 1
        elif tag in VOID:
            here.parts.append(None)
            if tag != "br":
                here.tags += 1
        else:
            if tag in ENDS_P and (here.tag == "p" or here.in_p):
                close({"p"}, P_SCOPE)
            if tag in ENDS_SAME:
                close(ENDS_SAME[tag], SCOPE[tag])
            if tag == "body":
                move(root)
            if tag != "html":
                node = Node(tag, here, *_kind(tag, attributes))
                if not attributes.rstrip().endswith("/") or tag in ENDS_P or tag in KEEP:
                    put(node)
                else:
                    here.parts.append(node)
        token = reader.send(at)


def _own(node: Node) -> int:
    return sum(len(p.strip()) for p in node.parts if isinstance(p, str))


def measure(body: Node) -> list[Node]:
    """Composite text density of every node below body that may be content, body first."""
    order, todo = [], [body]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]
    for node in reversed(order):
        node.chars += _own(node)
        if (up := node.parent) is not None and node is not body:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    base = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, node.link_tags
        if not c:
            continue
        node.density = c / t
        if lc:
            scale = math.log(c / max(1, c - lc) * lc + base * c + math.e)
            node.density *= max(0.0, math.log((c / lc) * (t / max(1, lt)) + 1e-9) / math.log(scale)) if scale > 1 else 0.0
        if node is not body:
            node.parent.total += node.density
    return order


def content_nodes(body: Node) -> list[Node]:
    """Roots of the content, in page order."""
    order = measure(body)
    if not body.chars:
        return []
    apart: set[Node] = set()  # named as no article text, and all below
    for node in order:
        if node.named or node.parent in apart:
            apart.add(node)
    best = max((n for n in order if n not in apart), key=lambda n: n.total)  # the first, so the outermost, of equals
    if not best.total:
        return [body]
    threshold, node = best.density, best
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    whole = node = best
    while node is not body:  # the article that holds it is one text
        node = node.parent
        if node.tag in ("article", "main"):
            whole = node
            break
    chosen, todo, above = [], [body], set()
    node = whole
    while node is not None:
        above.add(node)
        node = node.parent
    while todo:
        node = todo.pop()
        if node is whole:
            chosen.append(node)
        elif node in above:
            todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]
        elif whole.tag not in ("article", "main") and node not in apart and node.density >= threshold and node.chars:
            chosen.append(node)
    return chosen


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks in page order, entities decoded, white space made single spaces."""
    pending: list[str] = []

    def flush() -> Iterator[str]:
        s = " ".join(html.unescape("".join(pending)).split())
        pending.clear()
        if s:
            yield s

    todo: list = [iter(node.parts)]
    while todo:
        part = next(todo[-1], todo)
        if part is todo:
            yield from flush()
            todo.pop()
        elif isinstance(part, Node):
            if part.noise and part.tag in INLINE:
                continue
            yield from flush()
            if not part.noise and not part.named:
                todo.append(iter(part.parts))
        elif part is None:
            yield from flush()
        else:
            pending.append(part)


def main_text(page: str | None) -> str:
    """The main text of a page; empty for null, empty or contentless pages."""
    if not page:
        return ""
    root = parse(page)
    body = next((p for p in root.parts if isinstance(p, Node) and p.tag == "body"), root)
    return " ".join(s for n in content_nodes(body) for s in blocks(n))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of text).

    Whole pages are read; null, empty and contentless pages give an empty text; repeated rows
    are extracted each; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
