"""Main text of web pages by scoring the element tree.

Each page becomes a small tree without the parts that never hold an article (scripts, forms,
menus, notices, comments and the like). Every paragraph passes points for its length and its
commas to its ancestors, less with each level, and an element's points are discounted by the
share of its text that stands in links. The element with the most points is the container;
siblings with enough points, or that read like prose, are kept with it.

One page is one row of an Arrow batch: nothing is shuffled. Defined results: null or empty
html gives an empty text; broken markup (unclosed or stray tags, bad references) is read as
far as a browser would; a page without paragraphs gives the text that is left of its body;
repeated rows are extracted each; all input columns are kept, and the new column gets
another name if its name is taken; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import free_name

# Element names of HTML and words that name parts around an article.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed".split())
NEVER = RAW | frozenset(
    "nav footer aside form menu dialog button select option svg math canvas object audio video "
    "fieldset label datalist map head".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center details summary dd div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p pre section "
    "table tbody thead tfoot tr td th caption ul menu dialog".split()
)
PARAGRAPH = frozenset("p pre blockquote td dd li div section article main body".split())
ENDS = {  # an opening tag closes an open element of these kinds
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "tbody": ("tr", "td", "th", "thead", "tbody"),
}
SCOPE = frozenset("table ul ol dl td th body html article section div button".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar status".split()
)
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising adbox adsense banner sponsor sponsored promo "
    "promotion sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice "
    "notices notification newsletter subscribe subscription signup login popup modal overlay "
    "share sharing social related recommended widget toolbar pagination pager skip hidden".split()
)

#: With these, a class tells what the page has beside the element: "has-sidebar".
BESIDE_WORDS = frozenset("has with no without layout".split())

#: Words that say where or how an element is shown; beside them an aside word names a part.
PLACE_WORDS = frozenset(
    "area articles bar bottom box button buttons col column container content entries entry footer "
    "form group header heading icon icons inner item items left level line link links list main "
    "message news overlay page panel post posts primary right row secondary section stories story "
    "text title top topics unit wrap wrapper x xs s m l xl sm md lg".split()
)

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I
)


class Node:
    __slots__ = ("tag", "parent", "parts", "aside", "inside", "points", "size", "linked")

    def __init__(self, tag: str, parent: Node | None, aside: bool = False):
        self.tag, self.parent, self.aside = tag, parent, aside
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.parts: list = []
        self.points, self.size, self.linked = 0.0, 0, 0


def _is_aside(tag: str, attributes: str, inside: bool) -> bool:
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            for one in value.split():
                words = {w for w in re.split(r"[^a-z]+", one) if w}
                if not ASIDE_WORDS.isdisjoint(words) and BESIDE_WORDS.isdisjoint(words):
                    # "related-work" is no list of related pages
                    if not inside or words <= ASIDE_WORDS | PLACE_WORDS:
                        return True
        elif name == "role":
            if value in ASIDE_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def tree(html: str) -> Node:
    """The elements of a page; parts of no use are left out as they are read."""
    root = here = Node("html", None)
    at, n, final = 0, len(html), html.rfind(">")
    while at < n:
        start = html.find("<", at)
        if start > final and not html.startswith("<!--", start):
            start = -1  # no tag can end any more
        match = TOKEN.match(html, start) if start >= 0 else None
        if start < 0:
            start = n
        if start > at and not here.aside:
            here.parts.append(html[at:start])
        if match is None:
            if start < n and not here.aside:
                here.parts.append("<")
            at = start + 1
            continue
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        attributes = match[3] if match[2] else match[6]
        if tag in VOID:
            if tag in ("br", "hr", "img") and not here.aside:
                here.parts.append("\n" if tag != "hr" else Node("hr", here))
            continue
        if tag in ("html", "body"):
            continue
        here = _implied(here, tag)
        aside = here.aside or _is_aside(tag, attributes, here.inside)
        node = Node(tag, here, aside)
        if not aside:
            here.parts.append(node)
        elif not here.aside and tag in BLOCK:
            here.parts.append(Node("hr", here))  # still ends the block around it
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
        elif not attributes.endswith("/") or tag in BLOCK:
            here = node
    return root


def _implied(here: Node, tag: str) -> Node:
    """Where an opening tag goes once the elements it ends are closed."""
    kinds = ("p",) if tag in BLOCK else ()
    kinds += ENDS.get(tag, ())
    node = here
    while kinds and node is not None and node.parent is not None:
        if node.tag in kinds:
            here = node.parent
        elif node.tag in SCOPE:
            break
        node = node.parent
    return here


def _measure(root: Node) -> list[Node]:
    """Text sizes of all elements, children before parents; returns them in that order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [p for p in node.parts if isinstance(p, Node)]
    order.reverse()
    for node in order:
        for part in node.parts:
            if isinstance(part, str):
                node.size += len(part.strip())
            else:
                node.size += part.size
                node.linked += part.linked
        if node.tag == "a":
            node.linked = node.size
    return order


def _score(order: list[Node]) -> None:
    for node in order:
        if node.tag not in PARAGRAPH or not node.size:
            continue
        own = [p for p in node.parts if isinstance(p, str) or p.tag not in BLOCK]
        chars = sum(len(p.strip()) if isinstance(p, str) else p.size for p in own)
        if not chars:
            continue
        commas = sum(p.count(",") for p in own if isinstance(p, str))
        points = 1.0 + commas + min(chars / 100, 3.0)
        share = 1.0 - sum(p.linked for p in own if isinstance(p, Node)) / chars
        level, up = 1, node if node.tag in ("div", "section", "article", "main", "body") else None
        up = up or node.parent
        while up is not None:
            up.points += points * max(share, 0.0) / level
            level, up = level * 2 if level < 2 else level + 2, up.parent


def _density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _kept(root: Node, order: list[Node]) -> list[Node]:
    """The container and the siblings that belong to it, in page order."""
    _score(order)
    best, most = root, 0.0
    for node in reversed(order):  # parents first: of equals the outer one
        points = node.points * (1.0 - _density(node))
        if node.tag in ("article", "main"):
            points *= 1.5
        if points > most:
            best, most = node, points
    while best.parent is not None and (best.tag in ("p", "span", "b") or _sole(best)):
        best = best.parent
    if best.parent is None:
        return [best]
    least = max(3.0, 0.2 * most)
    return [
        part
        for part in best.parent.parts
        if part is best
        or (
            isinstance(part, Node)
            and (
                part.points * (1.0 - _density(part)) >= least
                or (part.tag == "p" and part.size > 80 and _density(part) < 0.25)
                or part.tag == "h1"
            )
        )
    ]


def _sole(node: Node) -> bool:
    """Whether all text of the parent stands in this element."""
    return node.parent.size == node.size


def main_text(html: str) -> str:
    """Blocks of the main content, one per line."""
    root = tree(html)
    order = _measure(root)
    blocks, words = [], []

    def close():
        text = " ".join(unescape("".join(words)).split())
        if text:
            blocks.append(text)
        words.clear()

    for top in _kept(root, order):
        stack: list = [top]
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                words.append(part)
            elif part is None:
                close()
            elif part is not top and part.tag in ("ul", "ol", "div") and _links_only(part):
                close()
            else:
                edge = part.tag in BLOCK
                if edge:
                    close()
                    stack.append(None)
                stack += reversed(part.parts)
        close()
    return "\n".join(blocks)


def _links_only(node: Node) -> bool:
    return node.size > 0 and _density(node) > 0.8


def extract(pages: DataFrame, html: str = "html", name: str = "main_text") -> DataFrame:
    """``pages`` with the main text of ``html``."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    return pages.withColumn(free_name(pages, name), texts(body))
