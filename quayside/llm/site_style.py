"""Main text of pages by site style trees.

Pages of a host are merged: elements at the same place (tags with classes, from
the root) are one style node. Over the pages that have a node,

- its presentation importance is the entropy, to the base of their number, of
  the sequences of its child tags,
- its content importance is one less the mean entropy of its features, the text
  blocks and link targets below it, over the pages: a block on one page alone has
  entropy 0, one on all pages entropy 1,
- its composite importance weighs the two by the number of its features, since a
  node with much content shows little by its markup.

Equal pages of a host count once, so that a copy is no evidence. With few pages a
node says little: its importance is drawn towards 1 as if ``PRIOR`` more pages had
nothing in common with the others.

Branches of low importance are removed from each page: a menu that is the same on
all pages goes. Elements that HTML or their class declare to be menus, headers,
footers, sidebars, notices, adverts, forms or comments go as well, on hosts too
small to compare and where boilerplate differs between pages. An ``article`` (or
``main``) is the main text where it holds most of what a page does not declare
boilerplate; nothing in it goes by importance alone, and words that also name parts
of articles (``DOUBTFUL``) remove a part of it only if the tree rates it low too.
What holds most of a page's text is never taken for boilerplate.

Null or empty html gives no text. A page without ``article`` or ``main`` gives all
text that is left. Pages without a host form a host of their own. Broken markup is
read as browsers do as to open paragraphs and items; nothing is cut or capped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.spread import join_unique, whole
from quayside.sources.relations import written

IMPORTANCE, GAMMA, PRIOR = 0.1, 0.9, 1.0

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_GAPS = {"br", "td", "th", "img", "hr", "wbr"} - {"wbr"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
    "thead", "tr", "ul",
}
_DROPPED = {
    "head", "script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "canvas", "object",
    "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu",
}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
_SAYS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "paywall", "sidebar", "aside", "rail", "widget", "widgets", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead", "topbar", "toolbar", "footer",
    "comment", "comments", "disqus", "replies", "respond", "share", "sharing", "social", "related", "recommended",
    "recommendations", "trending", "copyright", "form", "search",
}
#: Words of ``_SAYS`` that say nothing certain inside an article.
DOUBTFUL = {"header", "notice", "notices", "search", "form", "social", "banner", "footer", "promotion", "signup", "menu"}
_KEPT = {"html", "body", "article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What an opening tag closes, and what it does not close beyond.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}


@dataclass(eq=False)
class Node:
    tag: str
    path: str
    parent: Node | None
    declared: bool  # declared boilerplate, or inside of such
    content: bool  # an article or main, or inside of one
    doubtful: bool = False  # inside of one, and boilerplate if the tree agrees
    children: list[str] = field(default_factory=list)


def _declared(tag: str, attributes: str, parent: Node | None) -> tuple[bool | None, str]:
    """Whether an element declares itself boilerplate, None if in doubt, and its class for its path."""
    found = {}
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), a or b or c)
    style = " ".join(sorted({re.sub(r"\d+", "#", x) for x in found.get("class", "").split()}))
    if tag in _KEPT:
        says = any(w in ("comment", "comments") for w in map(str.lower, _WORD.findall(found.get("class", "")))) and tag == "article"
        return says, style
    if tag in _DROPPED and not (tag == "header" and parent is not None and parent.content):
        return True, style
    if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, style
    if found.get("role", "").lower() in _ROLES:
        return True, style
    says: set[str] = set()
    for name in [*found.get("class", "").split(), found.get("id", "")]:
        words = [w.lower() for w in _WORD.findall(name)]
        if words and words[0] not in ("has", "no", "with", "is", "without"):
            says |= _SAYS.intersection(words)
    if says and parent is not None and parent.content and says <= DOUBTFUL:
        return None, style
    return bool(says), style


def blocks(html: str) -> Iterator[tuple[Node, str, list[str]]]:
    """Text blocks of a page in order: innermost element, text, link targets."""
    root = Node("", "", None, False, False)
    stack, parts, links, at = [root], [], [], 0

    def ended() -> list[tuple[Node, str, list[str]]]:
        text = " ".join(unescape("".join(parts)).split())
        found = [(stack[-1], text, list(links))] if text or links else []
        parts.clear()
        links.clear()
        return found

    def closed(names: set[str], within: set[str]) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return True
            if stack[i].tag in within:
                return False
        return False

    while (tag := _TAG.search(html, at)) is not None:
        if tag.start() > at:
            parts.append(html[at : tag.start()])
        at = tag.end()
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if tag["close"]:
            if name in _BLOCKS:
                yield from ended()
            if name in _GAPS:
                parts.append(" ")
            closed({name}, set() if name in _BLOCKS else _BLOCKS - {"p"} if name != "p" else {"article", "div", "section"})
            continue
        if name in _BLOCKS:
            yield from ended()
            closed({"p"}, _BLOCKS - {"p"})
        if name in _GAPS:
            parts.append(" ")
        if name in _CLOSES:
            closed(*_CLOSES[name])
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        parent = stack[-1]
        parent.children.append(name)
        attributes = tag["attributes"]
        if name == "a" and (target := re.search(r"href\s*=\s*[\"']?([^\"'\s>]+)", attributes)):
            links.append(target[1])
        if name in _VOID or attributes.endswith("/"):
            continue
        declared, style = _declared(name, attributes, parent)
        stack.append(
            Node(
                name,
                f"{parent.path}/{name}" + (f".{style}" if style else ""),
                parent,
                parent.declared or bool(declared),
                (parent.content or name in ("article", "main")) and not declared,
                declared is None,
            )
        )
    if at < len(html):
        parts.append(html[at:])
    yield from ended()


def chain(node: Node | None) -> Iterator[Node]:
    while node is not None and node.parent is not None:
        yield node
        node = node.parent


def rated(node: Node) -> bool:
    """Whether the tree decides on a node: not on what stays or goes in any case."""
    return node.tag not in _KEPT and (not node.content or node.doubtful)


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def features(html: str) -> dict[int, tuple[set[int], set[int]]]:
    """Per style node of a page, by its key: features of its content, and of its
    presentation. Nodes that stay or go in any case are left out."""
    found: dict[int, tuple[set[int], set[int]]] = {}
    nodes: dict[Node, tuple[set[int], set[int]]] = {}
    for node, text, links in blocks(html):
        if node.declared:
            continue
        new = {_key(x) for x in links} | ({_key(text)} if text else set())
        for above in chain(node):
            if rated(above):
                if above not in nodes:
                    nodes[above] = found.setdefault(_key(above.path), (set(), set()))
                nodes[above][0].update(new)
    for node, (_, shapes) in nodes.items():
        shapes.add(_key(" ".join(node.children)))
    return found


def main_text(html: str, unimportant: set[int]) -> str:
    """The text that stays when declared and unimportant branches go."""
    found = [(node, text) for node, text, _ in blocks(html) if text and not node.declared]
    inside = [x for x in found if x[0].content]
    if 2 * sum(len(text) for _, text in inside) >= sum(len(text) for _, text in found):
        found = inside
    if unimportant:
        half, size = sum(len(text) for _, text in found) / 2, {}

        def low(node: Node) -> set[int]:
            return {_key(above.path) for above in chain(node) if rated(above)} & unimportant

        for node, text in found:
            for key in low(node):
                size[key] = size.get(key, 0) + len(text)
        go = {key for key, n in size.items() if n < half}
        found = [x for x in found if go.isdisjoint(low(x[0]))]
    kept = []
    for node, text in found:
        header = any(above.tag == "header" for above in chain(node))
        if not header or any(above.tag in _HEADINGS for above in chain(node)):
            kept.append(text)
    return "\n".join(kept)


def host(url: str = "url") -> Column:
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)


def style_nodes(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, page, node, place, contents, shapes)``: a row per page and style node.

    ``node`` is a key of the host and the place in its pages, ``page`` one of the html.
    """

    @F.arrow_udf("array<struct<node: bigint, contents: array<bigint>, shapes: array<bigint>>>")
    def parsed(pages: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("node", pa.int64()), ("contents", pa.list_(pa.int64())), ("shapes", pa.list_(pa.int64()))]))
        return pa.array(
            [[{"node": k, "contents": sorted(c), "shapes": sorted(s)} for k, (c, s) in features(p.as_py() or "").items()] for p in pages],
            kind,
        )

    same = F.xxhash64(F.col(html)).alias("page")
    rows = pages.select(F.col(page_id).alias("page_id"), host(url).alias("host"), same, F.explode(parsed(html)).alias("n"))
    return rows.select("page_id", "page", F.xxhash64("host", "n.node").alias("node"), F.col("n.node").alias("place"), "n.contents", "n.shapes")


def importance(nodes: DataFrame, gamma: float = GAMMA, prior: float = PRIOR) -> DataFrame:
    """``(node, m, importance)`` of the merged style nodes of ``m`` different pages.

    Features are counted within tasks first, so a host with a third of all pages
    is no larger after it than one with few.
    """
    nodes = nodes.dropDuplicates(["node", "page"])
    m = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("m"))

    def pages_with(kind: str) -> DataFrame:
        return nodes.select("node", F.explode(kind).alias("f")).groupBy("node", "f").agg(F.count(F.lit(1)).alias("n"))

    contents = pages_with("contents").groupBy("node").agg(F.count(F.lit(1)).alias("l"), F.sum(F.log("n")).alias("logs"))
    shapes = pages_with("shapes").groupBy("node").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    base = F.log(F.greatest(F.col("m"), F.lit(2)))
    content = F.when(F.col("m") > 1, 1 - F.coalesce(F.col("logs") / base / F.col("l"), F.lit(0.0))).otherwise(1.0)
    entropy = F.log("all") - F.col("nlogn") / F.col("all")
    shape = F.when(F.col("m") > 1, F.least(F.lit(1.0), entropy / base)).otherwise(1.0)
    weight = F.pow(F.lit(gamma), F.coalesce("l", F.lit(0)))
    joined = m.join(contents, "node", "left").join(shapes, "node")
    # Much content: what it says counts; little content: how it looks counts too.
    composite = (1 - weight) * content + weight * (content + shape) / 2
    drawn = (F.col("m") * composite + prior) / (F.col("m") + prior)
    return joined.select("node", "m", drawn.alias("importance"))


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    threshold: float = IMPORTANCE,
) -> DataFrame:
    """``pages`` with ``main_text`` (in place of a column of that name); rows with
    equal ids share what is unimportant."""
    nodes = written(style_nodes(pages, page_id, url, html), "style-nodes")
    low = written(importance(nodes).where(F.col("importance") < threshold), "style-tree").select("node", F.lit(True).alias("low"))
    shares = nodes.join(low, "node", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("share"))
    facts = written(low.join(shares, "node"), "unimportant")
    marked = join_unique(nodes.select("page_id", "place", "node"), facts, "node", "share").where("low")
    noise = written(marked.groupBy("page_id").agg(F.collect_set("place").alias("_noise")), "noise")

    @F.arrow_udf("string")
    def extracted(pages: pa.Array, noise: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", set(n.as_py() or ())) for p, n in zip(pages, noise)], pa.string())

    rows = pages.select(whole(pages), F.col(page_id).alias("_page"), F.col(html).alias("_html"))
    found = rows.join(noise, F.col("_page") == F.col("page_id"), "left")
    return found.select("_whole", extracted("_html", "_noise").alias("_text")).select(
        *[F.col(f"_whole.`{name}`") for name in pages.columns if name != "main_text"], F.col("_text").alias("main_text")
    )
