"""Main text of web pages by the paths that a host's pages agree on.

Each page is read once into containers: their text, how much of it is in links, and the path of
tags and classes that leads to them, with numbers and the like generalised. A page's best container
votes for its path; votes are counted per host in Spark. Every page is then read again by its
host's winning paths, and by its own best container where none of them occurs.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import lookup, stored

#: Elements whose content is no text of the page (fixed values).
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object",
       "title", "select", "canvas", "audio", "video", "xmp", "noembed", "noframes"}
#: Elements read as plain characters up to their own end tag (fixed values).
LITERAL = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes",
           "noscript"}
#: Elements that hold what surrounds an article (fixed values).
ASIDE = {"nav", "footer", "aside", "form", "head", "header", "menu", "dialog", "button", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
#: Elements that run inside a block of text; all others begin and end one (fixed values).
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "wbr"}
#: Open elements that a start tag ends, as browsers do (fixed values).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
            "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
          "th": {"table"}, "option": {"select"}}
#: Words of classes, ids and roles that name what is not the article (a parameter).
NOISE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie",
    "cookies", "copyright", "dialog", "disclaimer", "disqus", "footer", "gdpr", "header", "login",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay",
    "pagination", "pager", "popup", "promo", "promotion", "recommended", "related", "replies",
    "reply", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "tags", "toolbar", "topbar", "widget", "widgets",
}
#: Words that name an article (a parameter).
GOOD = {"article", "body", "content", "entry", "main", "post", "story", "text"}

#: Elements that a page is divided into (fixed values).
BOXES = {"html", "body", "div", "section", "article", "main", "table", "center"}

#: Words before a noise word that say what an element has or lacks (fixed values).
STATES = {"no", "not", "has", "have", "with", "without", "hide", "is"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
    re.I,
)
_NAMES = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass(eq=False)
class Node:
    """An open or closed element with its path and the text seen in it."""

    tag: str
    path: str
    parent: Node | None
    noise: bool
    good: bool
    suspect: bool = False
    holds: bool = False
    blocks: list[list[str]] = field(default_factory=list)
    linked: int = 0
    size: int = 0


def attributes(raw: str) -> tuple[list[tuple[str, str]], bool]:
    """Values of class, id and role; whether the element is hidden."""
    names, hidden = [], False
    for name, value in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            names.append((name, value))
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value == "true"
        else:
            hidden |= "display:none" in value.replace(" ", "")
    return names, hidden


def general(tag: str, names: list[tuple[str, str]]) -> str:
    """A step of a path: the tag with its classes, digits and what they are part of left out."""
    if not names:
        return tag
    classes = sorted(
        {c for n, value in names if n == "class" for c in value.split() if not re.search(r"\d", c)}
    )
    return ".".join([tag, *classes])


def suspicious(names: list[tuple[str, str]]) -> bool:
    """Whether classes, ids or roles name an element as noise.

    A name may say so in part, unless it tells what an element has or lacks, heads an article, or
    stands beside a whole name of an article.
    """
    named = [c for _, value in names for c in value.split()]
    if any(c in NOISE for c in named):
        return True
    if any(c in GOOD for c in named):
        return False
    for c in named:
        parts = _NAMES.findall(c)
        if parts and parts[-1] == "header" and GOOD & set(parts):
            continue
        if NOISE & set(parts) and not STATES & set(parts):
            return True
    return False


def containers(page: str | None) -> list[Node]:
    """The elements of a page that hold its text, see ``read``.

    Names alone never silence an element that holds an article or, on a page that has none outside,
    most of the text outside links.
    """
    pardoned: set[int] = set()
    while True:
        nodes, suspects, plain = read(page, pardoned)
        article = any(n.tag in ("article", "main") and n.size for n in nodes)
        more = {
            k
            for k, n in enumerate(suspects)
            if k not in pardoned and not article and (n.holds or 2 * (n.size - n.linked) > plain)
        }
        if not more:
            return nodes
        pardoned |= more


def read(page: str | None, pardoned: set[int]) -> tuple[list[Node], list[Node], int]:
    """The elements of a page that hold text of their own blocks, in order; the page is the first.

    Also the elements that their names make noise, unless ``pardoned`` by number, and the size of the
    text outside links, theirs included. Text inside noise and raw elements is in no container. A block's pieces are kept by the nearest
    block element; ``blocks`` of a container are those of all elements inside it, in page order.
    """
    root = Node("", "", None, False, False)
    nodes, stack = [root], [root]
    block: list[str] | None = None
    quiet = links = doubt = plain = 0
    suspects: list[Node] = []
    page, at = page or "", 0

    def text(piece: str) -> None:
        nonlocal block, plain
        if quiet:
            return
        plain += len(piece.strip()) * (links == 0)
        if doubt:
            for n in stack:
                if n.suspect:
                    n.size += len(piece.strip())
                    n.linked += len(piece.strip()) * (links > 0)
            return
        if "&" in piece:
            piece = html.unescape(piece)
        if block is None:
            if not piece.strip():
                return
            block = []
            for n in stack:
                n.blocks.append(block)
        block.append(piece)
        size = len(piece.strip())
        link = links > 0
        for n in stack:
            n.size += size
            n.linked += size * link

    def close(depth: int) -> None:
        nonlocal block, quiet, links, doubt
        for n in stack[depth:]:
            quiet -= n.noise and not n.suspect
            doubt -= n.suspect
            links -= n.tag == "a"
            if n.tag not in INLINE:
                block = None
        del stack[depth:]

    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            text(page[at:])
            return nodes, suspects, plain
        if tag.start() > at:
            text(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name == "p" and not any(n.tag == "p" for n in stack):
                block = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    close(k)
                    break
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if name in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[name]:
                    close(k)
                    break
                if stack[k].tag in SCOPES[name]:
                    break
        if name not in INLINE:
            block = None
        elif name == "br" and block is not None:
            block.append(" ")
        names, hidden = attributes(tag[3]) if tag[3].strip(" /") else ([], False)
        if name in LITERAL:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = len(page) if end is None else end.start()
        if name in VOID or (tag[3].endswith("/") and name in ("svg", "math")):
            continue
        words = {w for _, value in names for w in _NAMES.findall(value)} if names else set()
        parent = stack[-1]
        good = name in ("article", "main") or bool(words & GOOD)
        aside = name in ASIDE and not (name == "header" and inside(stack))
        noise = name in RAW or hidden or aside
        named = suspicious(names) if words & NOISE else False
        suspect = False
        if named and not noise and name not in ("html", "body", "article", "main"):
            suspect = len(suspects) not in pardoned
        path = f"{parent.path}>{general(name, names)}"
        node = Node(name, path, parent, noise or suspect, good, suspect)
        if named and not noise and name not in ("html", "body", "article", "main"):
            suspects.append(node)
        if name in ("article", "main") and not named and not quiet:
            for n in stack:
                n.holds = True
        stack.append(node)
        quiet += noise
        doubt += suspect
        links += name == "a"
        if name not in INLINE and not node.noise:
            nodes.append(node)


def inside(stack: list[Node]) -> bool:
    """Whether an article is open: its header belongs to it."""
    return any(n.tag in ("article", "main") for n in stack)


def score(node: Node) -> float:
    """How much a container looks like an article: text outside links, weighed by name."""
    plain = node.size - 2 * node.linked
    return plain * (1.5 if node.good else 1.0) * (1.0 + 0.3 * (node.tag in ("article", "main")))


def best(nodes: list[Node]) -> Node:
    """The container that scores best, or what it is part of or made of without loss.

    An outer container named as an article holds more of it, such as the title, unless links are
    most of that. An inner container is chosen instead only if all else are links, or, of a page
    as a whole, other boxes without the main heading.
    """
    top = max(nodes, key=score)
    while top.tag in ("", "html", "body"):
        parts = [n for n in nodes if n.parent is top and n.size and n.tag in BOXES]
        loose = top.size - top.linked - sum(n.size - n.linked for n in parts)
        main = next((n for n in parts if score(n) >= 0.9 * score(top)), None)
        titled = any(n.tag == "h1" and n.size and not within(n, main) for n in nodes) if main else True
        if loose or titled:
            break
        top = main
    outer = top.parent
    while outer is not None:
        more, links = outer.size - top.size, outer.linked - top.linked
        if outer.good and outer.tag not in ("html", "body") and more > 2 * links:
            top = outer
        outer = outer.parent
    for n in nodes[nodes.index(top) + 1 :] if top in nodes else ():
        if n.size and n.tag not in ("p", "li", "td") and within(n, top):
            if n.size - n.linked == top.size - top.linked:
                top = n
    return top


def within(node: Node, outer: Node) -> bool:
    while node.parent is not None and node is not outer:
        node = node.parent
    return node is outer


def text_of(chosen: list[Node]) -> str:
    """Blocks in page order, white space as one space, by two line ends; none twice."""
    seen: set[int] = set()
    out = []
    for node in chosen:
        for block in node.blocks:
            if id(block) in seen:
                continue
            seen.add(id(block))
            line = _SPACE.sub(" ", "".join(block)).strip()
            if line:
                out.append(line)
    return "\n\n".join(out)


def extract(page: str | None, paths: list[str] | None) -> str:
    nodes = containers(page)
    if len(nodes) == 1 and not nodes[0].size:
        return ""
    voted = set(paths or ())
    chosen = [n for n in nodes if n.path in voted and n.size]
    return text_of(chosen or [best(nodes)])


def host_paths(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """``(host, paths)``: the paths that at least ``share`` of a host's pages with text vote for.

    Votes are counted per host and path before they meet, so a host with a third of all pages is
    no more work for one task than any other; per host at most ``1 / share`` paths remain.
    """

    def vote(batches):
        for batch in batches:
            nodes = [containers(t.as_py()) for t in batch.column("html")]
            picked = [best(n) for n in nodes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    pa.array([p.path if p.size else None for p in picked], pa.string()),
                ],
                ["host", "path"],
            )

    votes = pages.select("host", "html").mapInArrow(vote, "host string, path string")
    counted = votes.where("path is not null").groupBy("host", "path").count()
    counted = stored(counted, "html-votes")
    whole = counted.groupBy("host").agg(F.sum("count").alias("all"))
    right = whole.withColumnRenamed("host", "_host")
    kept = counted.join(right, counted.host.eqNullSafe(right._host)).where(
        F.col("count") >= F.col("all") * share
    )
    return kept.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``: the article of each page, empty where there is none.

    A null ``html`` is an empty page; pages without a host in ``url`` are one host. Columns of the
    input named ``text``, ``host`` or ``paths`` are replaced.
    """
    plain = pages.drop("text", "host", "paths")
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    host = F.lower(F.regexp_extract("url", pattern, 1))
    hosted = plain.withColumn("host", F.coalesce(host, F.lit("")))
    agreed = stored(host_paths(hosted), "html-paths")
    columns = plain.columns
    joined = lookup(hosted, agreed, "host").select(*columns, "paths")

    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("html"), batch.column("paths").to_pylist(), strict=True)
            texts = [extract(t.as_py(), paths) for t, paths in pairs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*columns, "text"]
            )

    schema = ", ".join(f"`{c}` {kind}" for c, kind in plain.dtypes)
    return joined.mapInArrow(run, f"{schema}, text string")
