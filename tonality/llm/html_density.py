"""Main text of web pages by composite text density.

Every DOM node gets a density: its characters per tag, weighed down by the
share of characters and tags that are links.  A node's density sum adds up
its children's densities; the node with the largest sum is the core of the
article, and the least density on the path from the page's root to it is the
threshold that other parts of the article must reach.

The whole body is searched: every subtree that reaches the threshold stays,
and so does text that stands directly in a node on the path.  Where the core
lies in an ``article`` or ``main``, that element stays whole; it takes nothing
from the search outside it.  A heading stays with the part it precedes.

Elements that are furniture by their tag, role or class name (menus, page
headers and footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments) are left out before densities are computed.  Class names and
ids count as whole names, and a name alone takes out no subtree with most of
the text, unless the page marks its article (``article``, ``main``, or ``h1``
with paragraphs) outside that subtree.  The same holds for ``form`` and
``header``, which some pages put round everything; one that holds the page's
only ``article`` or ``main`` stays whatever its share, and so does the
``header`` of an article that holds a heading.  A ``noscript`` counts only if
it has more text than the page outside of such elements, or the only
``article`` or ``main``.  A part headed as
reader comments ("3 comments") goes if the article is marked outside it or it
holds at most half of the text.

The text is one line a block, in page order, joined by an empty line; white
space within a block becomes one space; character references are decoded.
A null or empty page, or one without text, gives an empty text; pages of any
length are read whole; repeated rows and null keys are kept as they are.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tonality.llm.common import clean_strings, workers_import

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav noscript ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("""applet aside audio button canvas datalist dialog footer head iframe map menu nav object
    option script select style svg template textarea title video""".split())
#: furniture that some pages put round their article
WRAPPERS = frozenset(["form", "header"])
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NAMES = frozenset("""ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs byline
    comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation
    newsletter notice notices outbrain pager pagination paywall popup promo promoted promotion recommended related
    respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar
    widget widgets ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper banner-ad comment-form comment-list
    comment-respond comments-area comments-list comments-section consent-banner cookie-banner cookie-bar
    cookie-consent cookie-notice disqus-thread footer-links footer-nav gdpr-banner global-nav header-nav left-sidebar
    login-form main-menu main-nav main-navigation nav-bar nav-links nav-menu newsletter-form newsletter-signup
    page-footer page-header post-navigation primary-nav primary-sidebar promo-box recommended-articles
    recommended-posts related-articles related-content related-links related-posts right-sidebar secondary-sidebar
    share-bar share-buttons share-links sidebar-left sidebar-right sign-up site-footer site-header site-nav
    site-navigation skip-link skip-to-content social-icons social-links social-media social-share sponsored-content
    top-bar top-nav""".split())
NEVER_FURNITURE = frozenset(["html", "body", "article", "main"])
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: a start tag that ends an open element: tag -> (elements it ends, elements that shield them)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)"                                                      # comment
    r"|<(?P<raw>script|style|textarea|title|xmp|iframe|noscript|template)\b(?P<open>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>)"
    r"(?:.*?</(?P=raw)\b[^>]*>|.*\Z)"                                           # raw text up to its end tag
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?:/?[a-zA-Z]|[!?])[^>]*(?:>|\Z)",                                      # declarations, broken or cut tags
    re.S | re.I)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NUMBER = re.compile(r"[-_]*\d+\Z")
#: headings of reader comments
_COMMENTS = re.compile(
    r"(?:(?:\d[\d.,]*|no|all|show|view|hide|see|read|top|recent|latest|new|readers?['\u2019]?s?|users?|visitors?|your"
    r"|leave an?|post an?|add an?|write an?)\s+)*(?:comments?|kommentare?|commentaires?|comentarios?|commenti)\W*\d*\W*"
    r"|leave a reply|\d[\d.,]*\s+(?:replies|responses|reactions|thoughts? on\b.*)", re.I)
COMMENTS_CHARS = 80       # a heading longer than this is none of comments
COMMENTS_LISTS = frozenset("details div dl form ol section ul".split())


def furniture(tag: str, attrs: str) -> str:
    """``sure`` (by tag, role or hidden), ``wrapper``, ``name`` (only by a class name or id) or empty."""
    if tag in FURNITURE:
        return "sure"
    if not attrs or tag in NEVER_FURNITURE:
        return "wrapper" if tag in WRAPPERS else ""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(attrs):
        found.setdefault(name.lower(), (a or b or c).lower())
    role = found.get("role", "").strip()
    if "hidden" in found or found.get("aria-hidden") == "true" or role in ROLES - {"form", "banner"}:
        return "sure"
    if tag in WRAPPERS or role in ROLES:
        return "wrapper"
    for value in (found.get("class", ""), found.get("id", "")):
        for word in value.split():
            if _NUMBER.sub("", word).replace("_", "-") in NAMES:
                return "name"
    return ""


class Node:
    __slots__ = ("tag", "up", "parts", "chars", "link_chars", "tags", "link_tags", "density", "total", "path_min",
                 "furniture", "foreign", "has_blocks")

    def __init__(self, tag: str, up: "Node | None", furniture: str = ""):
        self.tag, self.up, self.furniture = tag, up, furniture
        self.foreign = tag in ("svg", "math") or (up is not None and up.foreign)
        self.parts: list = []          # texts, child nodes and block boundaries (None), in page order
        self.chars = self.link_chars = self.tags = self.link_tags = 0


class Path:
    """The open elements, with the depths at which each tag is open, so that no end tag is searched for."""

    def __init__(self, body: Node):
        self.nodes = [body]
        self.depths: dict[str, list[int]] = {}

    @property
    def here(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node):
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def depth(self, tags) -> int:
        """Depth of the innermost open element of these tags; 0 (the body) if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def close(self, depth: int):
        """Closes the element at this depth and all inside it; the body stays open."""
        while depth and len(self.nodes) > depth:
            self.depths[self.nodes.pop().tag].pop()

    def content(self, found):
        """Content ends a head whose end tag is left out."""
        if found and self.here.tag == "head":
            self.close(len(self.nodes) - 1)

    def starts(self, tag: str):
        """Closes what a start tag closes: an open paragraph before a block, a list item before the next."""
        if tag in BLOCKS:
            self.close(self.depth(["p"]))          # a paragraph never holds a block, so this one is the innermost
        if tag in ENDS:
            ended, shields = ENDS[tag]
            depth = self.depth(ended)
            if depth > self.depth(shields):
                self.close(depth)


def parse(page: str) -> Node:
    """The page's tree without furniture; forgiving as browsers are about missing end tags."""
    root = Node("html", None)
    body = Node("body", root)
    root.parts.append(body)
    path = Path(body)
    outside = None                 # text and articles outside of all noscript elements, once needed
    pos = 0
    marks = _MARKUP.finditer(page)
    while (m := next(marks, None)) is not None:
        if m.start() > pos:
            path.content(page[pos:m.start()].strip())
            path.here.parts.append(page[pos:m.start()])
        pos = m.end()
        tag = m["tag"]
        if (m["raw"] or "").lower() == "noscript":
            start = m.end("open")
            inside = _text_and_articles(page[start:m.end()])
            if not inside[0]:
                continue
            outside = outside or _text_and_articles(page)
            if inside[0] > outside[0] or inside[1] and not outside[1]:
                path.content(True)
                path.starts("noscript")
                node = Node("noscript", path.here)
                path.here.parts.append(node)
                path.push(node)
                pos, marks = start, _MARKUP.finditer(page, start)      # read on inside it
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            path.close(path.depth([tag]))
            continue
        path.content(tag not in IN_HEAD)
        if tag in ("html", "body"):
            continue
        path.starts(tag)
        here = path.here
        if tag in VOID:
            here.parts.append(" " if tag == "br" else Node(tag, here))
            continue
        node = Node(tag, here, furniture(tag, m["attrs"]))
        here.parts.append(node)
        if not (m["attrs"].endswith("/") and (node.foreign or node.furniture)):
            path.push(node)
    if pos < len(page):
        path.here.parts.append(page[pos:])
    prune(body)
    return root


def _text_and_articles(markup: str) -> tuple[int, bool]:
    """Characters of text, and whether there is an ``article`` or ``main``; not counting noscript elements."""
    pos = chars = 0
    found = False
    for m in _MARKUP.finditer(markup):
        chars += len("".join(markup[pos:m.start()].split()))
        found = found or (m["tag"] or "").lower() in ("article", "main")
        pos = m.end()
    return chars + len("".join(markup[pos:].split())), found


def prune(body: Node) -> None:
    """Puts block boundaries in place of furniture."""
    order, todo = [], [body]
    while todo:
        node = todo.pop()
        order.append(node)
        node.parts = [None if isinstance(p, Node) and p.furniture == "sure" else p for p in node.parts]
        todo += [p for p in node.parts if isinstance(p, Node)]
    size: dict[Node, int] = {}
    nodes: dict[Node, int] = {}
    headed: dict[Node, bool] = {}
    for node in reversed(order):
        inner = [p for p in node.parts if isinstance(p, Node)]
        size[node] = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(size[p] for p in inner)
        nodes[node] = 1 + sum(nodes[p] for p in inner)
        headed[node] = bool(node.tag in HEADINGS and size[node]) or any(headed[p] for p in inner)
    _mark_headers(order, headed)
    _mark_comments(order, size, nodes)
    if not any(n.furniture for n in order):
        return
    rest: dict[Node, int] = {}            # the size without marked parts inside
    marks: dict[Node, list[int]] = {}     # articles, first headings and paragraphs, without those of marked parts inside
    for node in reversed(order):
        inner = [p for p in node.parts if isinstance(p, Node)]
        rest[node] = size[node] - sum(size[p] if p.furniture else size[p] - rest[p] for p in inner)
        own = [node.tag in ("article", "main"), node.tag == "h1", node.tag == "p"] if rest[node] else [0, 0, 0]
        marks[node] = [sum(x) for x in zip(own, *[marks[p] for p in inner if not p.furniture])]
    article = lambda m: bool(m[0] or (m[1] and m[2]))
    work = [(body, bool(marks[body][0]), article(marks[body]))]
    while work:
        node, element, outside = work.pop()        # whether the page marks its article outside of the parts
        for i, p in enumerate(node.parts):
            if not isinstance(p, Node):
                continue
            inner = element, outside
            if p.furniture:
                inside = article(marks[p])
                goes = 2 * size[p] <= size[body] or (outside and (not inside or p.furniture == "comments"))
                if p.furniture == "wrapper" and marks[p][0] and not element:
                    goes = False
                if goes:
                    node.parts[i] = None
                    continue
                inner = bool(marks[p][0]) or element, inside or outside
            work.append((p, *inner))


def _mark_headers(order: list[Node], headed: dict[Node, bool]) -> None:
    """The header of an article that holds a heading is no furniture."""
    within: dict[Node, bool] = {}
    for node in order:
        within[node] = node.tag in ("article", "main") or within.get(node.up, False)
        if node.tag == "header" and node.furniture == "wrapper" and within[node] and headed[node]:
            node.furniture = ""


def _mark_comments(order: list[Node], size: dict[Node, int], nodes: dict[Node, int]) -> None:
    """Marks parts that a heading of reader comments begins, and lists right behind such a heading."""
    says: set[Node] = set()          # headings of comments, and nodes that hold nothing but one
    for node in reversed(order):
        if 0 < size[node] <= COMMENTS_CHARS and nodes[node] <= COMMENTS_CHARS:
            if node.tag in HEADINGS:
                if _COMMENTS.fullmatch(" ".join(blocks(node))):
                    says.add(node)
            elif any(isinstance(p, Node) and p in says and size[p] == size[node] for p in node.parts):
                says.add(node)
    if not says:
        return
    for node in order:
        first, heading = True, None
        for p in node.parts:
            if p is None or (not p.strip() if isinstance(p, str) else not size[p]):
                continue
            if isinstance(p, str):
                heading = None
            elif p in says:
                if first and node.tag not in NEVER_FURNITURE:
                    node.furniture = "comments"
                    break
                heading = p
            elif heading is not None and p.tag in COMMENTS_LISTS:
                heading.furniture = p.furniture = "comments"
            else:
                heading = None
            first = False


def density(chars: int, link_chars: int, tags: int, link_tags: int, link_share: float) -> float:
    """Characters per tag, weighed by how little of the node is links (``link_share``: the body's own)."""
    if not chars:
        return 0.0
    purity = math.log(chars * max(1, tags) / (max(1, link_chars) * max(1, link_tags)))
    base = math.log(chars * link_chars / max(1, chars - link_chars) + link_share * chars + math.e ** 2)
    return chars / max(1, tags) * purity / math.log(base)


def measure(root: Node) -> list[Node]:
    """Fills counts and densities bottom-up; returns all nodes, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    for node in reversed(order):
        for p in node.parts:
            if isinstance(p, Node):
                node.chars += p.chars
                node.link_chars += p.link_chars
                node.tags += p.tags + 1
                node.link_tags += p.link_tags + (p.tag == "a")
            elif p:
                node.chars += len("".join(p.split()))
        if node.tag == "a":
            node.link_chars = node.chars
        node.has_blocks = any(p is None or isinstance(p, Node) and (p.tag in BLOCKS or p.has_blocks) for p in node.parts)
    body_share = root.link_chars / max(1, root.chars)
    for node in reversed(order):
        node.density = density(node.chars, node.link_chars, node.tags, node.link_tags, body_share)
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
        if not any(isinstance(p, Node) for p in node.parts):
            node.total = node.density
    return order


def select(root: Node) -> list:
    """What stays, in page order: subtrees, and runs (lists) of text and inline nodes.

    These are the maximum-sum subtree (its whole ``article`` or ``main``) and
    all that reaches the path's threshold anywhere in the body.
    """
    order = measure(root)
    if not root.chars:
        return []
    for node in order:
        above = node.up.path_min if node.up else math.inf
        node.path_min = min(above, node.density)
    best = max((n for n in order if n.tag in BLOCKS), key=lambda n: n.total)
    threshold = best.path_min
    path = []
    node = best
    while node is not None:
        path.append(node)
        node = node.up
    core = next((n for tag in ("article", "main") for n in path if n.tag == tag), best)
    above = set(path[path.index(core) + 1:])
    chosen: list = []
    headings: list = []                 # those right before the next part
    todo: list = [(root, False)]        # nodes and runs; whether a run stands directly on the path
    while todo:
        p, direct = todo.pop()
        if isinstance(p, list):
            chars = sum(len("".join(x.split())) if isinstance(x, str) else x.chars for x in p)
            nodes = [x for x in p if isinstance(x, Node)]
            stays = chars and (
                direct and any(c.isalnum() for x in p if isinstance(x, str) for c in x)
                or density(chars, sum(n.link_chars for n in nodes), sum(n.tags + 1 for n in nodes),
                           sum(n.link_tags + (n.tag == "a") for n in nodes),
                           root.link_chars / root.chars) >= threshold)
        else:
            chars = p.chars
            stays = p is core or (chars and p not in above and p.density >= threshold)
        if stays:
            chosen += [*headings, p]
            headings = []
        elif not chars:
            continue
        elif not isinstance(p, list) and p.tag in HEADINGS and p not in above:
            headings.append(p)
        elif not isinstance(p, list) and (p in above or p.has_blocks):
            todo += [(x, p in above) for x in reversed(_runs(p))]
        else:
            headings = []
    return chosen


def _runs(node: Node) -> list:
    """The node's parts, texts and inline nodes that stand together as one list."""
    out: list = []
    joined = False
    for p in node.parts:
        inline = isinstance(p, str) or (p is not None and p.tag not in BLOCKS and not p.has_blocks)
        if inline and joined:
            out[-1].append(p)
        elif p is not None:
            out.append([p] if inline else p)
        joined = inline
    return out


def blocks(node: Node | list) -> list[str]:
    """The texts of a subtree or run, one a block, in page order."""
    out: list[str] = []
    line: list[str] = []

    def close():
        if line:
            text = " ".join(html.unescape("".join(line)).split())
            if text:
                out.append(text)
            line.clear()

    todo: list = list(reversed(node)) if isinstance(node, list) else [node]
    while todo:
        p = todo.pop()
        if p is None:
            close()
        elif isinstance(p, str):
            line.append(p)
        else:
            block = p.tag in BLOCKS
            if block:
                close()
                todo.append(None)
            todo += reversed(p.parts)
    close()
    return out


def main_text(page: str) -> str:
    return "\n\n".join(b for n in select(parse(page)) for b in blocks(n))


def extract(pages: DataFrame, text: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns and ``text string``: each page's main text."""
    workers_import(pages.sparkSession)
    types = dict(pages.dtypes)
    schema = ", ".join([f"c{i} {types[k]}" for i, k in enumerate(keep)] + ["text string"])

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in clean_strings(b.column(b.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())],
                                             [*[f"c{i}" for i in range(len(keep))], "text"])

    out = pages.select(*[pages[f"`{k}`"] for k in keep], pages[f"`{text}`"]).mapInArrow(run, schema)
    return out.toDF(*keep, "text")
