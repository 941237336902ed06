"""Main text of web pages by composite text density.

A page becomes a tree; scripts, forms and hidden parts leave it first, then containers whose whole class name or id
marks them as navigation, advert, notice or comments, unless they hold the main subtree or most of the body's
text outside links. Each node's composite density is its characters per tag, adjusted by the share of
link characters and link tags in it and in the body. The node whose children's densities sum to most
is the main subtree. The least density on the path from the body to it is the threshold: every subtree
that reaches it is kept around its own node of largest sum, with a heading right before it. Composite density grows with a
node's size, so subtrees that are not mostly links may reach the threshold in plain characters per tag too.
Blocks inside that are mostly links and fall below it are left out.

Blocks are the runs of text between block-level tags. Character references are decoded, white space
inside a block becomes one space, blocks are joined by an empty line.

Defined results: null and empty pages, and pages without text, give the empty text. Unclosed tags,
stray end tags and comments that never end are read as a browser does: they close with their parent,
are skipped, and run to the end.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed

# Tags by their role, and words of class, id and role that mark other parts than the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("script style noscript iframe template svg canvas object embed form button select textarea input nav aside footer menu dialog head title link meta map audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body center div fieldset figure main section table td".split())
CLOSES = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "option": frozenset({"option", "optgroup"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "thead": frozenset({"tbody", "tfoot"}),
    "tbody": frozenset({"tbody", "tfoot"}),
    "head": frozenset({"body"}),
}
SCOPE = {"li": frozenset({"ul", "ol", "menu", "dir"}), "td": frozenset({"table"}), "th": frozenset({"table"}), "tr": frozenset({"table"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"})}
OTHER_PARTS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored sponsors promo promos promotion promoted
    menu menus nav navbar navigation navi breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer foot masthead topbar toolbar
    notice notices alert cookie cookies consent gdpr popup modal overlay paywall newsletter subscribe subscription signup login
    comment comments commentlist disqus replies respond reply share sharing social related recommended recommendations widget widgets copyright disclaimer""".split()
)
OUTSIDE_ARTICLE = frozenset({"header"})
UNMARKED = HEADINGS | frozenset("html body article main p blockquote pre".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar toolbar form".split())

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+))|([^\s=/\"'>]+)")


class Page:
    """A page's nodes in document order, by lists; node 0 is the root. `events`: text strings, node numbers at their begin, and -1 - number at their end."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attributes, self.events = ["#root"], [-1], [""], []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        while at < n:
            m = _TAG.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self._close(stack, name)
                continue
            while len(stack) > 1 and self._implied(stack, name):
                self._pop(stack)
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attributes.append(m[3] or "")
            self.events.append(node)
            if name in VOID:
                self.events.append(-1 - node)
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                if name == "textarea" or name == "title":
                    self._text(source[at : end.start() if end else n])
                self.events.append(-1 - node)
                at = end.end() if end else n
                continue
            stack.append(node)
        while len(stack) > 1:
            self._pop(stack)

    def _text(self, raw: str) -> None:
        self.events.append(html.unescape(raw) if "&" in raw else raw)

    def _pop(self, stack: list[int]) -> None:
        self.events.append(-1 - stack.pop())

    def _implied(self, stack: list[int], name: str) -> bool:
        """Whether the innermost open node ends before a tag `name` begins: it or a node around it must, and no block in between."""
        for node in reversed(stack[1:]):
            tag = self.tag[node]
            if name in CLOSES.get(tag, ()):
                return True
            if tag in SCOPE.get(name, ()) or (tag in BLOCK and tag not in CLOSES):
                return False
        return False

    def _close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == name:
                while len(stack) > k:
                    self._pop(stack)
                return
            if tag in ("table", "article", "body") and name not in BLOCK:
                return


def _is_other(page: Page, node: int, in_article: bool) -> bool:
    tag = page.tag[node]
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not page.attributes[node] or tag in ("html", "body", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(page.attributes[node]):
        name, value = (m[1] or m[5]).lower(), (m[2] or m[3] or m[4] or "").lower()
        if (name == "role" and value.strip() in OTHER_ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return True
    return False


def _is_marked(page: Page, node: int, in_article: bool) -> bool:
    """Whether a whole class name or the id says that this is another part. Paragraphs and headings are never parts of their own."""
    if not page.attributes[node] or page.tag[node] in UNMARKED:
        return False
    for m in _ATTRIBUTE.finditer(page.attributes[node]):
        if (m[1] or m[5]).lower() in ("class", "id"):
            names = set(html.unescape(m[2] or m[3] or m[4] or "").lower().split())
            if names & OTHER_PARTS or (not in_article and names & OUTSIDE_ARTICLE):
                return True
    return False


def _kept(page: Page) -> list[bool]:
    kept, article, marked = [True], [False], [False]
    for node in range(1, len(page.tag)):
        up = page.parent[node]
        article.append(article[up] or page.tag[node] in ("article", "main"))
        kept.append(kept[up] and not _is_other(page, node, article[node]))
        marked.append(kept[node] and _is_marked(page, node, article[node]))
    if any(marked):
        main = _holding_text(page, kept, article, marked)
        for node in range(1, len(kept)):
            kept[node] = kept[node] and kept[page.parent[node]] and (not marked[node] or main[node])
    return kept


def _holding_text(page: Page, kept: list[bool], article: list[bool], marked: list[bool]) -> list[bool]:
    """Nodes that hold the node of largest sum, or most of the body's text outside links. If an article has text outside its own marked parts, that node is sought there."""
    density, linked, plain = densities(page, kept)
    sums = _sums(page, kept, density)
    n = len(kept)
    under = [False] * n
    for node in range(1, n):
        under[node] = page.tag[node] not in ("article", "main") and (marked[node] or under[page.parent[node]])
    own = [k for k in range(n) if article[k] and not under[k] and density[k] > 0]
    main = [False] * n
    node = max(own or range(n), key=lambda k: (sums[k], -k))
    while node >= 0:
        main[node] = True
        node = page.parent[node]
    if not own:
        tags = [0] * n
        for node in range(n - 1, 0, -1):
            if kept[node]:
                tags[page.parent[node]] += tags[node] + 1
        free = [p * max(1, t) * (1 - share) for p, t, share in zip(plain, tags, linked, strict=True)]
        body = next((k for k in range(n) if page.tag[k] == "body"), 0)
        main = [held or f > free[body] / 2 for held, f in zip(main, free, strict=True)]
    return main


def densities(page: Page, kept: list[bool]) -> tuple[list[float], list[float], list[float]]:
    """Composite density of each node, the share of link characters in it, and its characters per tag."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = in_link[page.parent[node]] or page.tag[node] == "a"
    open_nodes = [0]
    for e in page.events:
        if isinstance(e, str):
            node = open_nodes[-1]
            if kept[node]:
                size = len(" ".join(e.split()))
                chars[node] += size
                links[node] += size * in_link[node]
        elif e >= 0:
            open_nodes.append(e)
        else:
            open_nodes.pop()
    for node in range(n - 1, 0, -1):
        if kept[node]:
            up = page.parent[node]
            chars[up] += chars[node]
            links[up] += links[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (page.tag[node] == "a")
    body = next((k for k in range(n) if page.tag[k] == "body"), 0)
    ratio = links[body] / max(1, chars[body])
    out = []
    for c, lc, t, lt in zip(chars, links, tags, link_tags, strict=True):
        if not c:
            out.append(0.0)
            continue
        base = math.log(c / max(1, c - lc) * lc + ratio * c + math.e)
        out.append(c / max(1, t) * math.log(max(c / max(1, lc) * max(1, t) / max(1, lt), 1.0)) / math.log(max(base, 1 + 1e-9)))
    return out, [lc / c if c else 0.0 for c, lc in zip(chars, links, strict=True)], [c / max(1, t) for c, t in zip(chars, tags, strict=True)]


def _sums(page: Page, kept: list[bool], density: list[float]) -> list[float]:
    sums = [0.0] * len(density)
    for node in range(1, len(density)):
        if kept[node]:
            sums[page.parent[node]] += density[node]
    return sums


def _container(page: Page, inside: list[int]) -> int:
    """The node to keep of a path from a node up: a paragraph or a heading is a part of its container; an article is one, whatever its densest part."""
    top = next((k for k in inside if page.tag[k] in CONTAINERS), inside[-1])
    return next((k for k in reversed(inside) if page.tag[k] in ("article", "main")), top)


def _reaching(page: Page, sums: list[float], reaches: list[bool], top: int, body: int) -> set[int]:
    """`top`, and the container of the node of largest sum in each subtree of the body that reaches the threshold and has none yet."""
    n = len(sums)
    largest = list(range(n))
    for node in range(n - 1, 0, -1):
        up, own = page.parent[node], largest[node]
        if (sums[own], -own) > (sums[largest[up]], -largest[up]):
            largest[up] = own
    tops, within, inside = {top}, [top == 0] * n, [body == 0] * n
    for node in range(1, n):
        inside[node] = node == body or inside[page.parent[node]]
        within[node] = node in tops or within[page.parent[node]]
        if within[node] or not (inside[node] and reaches[node]):
            continue
        path = [largest[node]]
        while path[-1] != node and path[-1] not in tops:
            path.append(page.parent[path[-1]])
        if path[-1] not in tops:
            tops.add(_container(page, path))
            within[node] = node in tops
    return tops


def _with_headings(page: Page, kept: list[bool], tops: set[int]) -> set[int]:
    """Adds headings that stand right before a kept node."""
    last: dict[int, int] = {}
    out = set(tops)
    for node in range(1, len(kept)):
        up = page.parent[node]
        if node in tops and page.tag[last.get(up, 0)] in HEADINGS:
            out.add(last[up])
        if kept[node]:
            last[up] = node
    return out


def extract(source: str | None) -> tuple[str, str]:
    """Text of a page's kept subtrees, and the main one's path of tags."""
    if not source:
        return "", ""
    page = Page(source)
    kept = _kept(page)
    density, linked, plain = densities(page, kept)
    sums = _sums(page, kept, density)
    best = max(range(len(sums)), key=lambda k: (sums[k], -k))
    path, node = [], best
    while node >= 0:
        path.append(node)
        node = page.parent[node]
    body = next((k for k in path if page.tag[k] == "body"), 0)
    inside = path[: path.index(body) + 1]
    threshold, plain_threshold = min(density[k] for k in inside), min(plain[k] for k in inside)
    # composite density of a few words without links and tags is as high as that of an article: they count by characters per tag only
    reaches = [k and d > 0 and ((d >= threshold and own > 0) or (p >= plain_threshold and share <= 0.5)) for k, d, p, share, own in zip(kept, density, plain, linked, sums, strict=True)]
    tops = _with_headings(page, kept, _reaching(page, sums, reaches, _container(page, inside), body))
    blocks, run, within, skip = [], [], 0, 0

    def end_block() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    for e in page.events:
        if isinstance(e, str):
            if (within or 0 in tops) and not skip:
                run.append(e)
            continue
        node = e if e >= 0 else -1 - e
        if page.tag[node] in BLOCK:
            end_block()
        elif page.tag[node] == "br":
            run.append(" ")
        left_out = not kept[node] or (page.tag[node] in BLOCK and linked[node] > 0.5 and density[node] < threshold)
        if e >= 0:
            within += node in tops or within > 0
            skip += left_out or skip > 0
        else:
            within -= within > 0
            skip -= skip > 0
    end_block()
    return "\n\n".join(blocks), "/".join(page.tag[k] for k in reversed(path))


def main_text(pages: DataFrame, source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Column `row` with the page's columns (`keep`: only these), and text and path."""
    rows = packed(pages, keep, html=F.col(f"`{source}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [extract(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t for t, _ in found], pa.string()), pa.array([p for _, p in found], pa.string())], names=["row", "text", "path"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, path string")
