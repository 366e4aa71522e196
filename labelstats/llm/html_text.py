"""Main text of web pages by composite text density.

A page becomes a tree. Elements that are never article text (scripts, menus, forms, marked
adverts, comments and the like) go first. For every remaining node the characters per tag
are computed and adjusted by the share of link text; a node's sum is that of its children's
densities. The node with the largest sum leads: the least density on its path to the body
is the threshold, and from the body down every subtree that reaches it gives its own
largest-sum subtree. Where the page names its article (``article`` or ``main``), the search is
among articles: the one with the largest sum leads, and all that is left in it and in those
that reach the threshold of its path is the text, since a search inside would leave out
titles and short ends. Articles in a part named for readers' words beside the leading one,
and teasers, which have few characters per tag or are links for the most part, are no text.

Defined results: null, empty or tag-only html gives the empty text; unclosed and wrongly
nested tags are repaired as browsers do in simple cases; an article is never cut. Repeated
pages give repeated rows. Extra columns are not carried, so their names cannot clash.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import small_batches

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*\"|'[^']*')?|[\"'])*+)>"
    r"|<[!?/][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Element names of HTML and words that page authors give to such parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_TEXT = frozenset(
    "head script style noscript template iframe object embed svg canvas math audio video map "
    "nav footer aside button select option datalist input textarea dialog menu title "
    "xmp noembed noframes".split()
)
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th blockquote pre figure figcaption header footer nav aside form "
    "fieldset address details summary hr center hgroup search menu dialog".split()
)
CLOSES_P = BLOCK - frozenset("html body caption thead tbody tfoot tr td th li dt dd".split())
SAME_LEVEL = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select", "datalist"}),
}
NOT_TEXT_ROLE = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
COMMENT_WORD = frozenset("comment comments commentlist disqus respond replies".split())
BESIDE_WORD = frozenset("discussion feedback reactions responses".split())
NOT_TEXT_WORD = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors "
    "promo promoted promotion cookie cookies consent gdpr notice popup modal overlay newsletter "
    "subscribe subscription signup sidebar menu menus nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer masthead share sharing social related recommended "
    "recommendations toolbar skip login banner".split()
)


class Page:
    """Nodes in page order with parents before children, and the pieces of text."""

    def __init__(self) -> None:
        self.name = ["#page"]
        self.parent = [-1]
        self.dropped: list[int] = [PLAIN]
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self.beside: set[int] = set()  # parts named for readers' words, unless they hold the article

    def add(self, name: str, parent: int, dropped: int) -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.dropped.append(dropped)
        return len(self.name) - 1


#: How surely an element is not article text: not marked, by a word or as a form, which may mean
#: something else where the element holds most of the text, or surely.
PLAIN, WORDED, SURE = 0, 1, 2


def marked_as_other(name: str, attributes: str) -> int:
    """Whether names or attributes say that the element is not article text."""
    if name in NEVER_TEXT:
        return SURE
    worded = WORDED if name == "form" else PLAIN
    if not attributes or attributes.isspace() or name in ("html", "body", "main"):
        return worded
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes):
        return SURE
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        value, key = a or b or c, key.lower()
        if key in ("class", "id"):
            words = {w.lower() for w in WORD.findall(value)}
            if name == "article":  # may be the text, whatever else its name says
                worded = WORDED if words & COMMENT_WORD else worded
                continue
            if words & COMMENT_WORD:
                return SURE
            if words & NOT_TEXT_WORD or re.search(
                r"side-?bar|(?:site|page|top|global)-?header", value, re.IGNORECASE
            ):
                worded = WORDED
        elif (
            key == "role"
            and value.lower() in NOT_TEXT_ROLE
            or key == "aria-hidden"
            and value.lower() == "true"
            or key == "style"
            and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)
        ):
            return SURE
    return worded


def for_readers(attributes: str) -> bool:
    """Whether a class or id names the part as one for what readers say."""
    found = (a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes) if key.lower() in ("class", "id"))
    return any(w.lower() in BESIDE_WORD for value in found for w in WORD.findall(value))


def parse(page_html: str) -> Page:
    page, open_nodes, block, at = Page(), [0], 0, 0
    names, size = page.name, len(page_html)
    while at < size:
        found = TAG.search(page_html, at)
        start = found.start() if found else size
        if start > at:
            page.pieces.append((open_nodes[-1], block, page_html[at:start]))
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if not name:
            continue
        name = name.lower()
        if found.group(1):  # an end tag
            block += name in BLOCK
            for depth in range(len(open_nodes) - 1, 0, -1):
                above = names[open_nodes[depth]]
                if above == name:
                    del open_nodes[depth:]
                    break
                if name not in BLOCK and above in BLOCK:
                    break
            continue
        if name == "br":
            page.pieces.append((open_nodes[-1], block, " "))
        if name in CLOSES_P:
            for depth in range(len(open_nodes) - 1, 0, -1):
                above = names[open_nodes[depth]]
                if above == "p":
                    del open_nodes[depth:]
                if above in BLOCK:
                    break
        elif name in SAME_LEVEL:
            same, within = SAME_LEVEL[name]
            for depth in range(len(open_nodes) - 1, 0, -1):
                above = names[open_nodes[depth]]
                if above in same:
                    del open_nodes[depth:]
                    break
                if above in within:
                    break
        block += name in BLOCK
        other = marked_as_other(name, found.group(3) or "")
        node = page.add(name, open_nodes[-1], other)
        if found.group(3) and for_readers(found.group(3)):
            page.beside.add(node)
        if name in VOID or (found.group(3) or "").endswith("/") and name not in BLOCK | RAW:
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page_html, at)
            at = close.end() if close else size
            continue
        open_nodes.append(node)
    return page


def settle_dropped(page: Page) -> None:
    """Drop what stands below a dropped node. A node around a whole article stays, and so does
    one with more than half of the text of its article, or of a page without a named article,
    if only a word or the element ``form`` marks it."""
    names, parent, dropped = page.name, page.parent, page.dropped
    n = len(names)
    holds, surely, size = [False] * n, [False] * n, [0] * n
    around = [0] * n  # the innermost article or main with text that the node is in
    for i in range(1, n):
        surely[i] = surely[parent[i]] or dropped[i] == SURE
    for node, _, text in page.pieces:
        if not surely[node]:
            size[node] += len(text.strip())
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        if holds[i] or names[i] in ("article", "main") and size[i]:
            holds[parent[i]] = True
    for i in range(1, n):
        up = parent[i]
        around[i] = i if names[i] in ("article", "main") and size[i] else around[up]
        own = dropped[i] == SURE or names[i] == "header" and not around[i]
        if dropped[i] == WORDED:
            within = around[up] if names[i] == "article" else around[i]
            own = 2 * size[i] <= size[within] or names[i] != "article" and not within and holds[0]
        dropped[i] = dropped[up] or own and (names[i] in NEVER_TEXT or not holds[i])


def densities(page: Page) -> tuple[list[float], list[float], list[float]]:
    """Composite text density of each node, the sum over its children, its share of link text."""
    names, parent, dropped, n = page.name, page.parent, page.dropped, len(page.name)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[parent[i]] or names[i] == "a"
    for node, _, text in page.pieces:
        if not dropped[node]:
            size = len(text.strip())
            chars[node] += size
            if linked[node]:
                link_chars[node] += size
    for i in range(n - 1, 0, -1):
        if not dropped[i]:
            up = parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (names[i] == "a")
    share = link_chars[0] / chars[0] if chars[0] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c = chars[i]
        if dropped[i] or not c:
            continue
        t, lc, lt = max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        links = c / max(1, c - link_chars[i]) * link_chars[i] + share * c
        density[i] = c / t * math.log(c / lc * t / lt) / math.log(links + math.e)
        if i:
            total[parent[i]] += density[i]
    return density, total, [lc / c if c else 0.0 for lc, c in zip(link_chars, chars)]


def subtree_ends(page: Page) -> list[int]:
    """For each node the place after its last descendant."""
    end = list(range(1, len(page.name) + 1))
    for i in range(len(end) - 1, 0, -1):
        end[page.parent[i]] = max(end[page.parent[i]], end[i])
    return end


def chosen_nodes(page: Page) -> list[bool]:
    """Which nodes hold the main text: all that is left in the leading named article and in
    those like it, or what the search finds on a page that names none."""
    n, names = len(page.name), page.name
    density, total, links = densities(page)
    keep, end = [False] * n, subtree_ends(page)
    named = [i for i in range(1, n) if names[i] in ("article", "main") and not page.dropped[i] and density[i]]
    if named:
        articles = [i for i in named if names[i] == "article"] or named
        roots, after = [], 0
        for i in articles:  # in page order: those that no other is around
            if i >= after:
                roots.append(i)
                after = end[i]
        roots = [i for i in roots if page.beside.isdisjoint(ancestors(page, i))] or roots
        written = [i for i in roots if 2 * links[i] <= 1]
        lead = max(written or roots, key=lambda i: (total[i] + density[i], -i))
        threshold = min(density[i] for i in [lead, *ancestors(page, lead)] if density[i])
        written = [i for i in written if density[i] >= threshold] or [lead]
        for root in written:
            for i in range(root, end[root]):
                keep[i] = not page.dropped[i]
        return keep
    body = next((i for i in range(1, n) if names[i] == "body" and not page.dropped[i]), 0)
    search(page, body, density, total, end, keep)
    if not any(keep):
        keep = [not d for d in page.dropped]
    return keep


def search(
    page: Page, root: int, density: list[float], total: list[float], end: list[int], keep: list[bool]
) -> None:
    """Mark in ``keep`` what composite sums and the threshold choose below the root."""
    parent, last = page.parent, end[root]
    lead = max(range(root, last), key=lambda i: (total[i], -i))
    threshold, up = density[lead] or math.inf, lead
    while up > root:
        up = parent[up]
        if density[up]:
            threshold = min(threshold, density[up])
    best = list(range(root, last))
    for i in range(last - 1, root, -1):
        if total[best[i - root]] > total[best[parent[i] - root]]:
            best[parent[i] - root] = best[i - root]
    children: dict[int, list[int]] = {}
    for i in range(last - 1, root, -1):
        children.setdefault(parent[i], []).append(i)
    waiting = [root]
    while waiting:
        i = waiting.pop()
        if not page.dropped[i] and not keep[i] and density[i] >= threshold and density[i]:
            for j in range(best[i - root], end[best[i - root]]):
                keep[j] = not page.dropped[j]
            waiting += children.get(i, [])


def ancestors(page: Page, node: int) -> Iterator[int]:
    while page.parent[node] > 0:
        node = page.parent[node]
        yield node


def main_text(page_html: str | None) -> str:
    if not page_html:
        return ""
    page = parse(page_html)
    settle_dropped(page)
    keep = chosen_nodes(page)
    blocks: list[list[str]] = []
    last = None
    for node, block, text in page.pieces:
        if keep[node]:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    words = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return " ".join(w for w in words if w)


def extract(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keys`` of each page with its main text: a narrow pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [main_text(h) for h in batch.column(len(keys)).to_pylist()]
            columns = [*batch.columns[: len(keys)], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "text"])

    source = pages.select(*keys, F.col(html).alias("html_"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)
    return source.mapInArrow(run, f"{fields}, text string")


def op1(pages: DataFrame) -> DataFrame:
    return extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
