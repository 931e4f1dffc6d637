"""Main text of web pages by composite text density.

Every node of a page's tree has a density: its characters per tag, adjusted by how much of
both lies in links. The densities of a node's children add up to its density sum, and the
node with the largest sum under the body holds the article. From there the search goes up
as long as a node is at least as dense as the threshold, the smallest density between that
node and the body; what hangs below but is a list of links, is left out. Elements that are
never article text (menus, page headers, footers, forms, scripts, adverts, comments ...) are
taken out of the tree before anything is counted.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import table

# Element kinds of HTML, and names that sites give to parts around an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "head script style noscript template nav footer aside form iframe svg canvas object button select option "
    "textarea dialog menu title audio video map math xmp noembed".split()
)
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices popup modal overlay comment "
    "comments disqus reply replies respond share sharing social related recommended newsletter subscribe signup login "
    "pagination pager toolbar widget skip copyright masthead".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Which open elements an opening tag ends.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("thead", "tr", "td", "th"),
}
STOPS = frozenset("table ul ol dl div article section main body select td th blockquote".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S)
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("name", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, name: str, parent: "Node | None"):
        self.name, self.parent = name, parent
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _around(name: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element stands around articles and is no part of one."""
    if name in NEVER or name == "header" and not inside_article:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values).lower(), key.lower()
        if key in ("class", "id") and not AROUND.isdisjoint(_NAME.findall(value)):
            return True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _ended(name: str) -> tuple[str, ...]:
    """The elements that an opening block ends: paragraphs, headings, the list item before."""
    return (*ENDS.get(name, ()), "p", *(HEADINGS if name in HEADINGS else ()))


def _left_open(dropped: list[str], name: str) -> list[str]:
    """What an opening tag leaves open of a dropped part whose end tags may be left out."""
    if name in INLINE or name in VOID and name != "hr":
        return dropped
    ended, stops, last = _ended(name), STOPS - set(ENDS.get(name, ())), len(dropped)
    for i in range(len(dropped) - 1, -1, -1):
        if dropped[i] in stops:
            break
        if dropped[i] in ended:
            last = i
    return dropped[:last]


def tree(page: str) -> Node:
    """The page's tree without what stands around articles; tags that are not closed, are."""
    root = Node("#root", None)
    node, dropped, articles = root, [], 0  # dropped: open elements of a part that is left out
    at, end = 0, len(page)
    lower = None
    while at < end:
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else end]
        if text and not dropped:
            node.items.append(html.unescape(text))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        name, closing = found[2].lower(), found[1]
        if dropped:
            # Only the part's own tags matter until it ends; an end tag of an element around
            # the part ends it as well.
            if closing:
                if name in dropped:
                    while dropped.pop() != name:
                        pass
                    continue
                around, seek = False, node
                while seek is not root:
                    around |= seek.name == name
                    seek = seek.parent
                if not around or name in INLINE or name == "p":
                    continue
                dropped = []
            else:
                dropped = dropped if name in RAW else _left_open(dropped, name)
                if dropped:
                    if name in RAW:
                        lower = lower or page.lower()
                        stop = lower.find(f"</{name}", at)
                        at = end if stop < 0 else page.find(">", stop) + 1 or end
                    elif name not in VOID and not found[3].endswith("/"):
                        dropped.append(name)
                    continue
        if closing:
            seek = node
            while seek is not root and seek.name != name:
                if name in INLINE and seek.name not in INLINE:
                    seek = root  # an inline end tag does not end blocks
                    break
                seek = seek.parent
            if seek is not root:
                while node is not seek:
                    articles -= node.name in ARTICLE
                    node = node.parent
                articles -= node.name in ARTICLE
                node = node.parent
            elif name in ("p", "br"):
                node.items.append(Node(name, node))
            continue
        if name in RAW:
            lower = lower or page.lower()
            stop = lower.find(f"</{name}", at)
            at = end if stop < 0 else page.find(">", stop) + 1 or end
            continue
        if name not in INLINE and name not in VOID or name == "hr":
            seek = node  # a block ends an open paragraph or heading, a list item the one before
            ended = _ended(name)
            last = None
            while seek is not root and seek.name not in (STOPS - set(ENDS.get(name, ()))):
                if seek.name in ended:
                    last = seek
                seek = seek.parent
            if last is not None:
                node = last.parent
        if _around(name, found[3], articles > 0):
            if name not in VOID and not found[3].endswith("/"):
                dropped = [name]
            continue
        child = Node(name, node)
        node.items.append(child)
        if name not in VOID and not (found[3].endswith("/") and name not in INLINE and name not in STOPS):
            node = child
            articles += name in ARTICLE
    return root


def _walk(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out.extend(x for x in node.items if isinstance(x, Node))
    return out


def measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes, parents first."""
    nodes = _walk(root)
    for node in reversed(nodes):
        node.chars += sum(len(x) - x.count(" ") for x in node.items if isinstance(x, str))
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = max(1, root.chars)
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        if c:
            lc, lt = max(1, node.link_chars), max(1, node.link_tags)
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + root.link_chars / body * c + math.e)
            node.density = c / t * math.log(max(1.0, c / lc * t / lt)) / base if node.link_chars else c / t
        if node.parent is not None:
            node.parent.sum += node.density
    return nodes


def main_node(root: Node) -> tuple[Node, float] | None:
    """The node that holds the article, and the threshold of its way from the body."""
    nodes = measure(root)
    body = next((n for n in nodes if n.name == "body"), root)
    inside = {id(body)}
    for node in nodes:
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
    best = max((n for n in nodes if id(n) in inside and n.chars), key=lambda n: n.sum, default=None)
    if best is None:
        return None
    path, node = [best], best
    while node is not body:
        node = node.parent
        path.append(node)
    threshold = min(n.density for n in path)
    # Up to the outermost article, or to the largest part below the body.
    outer = [n for n in path if n.name in ARTICLE]
    if outer:
        return outer[-1], threshold
    while best is not body and best.parent is not body and best.parent.density >= threshold:
        best = best.parent
    return best, threshold


def _write(top: Node, threshold: float) -> str:
    out: list[str] = []
    work: list[Node | str] = [top]
    while work:
        item = work.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        links = item.link_tags > 2 and 2 * item.link_chars > item.chars and item.density < threshold
        if links and item is not top and item.name not in INLINE:
            continue
        block = item.name not in INLINE
        if block:
            out.append(" ")
            work.append(" ")
        work.extend(reversed(item.items))
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    """The article's text: references decoded, white space as one blank, blocks joined by one."""
    if not page:
        return ""
    root = tree(page)
    found = main_node(root)
    return _write(*found) if found else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty html, and a page without any text, give an empty text. Ids and urls may be
    null or repeated; they are passed on. An empty table gives an empty result.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
