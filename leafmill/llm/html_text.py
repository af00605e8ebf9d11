"""Main text of web pages by composite text density.

Every DOM node gets a link-adjusted density of characters per tag; a block's density sum adds up the densities of the
blocks directly below it and of its own text. The block with the largest sum is the core of the article. The smallest
density on its path to the body is the threshold: siblings on that path that reach it and weigh enough beside the core,
and text elements next to it, belong to the article too, with everything between them; the rest of the page does not.
An article or main element around the core is taken whole.

Marks of boilerplate (tags, roles, words in class and id) are a prior: they divide a node's density by five, so that the
core is rarely found there, and what is marked inside the article is left out if its density so divided stays under the
article's own. An article or main element has five times the density. Marks that tell the kind of an element for certain (menus, forms, footers, asides, hidden elements) are
left out of the article at any density. A class or id marks no node that holds the main element or the first h1 of the page.

Cases: null or empty html gives an empty text; markup cut off at the end of a page is dropped, text is kept; end tags
may be missing anywhere; a page without a body is read as one; equal rows give equal texts. Time is linear in the length
of a page, also for deep trees and for end tags that close nothing; a page is read whole, one at a time.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.functions.session import arrow_rows

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|noscript|template|textarea|title|iframe|xmp|noembed|noframes)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<foreign>svg|object)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<!/)>.*?</(?P=foreign)\s*>
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<[/!?a-zA-Z][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4
    h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"caption", "tbody", "tfoot", "thead", "tr", "body", "html", "legend"}
#: An open element that the start of another ends, and where to stop looking for it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Tags, roles and words of class and id that mark what is not the article.
CUT_TAGS = frozenset("nav footer aside form button select menu dialog canvas audio video annotation annotation-xml".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CUT_WORDS = re.compile(
    r"""(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notice|popup|modal|overlay|
    newsletter|subscribe|subscription|signup|login|sidebar|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|share|sharing|social|related|
    recommended|comments?|commentlist|respond|replies|disqus|footer|masthead|site-header|page-header|toolbar|widget|banner|skip-link)(?:$|[\s_-])""",
    re.I | re.X,
)
_NOT_CUT = frozenset("has no with without not".split())
#: What may follow such a word in a class or id; "related-work" is no box of related pages.
_AFTER = re.compile(
    r"""(?:[_-]+(?:container|wrap(?:per)?|box(?:es)?|area|block|section|list|bar|inner|outer|top|bottom|left|right|header|footer|title|heading|body|content|
    posts?|articles?|stories|news|links?|items?|products?|reading|topics|videos?|pages|buttons?|icons?|tools|form|text|message|label|image|slot|unit|panel|
    module|region|primary|secondary|main|mobile|desktop|small|large|col(?:umn)?|row|group|menu|html|thread|template|policy|bg|close|toggle|\d+))*""",
    re.I | re.X,
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Parameters: how far a mark lowers a density, and what share of the core's density sum a sibling needs.
DAMPING, BESIDE = 0.2, 0.2
_FLOW = HEADINGS | frozenset("p ul ol dl pre blockquote table figure center".split())


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "certain", "doubtful", "chars", "tags", "link_chars", "link_tags", "own", "own_links", "inline", "weight", "density", "total")

    def __init__(self, tag, parent):
        self.tag, self.parent, self.children = tag, parent, []
        self.cut = self.certain = self.doubtful = False
        self.chars = self.tags = self.link_chars = self.link_tags = self.own = self.own_links = self.inline = 0
        self.weight, self.density, self.total = 1.0, 0.0, 0.0


def _is_cut_word(value: str) -> bool:
    """Whether a class or id has a token that ends in a cut word, apart from layout words, and doesn't deny it."""
    for token in value.split():
        for m in CUT_WORDS.finditer(token):
            if not _NOT_CUT & set(re.split(r"[_-]+", token[: m.start()].lower())):
                word_end = m.end() - (m[0][-1] in "_-")
                rest = token[word_end:]
                if _AFTER.fullmatch(rest) or CUT_WORDS.search(rest):
                    return True
    return False


def _mark(node: Node, attrs: str, in_article: bool) -> None:
    """Marks a node by its tag and attributes."""
    node.certain = node.tag in CUT_TAGS or node.tag == "header" and not in_article
    if not attrs or node.tag in ("html", "body"):
        return
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            node.cut = True
        elif node.tag not in ("article", "main"):
            node.certain |= name == "role" and value.lower() in CUT_ROLES
            node.doubtful |= name in ("class", "id") and node.tag not in HEADINGS and _is_cut_word(value)


def parse(html: str) -> Node:
    root = Node("body", None)
    stack = [root]
    open_tags: Counter = Counter()
    at = 0
    holds: dict[str, Node | None] = {"main": None, "h1": None}

    def close(until: int) -> None:
        for node in stack[until:]:
            open_tags[node.tag] -= 1
        del stack[until:]

    def end_open(tags, stops) -> None:
        if not any(open_tags[t] for t in tags):
            return None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return close(i)
            if stack[i].tag in stops:
                return None

    def say(text: str) -> None:
        if text:
            stack[-1].children.append(entities.unescape(text) if "&" in text else text)

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            say(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if not m["end"] and open_tags["head"] and len(stack) > 1 and stack[1].tag == "head" and (tag == "body" or tag in BLOCK):
            close(1)  # a head that was not closed
        if tag in ("html", "body"):
            continue
        if m["end"]:
            if not open_tags[tag]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("table", "article", "td", "th") and tag in ("p", "b", "i", "a", "em", "strong", "span"):
                    break
            continue
        if tag in CLOSES_P:
            end_open({"p"}, BLOCK - {"p"})
        if tag in ENDS:
            end_open(*ENDS[tag])
        node = Node(tag, stack[-1])
        _mark(node, m["attrs"], bool(open_tags["article"] or open_tags["main"]))
        if tag in holds and holds[tag] is None:
            holds[tag] = node
        stack[-1].children.append(node)
        if tag not in VOID and not m["attrs"].endswith("/") or tag in BLOCK and tag not in VOID:
            stack.append(node)
            open_tags[tag] += 1
    if at < len(html):
        say(html[at:])
    for node in holds.values():  # what holds the main element or the title of the page is no boilerplate by its class
        while node is not None:
            node.doubtful = False
            node = node.parent
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes that are shown, parents first."""
    found = [root]
    for node in found:
        found += [c for c in node.children if isinstance(c, Node) and not c.cut and c.tag != "head"]
    return found


def _measure(nodes: list[Node]) -> None:
    """Densities and density sums of all nodes; nodes come parents first."""
    for node in nodes[1:]:
        node.weight = node.parent.weight * (DAMPING if node.certain or node.doubtful else 1.0)
        if node.tag in ("article", "main") and node.weight <= 1.0:  # the outermost one
            node.weight /= DAMPING
    for node in reversed(nodes):
        direct = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += direct
        node.own += direct
        above = node.parent
        if above is None:
            continue
        link = node.tag == "a"
        above.chars += node.chars
        above.tags += node.tags + 1
        above.link_chars += node.chars if link else node.link_chars
        above.link_tags += node.link_tags + link
        if node.tag not in BLOCK:  # the text of an inline element is its block's own
            above.own += node.own
            above.own_links += node.own if link else node.own_links
            above.inline += node.inline + 1
    root = nodes[0]
    share = root.link_chars / max(1, root.chars)
    for node in nodes:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        if c:
            node.density = node.weight * c / t
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            if base > 1.0001:  # 1: no links in the page, nothing to adjust
                node.density *= math.log(max(1.0, c / max(1, lc) * t / lt)) / math.log(base)
    for node in reversed(nodes):
        node.total += node.weight * max(0, node.own - node.own_links) / (node.inline + 1)
        if node.parent is not None:
            node.parent.total += node.density if node.tag in BLOCK else node.total - node.weight * max(0, node.own - node.own_links) / (node.inline + 1)


def article(root: Node) -> Node:
    """The subtree that holds the main text; what is left out of it is cut."""
    nodes = _walk(root)
    _measure(nodes)
    if not root.chars:
        return root
    core = max((n for n in nodes if n.tag in BLOCK), key=lambda n: n.total)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    whole = max((i for i, n in enumerate(path) if n.tag in ("article", "main")), default=0)

    def beside(node: Node) -> bool:
        """Whether a sibling of the path is a part of the article."""
        return node.tag in BLOCK and not (node.cut or node.certain or node.doubtful) and node.density >= threshold and 2 * node.link_chars <= node.chars and node.total >= BESIDE * core.total

    def flows(node: Node | str) -> bool:
        """Whether a neighbour is a text element of the article."""
        if isinstance(node, str):
            return not node.strip()
        headed = node.tag in HEADINGS and node.chars
        return node.tag in _FLOW and not (node.cut or node.certain or node.doubtful) and 2 * node.link_chars <= node.chars and bool(headed or node.density >= threshold)

    top = path[whole]
    for node, above in zip(path[whole:], path[whole + 1 :], strict=False):
        rest = above.children
        at = next(i for i, c in enumerate(rest) if c is node)
        parts = [i for i, c in enumerate(rest) if i != at and isinstance(c, Node) and beside(c)]
        first, last = min([at, *parts]), max([at, *parts])
        while first > 0 and flows(rest[first - 1]):
            first -= 1
        while last + 1 < len(rest) and flows(rest[last + 1]):
            last += 1
        if any(isinstance(c, Node) for c in rest[first:at] + rest[at + 1 : last + 1]):
            top = above
        above.children = rest[first : last + 1]  # outside of the article, also where a node further up is taken
    level = top.density / top.weight
    for node in _walk(top)[1:]:
        node.cut |= node.certain or node.doubtful and node.density / top.weight < level
    return top


def blocks(node: Node) -> list[str]:
    """The texts of the blocks below node, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.cut and x.tag != "head":
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            elif x.tag in ("br", "td", "th"):
                run.append(" ")
            todo += reversed(x.children)
    flush()
    return out


def main_text(html: str | None) -> str:
    return "\n\n".join(blocks(article(parse(html)))) if html else ""


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of df."""
    arrow_rows(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return df.select(df[id_col].alias("page_id"), df[url_col].alias("url"), df[html_col].alias("html")).mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
