"""Main text of web pages: wrappers induced from pages of one host by simple tree matching."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import written

#: Pages of one host that are aligned with each other; a host with more pages has several such groups.
GROUP_PAGES = 128
#: Different pages that a group must have before what they share counts as template, outside and inside of the article.
LEAST_PAGES, LEAST_PAGES_INSIDE = 3, 8
#: Share of a group's different pages that must have the same text in a node of the template.
CONSTANT = 0.9
#: Share of their pairs of neighbouring words in which near copies agree, by their articles or as pages without one.
NEAR_ARTICLE, NEAR_PAGE = 0.5, 0.8
#: Share of the paths of elements outside of the article in which pages of one layout agree.
LAYOUT = 0.6

# Elements by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml canvas object".split())
NOT_CONTENT = frozenset(
    "head nav footer aside form button select option input label fieldset datalist menu dialog audio video map".split()
) | RAW
BLOCKS = frozenset(
    "html body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th"
    " caption blockquote pre figure figcaption address hr form fieldset details summary center hgroup".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends, if it is open within the same container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("html body article section main header footer nav aside div ul ol dl table td th blockquote form".split())
#: Words in the class, id or role of an element that is no part of the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notices notification alert popup modal overlay newsletter subscribe subscription signup login sidebar complementary menu nav navbar"
    " navigation breadcrumb breadcrumbs header masthead topbar footer contentinfo copyright legal social share sharing related recommended"
    " recommendations trending widget widgets comment comments reply replies respond disqus discussion pagination pager toolbar search form"
    " paywall tagcloud".split()
)
#: Words that say nothing about what an element is for.
STRUCTURE = frozenset("area bar block box buttons container icons inner links list outer posts section slot unit wrap wrapper".split())
#: Elements of running text, whose ids are anchors made from headings.
OF_TEXT = HEADINGS | {"p", "section"}
OF_READERS = frozenset("comment comments reply replies".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NOT_WORD = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Node:
    tag: str  # "#text" for text
    text: str = ""
    attributes: str = ""
    children: list[Node] = field(default_factory=list)
    shape: int = -1
    template: bool = False


def parse(source: str) -> Node:
    """A tree of the elements and texts of a page; forgives missing end tags."""
    root = Node("#page")
    stack, at = [root], 0

    def text(low: int, high: int) -> None:
        piece = source[low:high]
        if piece and not piece.isspace():
            stack[-1].children.append(Node("#text", html.unescape(piece) if "&" in piece else piece))
        elif piece:
            stack[-1].children.append(Node("#blank"))

    while True:
        found = _MARKUP.search(source, at)
        if found is None:
            text(at, len(source))
            return root
        text(at, found.start())
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "article", "body") and name in ("p", "b", "i", "span", "a", "em", "strong"):
                    break
            continue
        ended = ENDS.get(name, frozenset())
        if name in BLOCKS or ended:
            for i in range(len(stack) - 1, 0, -1):
                tag = stack[i].tag
                if tag in ended or (tag == "p" and name in BLOCKS):
                    del stack[i:]
                elif tag in CONTAINERS:
                    break
        node = Node(name, "", found[3])
        stack[-1].children.append(node)
        if name in RAW and not found[3].endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not found[3].endswith("/"):
            stack.append(node)


def _words(node: Node) -> tuple[frozenset[str], frozenset[str], bool]:
    """The words of class, id, role and itemprop; those that say by themselves what the element is; whether it is hidden.

    A whole name says so, or one whose other words are of ``STRUCTURE``: ``related`` and ``related-posts``, but not
    ``related-work``. The id of an element of running text says nothing.
    """
    if not node.attributes:
        return frozenset(), frozenset(), False
    words: set[str] = set()
    plain: set[str] = set()
    hidden = False
    for name, value in _ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name == "aria-hidden":
            hidden |= value == "true"
        elif name == "hidden":
            hidden = True
        else:
            words.update(_NOT_WORD.split(value))
            if name == "id" and node.tag in OF_TEXT:
                continue
            for whole in value.split():
                parts = set(_NOT_WORD.split(whole)) - {""}
                if parts <= NOT_ARTICLE | STRUCTURE:
                    plain |= parts & NOT_ARTICLE
    return frozenset(words), frozenset(plain), hidden


class Shapes:
    """Numbers for trees that differ only in text, and how well two of them match."""

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.tags: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.known: dict[tuple[int, int], int] = {}

    def number(self, node: Node) -> int:
        """Numbers the tree below ``node``, bottom up and without recursion."""
        order, stack = [], [node]
        while stack:
            n = stack.pop()
            order.append(n)
            stack.extend(n.children)
        for n in reversed(order):
            key = (n.tag, tuple(c.shape for c in n.children))
            found = self.numbers.get(key)
            if found is None:
                found = self.numbers[key] = len(self.tags)
                self.tags.append(n.tag)
                self.children.append(key[1])
                self.sizes.append(1 + sum(self.sizes[c] for c in key[1]))
            n.shape = found
        return node.shape

    def match(self, a: int, b: int) -> int:
        """Nodes of a largest matching that keeps roots, parents and the order of children.

        Children are matched before their parents, on a stack of its own, so that pages may be nested to any depth.
        """
        if a == b:
            return self.sizes[a]
        if self.tags[a] != self.tags[b]:
            return 0
        stack = [(a, b)]
        while stack:
            key = stack[-1]
            if key not in self.known:
                one, two = self.children[key[0]], self.children[key[1]]
                low, high = self.ends(one, two)
                inner = {
                    (x, y)
                    for x in set(one[low : len(one) - high])
                    for y in set(two[low : len(two) - high])
                    if x != y and self.tags[x] == self.tags[y] and (x, y) not in self.known
                }
                if inner:
                    stack.extend(inner)
                    continue
                self.known[key] = 1 + sum(self.match(one[i], two[j]) for i, j in self.pairs(one, two))
            stack.pop()
        return self.known[a, b]

    @staticmethod
    def ends(one: tuple[int, ...], two: tuple[int, ...]) -> tuple[int, int]:
        """How many children are equal at the start, and of the others at the end."""
        low, high = 0, 0
        least = min(len(one), len(two))
        while low < least and one[low] == two[low]:
            low += 1
        while high < least - low and one[-1 - high] == two[-1 - high]:
            high += 1
        return low, high

    def pairs(self, one: tuple[int, ...], two: tuple[int, ...]) -> list[tuple[int, int]]:
        """Which children to match: equal ones at both ends, and in between the best alignment."""
        low, high = self.ends(one, two)
        ends = [(i, i) for i in range(low)] + [(len(one) - 1 - i, len(two) - 1 - i) for i in range(high)]
        a, b = one[low : len(one) - high], two[low : len(two) - high]
        if not a or not b:
            return ends
        best = [[0] * (len(b) + 1)]
        for x in a:
            last, row = best[-1], [0]
            for j, y in enumerate(b):
                row.append(max(last[j + 1], row[j], last[j] + self.match(x, y) if self.tags[x] == self.tags[y] else 0))
            best.append(row)
        i, j = len(a), len(b)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                ends.append((low + i, low + j))
        return ends


def aligned(shapes: Shapes, one: Node, two: Node) -> Iterator[tuple[Node, Node]]:
    """Pairs of text nodes in the same place of two trees."""
    stack = [(one, two)]
    while stack:
        a, b = stack.pop()
        if a.tag == "#text":
            yield a, b
        elif a.shape == b.shape:
            stack.extend(zip(a.children, b.children, strict=True))
        else:
            for i, j in shapes.pairs(tuple(c.shape for c in a.children), tuple(c.shape for c in b.children)):
                if a.children[i].tag == b.children[j].tag:
                    stack.append((a.children[i], b.children[j]))


def _plain(text: str) -> str:
    return " ".join(text.split())


def _all_text(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if n.tag == "#text":
            out.append(n.text)
        stack.extend(n.children)
    return "".join(out)


def _articles(page: Node) -> list[Node]:
    """The article: the largest ``article`` that is no comment or teaser, else ``main``; none if there is neither."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    stack: list[tuple[Node, bool]] = [(page, False)]
    while stack:
        node, within = stack.pop()
        kind = None
        if node.tag not in ("#text", "#blank"):
            words, plain, hidden = _words(node)
            if hidden or node.tag in NOT_CONTENT or plain & OF_READERS:
                continue
            if node.tag == "article" or "articlebody" in words:
                kind = "article"
            elif node.tag == "main" or "main" in words and node.tag not in ("html", "body"):
                kind = "main"
            if kind and not (within and kind == "article"):
                found[kind].append(node)
        stack.extend((c, within or kind == "article") for c in reversed(node.children))
    for kind in ("article", "main"):
        if found[kind]:
            sizes = [len(_all_text(n)) for n in found[kind]]
            largest = max(range(len(sizes)), key=lambda i: sizes[i])
            return [found[kind][largest]] if 2 * sizes[largest] >= sum(sizes) or kind == "main" else found[kind]
    return []


def main_text(page: Node) -> str:
    """Blocks of the article, one on each line; text of the template and of what is no article is left out."""
    articles = _articles(page)
    inside = {id(a) for a in articles}
    holders: set[int] = set()  # elements that contain the article are never left out as a whole

    def mark(node: Node) -> None:
        path: list[tuple[Node, int]] = [(node, 0)]
        while path:
            n, i = path[-1]
            if id(n) in inside:
                holders.update(id(x) for x, _ in path)
            if i < len(n.children):
                path[-1] = (n, i + 1)
                path.append((n.children[i], 0))
            else:
                path.pop()

    if articles:
        mark(page)
    lines: list[str] = []
    pieces: list[str] = []

    def end_block() -> None:
        line = _plain("".join(pieces))
        if line:
            lines.append(line)
        pieces.clear()

    # (node, whether it is in the article, whether only headings count); a node of None ends a block.
    stack: list[tuple[Node | None, bool, bool]] = [(page, not articles, False)]
    while stack:
        node, taken, only_headings = stack.pop()
        if node is None:
            end_block()
            continue
        tag = node.tag
        if tag in ("#text", "#blank"):
            if taken and not only_headings:
                if tag == "#blank":
                    pieces.append(" ")
                elif not node.template:
                    pieces.append(node.text)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in NOT_CONTENT:
            if tag not in RAW:
                end_block()
            continue
        if id(node) in inside:
            taken = True
        elif id(node) not in holders and tag not in ("html", "body", "#page"):
            words, plain, hidden = _words(node)
            # In the article a word within a name is no reason: only its text can show that it is template.
            out = plain if taken and articles or tag in OF_TEXT else words & NOT_ARTICLE
            if hidden or out - {"header"}:
                end_block()
                continue
            if tag == "header" or out:
                if not (taken and articles):
                    end_block()
                    continue
                only_headings = True
        if tag in HEADINGS:
            only_headings = False
        block = tag in BLOCKS
        if block:
            end_block()
            stack.append((None, taken, only_headings))
        stack.extend((c, taken, only_headings) for c in reversed(node.children))
    end_block()
    return "\n".join(lines)


def _alike(one: frozenset, two: frozenset, share: float) -> bool:
    return len(one & two) >= share * len(one | two)


def _layout(page: Node) -> frozenset[int]:
    """The paths of the elements of a page, down to its articles."""
    inside = {id(a) for a in _articles(page)}
    paths, stack = set(), [(page, 0)]
    while stack:
        node, above = stack.pop()
        if node.tag not in ("#text", "#blank"):
            # A hash of tuples of numbers, so that it is the same in every process.
            path = hash((above, zlib.crc32(node.tag.encode())))
            paths.add(path)
            if id(node) not in inside:
                stack.extend((c, path) for c in node.children)
    return frozenset(paths)


def _by_layout(pages: list[Node]) -> list[list[Node]]:
    """Pages of one layout, the commonest layout first; the first page of each has its commonest tree."""
    layouts = [_layout(page) for page in pages]
    count = Counter(layouts)
    known: dict[frozenset, int] = {}
    chosen: list[frozenset] = []
    for layout, _ in count.most_common():  # equal counts in the order of the pages
        at = next((i for i, x in enumerate(chosen) if _alike(layout, x, LAYOUT)), len(chosen))
        if at == len(chosen):
            chosen.append(layout)
        known[layout] = at
    out: list[list[int]] = [[] for _ in chosen]
    for i, layout in enumerate(layouts):
        out[known[layout]].append(i)
    for group in out:
        trees = Counter((layouts[i], pages[i].shape) for i in group)
        group.sort(key=lambda i: (-count[layouts[i]], -trees[layouts[i], pages[i].shape]))
    return [[pages[i] for i in group] for group in sorted(out, key=len, reverse=True)]


def _different(pages: list[Node]) -> list[int]:
    """The first of each group of near copies, by what they say outside of menus and the like."""
    chosen: list[tuple[int, frozenset, float]] = []
    for i, page in enumerate(pages):
        found = main_text(page).split()
        said = frozenset(zip(found, found[1:] or found, strict=False))
        share = NEAR_ARTICLE if _articles(page) else NEAR_PAGE
        if not any(_alike(said, x, max(share, y)) for _, x, y in chosen):
            chosen.append((i, said, share))
    return [i for i, _, _ in chosen]


def induce(pages: list[Node]) -> None:
    """Marks as template the texts that different pages have in common in one place of their trees.

    The pages of each layout are aligned with one that has the commonest tree. Pages with the same article count once.
    What the articles themselves have in common must also be shared by pages that are no near copies: what takes up
    most of an article is a copied article, not template. Pages of a layout with few pages lose only what is template
    of the commonest layout, word by word.
    """
    shapes = Shapes()
    for page in pages:
        shapes.number(page)
    layouts = _by_layout(pages)
    if not _induce(shapes, layouts[0], []):
        _induce(shapes, [page for group in layouts for page in group], [])
        return
    for group in layouts[1:]:
        if not _induce(shapes, group, []):
            _induce(shapes, layouts[0], group)


def _induce(shapes: Shapes, pages: list[Node], others: list[Node]) -> bool:
    """Marks the template of ``pages``, or of ``others`` by it; whether there are enough different pages."""
    first, seen = pages[0], set()
    same: dict[int, set[int]] = {}
    at: list[list[tuple[Node, Node]]] = []
    for i, page in enumerate(pages):
        pairs = list(aligned(shapes, first, page))
        at.append(pairs)
        content = "".join(map(_all_text, _articles(page) or [page]))
        new = content not in seen
        seen.add(content)
        for ours, theirs in pairs:
            if _plain(ours.text) == _plain(theirs.text):
                same.setdefault(id(ours), set()).add(i if new else -1)
    if len(seen) < LEAST_PAGES:
        return False
    constant = {node for node, by in same.items() if len(by - {-1}) >= CONSTANT * len(seen)}
    if not constant:
        return True
    # What is constant in content is so among pages that are no near copies of each other, too.
    articles = _articles(first)
    content, stack = set(), list(articles) or [first]
    while stack:
        node = stack.pop()
        content.add(id(node))
        stack.extend(node.children)
    if constant & content:
        chosen = set(_different(pages))
        least = LEAST_PAGES_INSIDE if articles else LEAST_PAGES
        constant -= {node for node in constant & content if len(chosen) < least or len(same[node] & chosen) < CONSTANT * len(chosen)}
    targets = zip(pages, at, strict=True) if not others else ((page, list(aligned(shapes, first, page))) for page in others)
    for page, pairs in targets:
        within: set[int] = set()
        if len(seen) < LEAST_PAGES_INSIDE:
            stack = _articles(page)
            while stack:
                node = stack.pop()
                within.add(id(node))
                stack.extend(node.children)
        for ours, theirs in pairs:
            if id(ours) in constant and id(theirs) not in within and (not others or _plain(ours.text) == _plain(theirs.text)):
                theirs.template = True
    return True


def _extract(table: pa.Table) -> pa.Table:
    # Rows come in the order of a shuffle; the wrapper must not depend on it.
    table = table.sort_by([("page_id", "ascending"), ("url", "ascending"), ("html", "ascending")])
    pages = [parse(source) for source in table.column("html").to_pylist()]
    if len(pages) > 1:
        induce(pages)
    return pa.table({
        "page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(map(main_text, pages), pa.string()),
    })


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages``: the main text of the page.

    Pages of one host and layout are aligned by simple tree matching. Texts that stay the same in one place are template, what
    varies is content. Menus, headers, footers, sidebars, notices, adverts, forms and comments vary too, so elements
    whose name, class, id or role says that they are such are left out as well; if a page has an ``article`` (or else
    a ``main``), only its contents count, and within it only a whole name says so, as ids and compound names often
    stand for what the text is about. Character references are decoded, white space within a block is one space,
    and blocks are joined by line ends.

    A null page is empty; a page without text gives an empty one; pages without a URL or host form a host of their
    own; repeated rows are each a page. Other columns are ignored. Hosts with many pages are dealt into groups of
    about ``group_pages`` pages by a hash of the page, so that no task holds a whole host, and each group induces its
    own wrapper.
    """
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    # Written, so that Spark knows whether the counts are small enough to be broadcast.
    counts = written(rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / group_pages).alias("groups")))
    dealt = rows.join(counts, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.col("groups")))
    columns = dealt.select("page_id", "url", "html", "host", "part")
    return columns.groupBy("host", "part").applyInArrow(_extract, f"page_id {types['page_id']}, url {types['url']}, text string")
