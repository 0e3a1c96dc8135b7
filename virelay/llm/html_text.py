"""Main-text extraction by a tree-structured graphical model.

Each element of a page's DOM is a binary variable: its own text is article
content, or not.  Potentials, one table for each tag, join every element to its
parent, and evidence (words of class, id and role, amount of text, share of
linked text) hangs on each element.  One upward and one downward pass of sum-product messages give
every element's content marginal; text counts if that of its element is above
one half.  All potentials are frequencies counted on labelled pages
(``labelled_pages``).
"""

from __future__ import annotations

import bisect
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import column, slices

# Fixed values of the HTML standard: element kinds.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Their text is never shown as text of the page.
HIDDEN = frozenset("head noscript template svg math select button datalist object canvas audio video map".split())
HEAD_ONLY = frozenset("meta link title style script base noscript template basefont bgsound".split())
#: Elements whose paragraphs are told apart from those of others.
WRAPPING = frozenset("body html nav header footer aside form".split())
#: An element of the key is closed by a start tag of these, up to the nearest container.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
             "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"})}

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|/[^a-zA-Z>][^>]*+(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>=]++|=)*+)(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    words: tuple[str, ...]
    parent: int
    hidden: bool
    chars: int = 0
    linked: int = 0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    #: (element, raw text or None for the edge of a block), in page order
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def hints(attributes: str) -> tuple[tuple[str, ...], bool]:
    """Distinct lower-case words of the class, id and role attributes, and whether the element is not shown."""
    if "=" not in attributes and "idden" not in attributes and "IDDEN" not in attributes:
        return (), False
    found: dict[str, None] = {}
    hidden = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            for w in WORD.findall(value):
                found[w.lower()] = None
        elif name == "hidden" or name == "style" and UNSEEN.search(value):
            hidden = True
    return tuple(found), hidden


class Stack:
    """The open elements, with what makes every look-up independent of their number."""

    def __init__(self, page: Page):
        self.page, self.open = page, [0]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, i: int) -> None:
        tag = self.page.elements[i].tag
        self.depths.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(i)

    def last(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element of these tags, 0 if there is none."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def pop_to(self, depth: int) -> None:
        """Closes all elements from this depth on."""
        if self.blocks and self.blocks[-1] >= depth:
            self.page.pieces.append((0, None))
        while len(self.open) > depth:
            tag = self.page.elements[self.open.pop()].tag
            self.depths[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def close(self, tag: str) -> None:
        """An end tag; one of an inline element doesn't reach over a block."""
        if (depth := self.last((tag,))) and (tag in BLOCK or not self.blocks or depth > self.blocks[-1]):
            self.pop_to(depth)

    def make_room(self, tag: str) -> None:
        """Closes what the start tag of a block ends: an open paragraph, and elements of its own kind in the same container."""
        if self.blocks and self.page.elements[self.open[self.blocks[-1]]].tag == "p":
            self.pop_to(self.blocks[-1])
        if tag in CLOSED_BY:
            same, containers = CLOSED_BY[tag]
            edge = self.last(containers)
            inside = [d[k] for t in same if (d := self.depths.get(t)) and (k := bisect.bisect_right(d, edge)) < len(d)]
            if inside:
                self.pop_to(min(inside))


def parse(source: str) -> Page:
    """A page's elements and text, in time linear in its length; any string gives a tree, however broken."""
    page = Page([Element("#root", (), -1, False)])
    elements, pieces, stack = page.elements, page.pieces, Stack(page)
    at, in_link, raw_ends = 0, False, {}

    def text(a: int, b: int) -> None:
        if b > a:
            up = stack.open[-1]
            e = elements[up]
            pieces.append((up, source[a:b]))
            n = len(source[a:b].split())
            e.chars += n
            e.linked += n if in_link else 0

    while m := TAG.search(source, at):
        text(at, m.start())
        at = m.end()
        if (tag := m[2]) is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = False
            stack.close(tag)
            continue
        if tag in RAW:
            if tag not in raw_ends:  # where the tag's next end is, as long as it lies ahead
                raw_ends[tag] = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.IGNORECASE)
            closing = raw_ends[tag].search(source, at)
            at = closing.start() if closing else len(source)
            continue
        if elements[stack.open[-1]].tag == "head" and tag not in HEAD_ONLY:
            stack.pop_to(len(stack.open) - 1)
        if tag in VOID:
            pieces.append((0, None) if tag == "hr" else (stack.open[-1], " ") if tag == "br" else (stack.open[-1], ""))
            continue
        if tag in BLOCK:
            stack.make_room(tag)
            pieces.append((0, None))
            in_link = False
        elif tag == "a":
            in_link = True
        words, unseen = hints(m[3])
        if tag in BLOCK or tag in HIDDEN or words or unseen:
            up = stack.open[-1]
            elements.append(Element(tag, words, up, unseen or tag in HIDDEN or elements[up].hidden))
            if not m[3].endswith("/") or tag not in HIDDEN:
                stack.push(len(elements) - 1)
    text(at, len(source))
    return page


def evidence(page: Page) -> list[list[str]]:
    """The names of what is seen of each element, over all below it where texts are measured."""
    chars = [e.chars for e in page.elements]
    linked = [e.linked for e in page.elements]
    paragraphs = [0] * len(chars)  # right in the element, without a name
    for i in range(len(chars) - 1, 0, -1):
        e = page.elements[i]
        if not e.hidden:
            chars[e.parent] += chars[i]
            linked[e.parent] += linked[i]
            paragraphs[e.parent] += e.tag == "p" and not e.words
    out = []
    for e, n, k, p in zip(page.elements, chars, linked, paragraphs, strict=True):
        size = 0 if not n else 1 if n < 6 else 2 if n < 20 else 3 if n < 80 else 4
        share = 0 if not k else 1 if 4 * k < n else 2 if 3 * k < 2 * n else 3
        out.append([f"words {size} links {share}", f"{e.tag if e.tag in WRAPPING else ''} paragraphs {min(p, 3)}", *[f"hint {w}" for w in e.words]])
    return out


def log_mix(odds: float, row: tuple[float, float]) -> float:
    """Log of row[0] + row[1] * odds, less log(1 + odds): a message to a state, from log odds."""
    if odds > 0:
        return math.log(row[0] * math.exp(-odds) + row[1])
    return math.log(row[0] + row[1] * math.exp(odds))


NEVER = -1e3


def has_body(page: Page) -> bool:
    """Whether the page has a body or html element of its own, and not only their content."""
    return any(e.tag in ("html", "body") for e in page.elements[1:4])


@dataclass
class TreeModel:
    """Log potentials of evidence for content, potentials of (parent state, child state) by the child's tag, and the root's log odds without and with a body."""

    weights: dict[str, float]
    pairs: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    root: tuple[float, float] = (NEVER, NEVER)

    def pair(self, tag: str) -> tuple[tuple[float, float], tuple[float, float]]:
        return self.pairs.get(tag) or self.pairs[""]

    def marginals(self, page: Page) -> list[float]:
        """Each element's probability of being content, by sum-product on the tree, in log odds."""
        elements, weigh = page.elements, self.weights.get
        pairs = [self.pair(e.tag) for e in elements]
        n = len(elements)
        below = [sum(weigh(x, 0.0) for x in seen) for seen in evidence(page)]
        below[0] = self.root[has_body(page)]
        # Beliefs from below, and log ratios of the messages to the parent (if it is content to if it is not).
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            if elements[i].hidden:  # not part of the model: it says nothing about what is around it
                below[i] = NEVER
                continue
            below[i] = max(NEVER, min(-NEVER, below[i]))
            up[i] = log_mix(below[i], pairs[i][1]) - log_mix(below[i], pairs[i][0])
            below[elements[i].parent] += up[i]
        full = below[:]  # with the message from above
        for i in range(1, n):
            if elements[i].hidden:
                continue
            rest = full[elements[i].parent] - up[i]  # the parent without this child
            (p00, p01), (p10, p11) = pairs[i]
            full[i] = max(NEVER, min(-NEVER, below[i] + log_mix(rest, (p01, p11)) - log_mix(rest, (p00, p10))))
        return [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in full]

    def text(self, source: str | None) -> str:
        """The page's main text: a line for each block, its white space as single spaces."""
        if not source:
            return ""
        page = parse(source)
        keep = [p > 0.5 for p in self.marginals(page)]
        blocks, block = [], []
        for i, raw in page.pieces:
            if raw is None:
                if block:
                    blocks.append("".join(block))
                    block = []
            elif keep[i]:
                block.append(html.unescape(raw))  # a reference ends where its piece of text does
        if block:
            blocks.append("".join(block))
        lines = (" ".join(b.split()) for b in blocks)
        return "\n".join(x for x in lines if x)


def train(pages: Iterable[tuple[str, list[bool]]], smooth: float = 0.5) -> TreeModel:
    """Counts the potentials on pages with a label for each element (in page order, without the root)."""
    seen, total, roots = [Counter(), Counter()], [0, 0], [[smooth, smooth], [smooth, smooth]]
    counts: dict[str, list[list[float]]] = {"": [[smooth, smooth], [smooth, smooth]]}
    for source, labels in pages:
        page = parse(source)
        # The root counts as content where paragraphs of the article stand right in it.
        state = [any(x and e.parent == 0 and e.tag == "p" for e, x in zip(page.elements[1:], labels, strict=False)), *labels]
        if len(state) != len(page.elements):
            raise ValueError(f"{len(page.elements) - 1} elements, {len(labels)} labels")
        roots[has_body(page)][state[0]] += 1
        for e, s, names in list(zip(page.elements, state, evidence(page), strict=True))[1:]:
            if e.hidden:
                continue
            for tag in ("", e.tag):
                counts.setdefault(tag, [[0.0, 0.0], [0.0, 0.0]])[state[e.parent]][s] += 1
            total[s] += 1
            seen[s].update(names)
    share = lambda s, k: (seen[s][k] + smooth) / (total[s] + 2 * smooth)
    weights = {k: math.log(share(1, k) / share(0, k)) for k in {*seen[0], *seen[1]}}
    overall = [[x / sum(row) for x in row] for row in counts[""]]
    # A tag's table leans on that of all tags, with the weight of four elements for each state of the parent.
    pairs = {tag: tuple(tuple((x + 4 * o) / (sum(row) + 4) for x, o in zip(row, base, strict=True)) for row, base in zip(rows, overall, strict=True)) for tag, rows in counts.items()}
    return TreeModel(weights, pairs, tuple(math.log(r[1] / r[0]) for r in roots))


# Labelled pages. A node is (tag, attributes, content?, children); children are nodes and strings.


def labelled_pages(count: int = 600, seed: int = 7) -> Iterator[tuple[str, list[bool]]]:
    """Pages of varied layouts, each element labelled as content or not.

    ``count`` bounds the sample the model learns from.  The words are drawn
    anew for each page and carry no information; layouts, tags and names do.
    """
    rng = random.Random(seed)
    some = lambda a, b: " ".join(rng.choice(("lorem", "ipsum", "dolor", "sit", "amet", "magna", "erat", "sed", "quia", "vel")) for _ in range(rng.randint(a, b)))
    named = lambda *names: f' {rng.choice(("class", "id"))}="{rng.choice(names)}"'

    def maybe(p: float, node):
        return [node] if rng.random() < p else []

    def links(tag: str, names: tuple[str, ...], n: int) -> tuple:
        items = [("li", "", False, [f'<a href="/x">{some(1, 3)}</a>']) for _ in range(n)]
        listed = ("ul", "", False, items)
        return (tag, named(*names) if names else "", False, [*maybe(0.3, ("h3", "", False, [some(1, 3)])), listed])

    def plain(tag: str, names: tuple[str, ...], a: int, b: int) -> tuple:
        inner = [some(a, b)] if rng.random() < 0.5 else [("p", "", False, [some(a, b)]) for _ in range(rng.randint(1, 3))]
        return (tag, named(*names) if names else "", False, inner)

    nav = lambda: links(rng.choice(("nav", "nav", "div", "div")), ("nav", "menu", "navbar", "navigation", "main-menu", "site-nav", "breadcrumbs", "breadcrumb", "topbar", "toc", "skip-links", "pagination", "pager"), rng.randint(3, 9))
    header = lambda: (rng.choice(("header", "div")), named("header", "site-header", "masthead", "page-header", "banner", "top", "logo", "branding", "tagline"), False, [rng.choice((("h1", "", False, [some(1, 4)]), ("p", "", False, [some(2, 8)]), ("div", named("logo", "brand", "site-title"), False, [some(1, 3)]))), *maybe(0.5, nav())])
    footer = lambda: (rng.choice(("footer", "footer", "div")), named("footer", "site-footer", "page-footer", "copyright", "colophon", "legal", "credits"), False, [*rng.choice(([f"&copy; {some(3, 12)}"], [("p", "", False, [f"&copy; {some(4, 25)}"])])), *maybe(0.4, links("div", ("footer-links", "social"), 4))])
    bare = lambda tag: (tag, "", False, [("p", "", False, [some(3, 25)])] if rng.random() < 0.5 else [some(3, 20)])
    ad = lambda: plain(rng.choice(("div", "div", "aside", "section", "p")), ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "promoted", "banner-ad", "adsense", "ad-slot", "ad-container"), 3, 30)
    notice = lambda: plain(rng.choice(("div", "section", "aside", "p", "dialog")), ("cookie-notice", "cookie-banner", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall", "signup", "disclaimer", "privacy", "warning", "message", "toast"), 4, 40)
    side = lambda: rng.choice((links("aside", ("sidebar", "related", "widget", "most-read", "trending", "popular", "recommended", "tags", "archive", "categories"), 5), plain(rng.choice(("aside", "div")), ("sidebar", "side", "aside", "rail", "widget", "related", "complementary", "author-box", "about", "teaser", "secondary"), 5, 60), ("aside", "", False, [("h3", "", False, [some(1, 3)]), ("p", "", False, [some(5, 40)])]), ("aside", "", False, [some(5, 40)])))
    form = lambda: ("form", rng.choice(("", named("search", "searchform", "contact", "login", "newsletter", "comment-form", "signup"))), False, rng.choice(([("p", "", False, [some(2, 10)])], [some(1, 8)], [("label", named("label", "field"), False, [some(1, 3)]), ("fieldset", "", False, [("legend", "", False, [some(1, 3)]), some(1, 4)])], [("div", named("field", "form-group", "form-row"), False, [some(1, 5)])])))
    share = lambda: links("div", ("share", "social", "sharing", "share-buttons", "social-links", "tags", "related", "read-more", "next-prev", "post-navigation"), rng.randint(2, 5))

    def comments() -> tuple:
        tag = rng.choice(("div", "li", "article", "section"))
        one = lambda: (tag, named("comment", "comment-item", "reply", "comment-body", "review", "post-comment"), False, [*maybe(0.5, ("div", named("comment-author", "comment-meta", "vcard"), False, [some(1, 3)])), ("p", "", False, [some(5, 60)])])
        return (rng.choice(("section", "div", "ol")), named("comments", "comment-list", "discussion", "responses", "replies", "disqus", "reader-comments", "commentlist", "respond", "feedback"), False, [*maybe(0.6, ("h3", "", False, [some(1, 2)])), *[one() for _ in range(rng.randint(1, 5))], *maybe(0.3, form())])

    def body_block() -> tuple:
        k = rng.random()
        if k < 0.66:
            return ("p", "", True, [some(1, 120) if rng.random() < 0.9 else f'{some(4, 40)} <a href="/y">{some(1, 4)}</a> {some(2, 30)}'])
        if k < 0.74:
            return (rng.choice(("h2", "h3", "h4")), "", True, [some(1, 8)])
        if k < 0.80:
            return (rng.choice(("ul", "ol")), "", True, [("li", "", True, [some(1, 25)]) for _ in range(rng.randint(2, 6))])
        if k < 0.84:
            return ("blockquote", "", True, rng.choice(([some(5, 50)], [("p", "", True, [some(5, 50)])])))
        if k < 0.88:
            return ("figure", "", True, [("figcaption", "", True, [some(2, 15)])])
        if k < 0.91:
            return ("pre", "", True, [some(3, 30)])
        if k < 0.94:
            return ("table", "", True, [("tr", "", True, [("td", "", True, [some(1, 5)]) for _ in range(3)]) for _ in range(3)])
        if k < 0.97:
            return ("div", rng.choice(("", named("paragraph", "text", "lead", "intro", "summary", "caption", "quote"))), True, [some(5, 80)])
        return ("section", rng.choice(("", named("section", "chapter", "part"))), True, [("h2", "", True, [some(1, 5)]), ("p", "", True, [some(5, 80)])])

    def parts() -> tuple[list, list]:
        """Heading and blocks of an article, with what may stand between them."""
        blocks = [body_block() for _ in range(rng.randint(1, 14))] if rng.random() < 0.75 else [("p", "", True, [some(1, 12)]) for _ in range(rng.randint(1, 3))]
        for junk, p in ((ad, 0.2), (share, 0.25), (notice, 0.1), (side, 0.12), (form, 0.06)):
            if rng.random() < p:
                blocks.insert(rng.randint(0, len(blocks)), junk())
        title = ("h1", rng.choice(("", "", named("title", "headline", "entry-title", "post-title", "article-title"))), True, [some(2, 12)])
        head = rng.choice(([title], [title], [("header", rng.choice(("", named("entry-header", "article-header"))), True, [title, *maybe(0.5, ("p", named("byline", "author", "date", "meta", "dateline"), True, [some(2, 6)]))])], []))
        return head, blocks

    def article() -> tuple:
        head, blocks = parts()
        inner = [*head, *blocks, *maybe(0.12, comments())]
        kind = rng.random()
        good = named("content", "article", "post", "entry", "story", "main-content", "article-body", "post-body", "post-content", "entry-content", "body-text", "article-content", "story-body", "text", "page-content", "hentry", "articleBody", "prose")
        if kind < 0.4:
            return ("article", rng.choice(("", "", good)), True, inner)
        if kind < 0.55:
            return ("main", rng.choice(("", good)), True, inner)
        if kind < 0.72:
            return ("div", good, True, inner)
        if kind < 0.86:
            return ("div", good, True, [*head, ("div", named("post-body", "entry-body", "article-text", "content", "body", "story-text"), True, rng.choice((blocks, [some(10, 150)])))])
        return ("article", rng.choice(("", good)), True, [("div", good, True, inner)])

    for _ in range(count):
        tops = [x() for x, p in ((nav, 0.7), (header, 0.6), (notice, 0.25), (ad, 0.35), (side, 0.15), (form, 0.15)) if rng.random() < p]
        tops += [bare(rng.choice(("nav", "header", "aside", "form"))) for _ in range(rng.random() < 0.15)]
        ends = [x() for x, p in ((side, 0.4), (comments, 0.35), (ad, 0.2), (notice, 0.15), (form, 0.15), (share, 0.2), (nav, 0.15)) if rng.random() < p]
        rng.shuffle(tops)
        main = article()
        if rng.random() < 0.3:
            main = (rng.choice(("main", "div", "div", "section")), rng.choice(("", named("main", "container", "wrapper", "page", "layout", "row", "col", "site", "inner", "outer", "root", "app"))), False, [*maybe(0.3, nav()), main, *maybe(0.4, side()), *maybe(0.3, comments())])
        ends.append(footer() if rng.random() < 0.7 else bare("footer"))
        loose = rng.random() < 0.15  # the article's blocks stand right in the body, or in nothing at all
        if loose:
            head, blocks = parts()
            if rng.random() < 0.5:
                tops, ends = [x for x in tops if rng.random() < 0.4], [x for x in ends if rng.random() < 0.4]
            in_body = rng.random() < 0.7
            whole = [*tops, *head, *blocks, *ends]
        else:
            in_body = rng.random() < 0.95
            whole = [*tops, main, *ends]
        if not loose and rng.random() < 0.08:
            whole = [("form", "", False, whole)]
        if not loose and rng.random() < 0.3:
            whole = [("div", rng.choice(("", named("wrapper", "container", "page", "site", "app", "root", "outer"))), False, whole)]
        labels: list[bool] = []

        def written(node) -> str:
            if isinstance(node, str):
                return node
            tag, attributes, label, children = node
            labels.append(label)
            return f"<{tag}{attributes}>{''.join(map(written, children))}</{tag}>"

        yield written(("html", "", False, [("body", "", loose, whole)])) if in_body else "".join(map(written, whole)), labels


_models: list[TreeModel] = []


def model() -> TreeModel:
    """The model of :func:`labelled_pages`, trained once in each process."""
    if not _models:
        _models.append(train(labelled_pages()))
    return _models[0]


def extract(df: DataFrame, html_col: str = "html", keep: list[str] | None = None, trained: TreeModel | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (default: all but the page itself), text and n_chars.

    Null or empty pages, and those without content, give empty text and 0.
    Every row gives a row; a column of ``df`` named like a result column is
    replaced by it.  Pages are read whole, in one narrow pass.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("text", "n_chars", html_col)]
    found = trained or model()
    # Inside, columns have numbers, so that no name can clash.
    sent = df.select(*[column(c).alias(f"c{k}") for k, c in enumerate(keep)], column(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 8 << 20):
            texts = [found.text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*keep, "text", "n_chars"])

    fields = [T.StructField(c, f.dataType, f.nullable) for c, f in zip(keep, sent.schema.fields, strict=False)]
    return sent.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
