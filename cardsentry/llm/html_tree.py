"""Main text of web pages by sum-product on the DOM tree (operator 6).

A tolerant parser turns a page into a tree of block elements and text blocks.
Every node has a hidden state: boilerplate, content, or an element that holds
both.  The model is a tree-structured distribution: a prior for the root, a
parent-child table, and for each node the
likelihood of its features (tag, words of class, id and role, text length, share
of linked text).  Sum-product passes messages up and down the tree and yields
each text block's probability of being content; blocks of 0.5 or more are the
text, in page order.

The tables are counts over labelled pages, summed over partitions: the labelled
layouts in ``labelled_pages`` and a bounded sample of ``TRAIN_PAGES`` pages that
mark their main text themselves (article, main).  All pages are then extracted.

Formulas (math) are text of the line they stand in; their annotations, the same
formula in another notation, are left out.  So is the fallback of object, audio,
video, canvas and iframe (a message for browsers that cannot show them), and what
a page does not show as text: scripts, styles, templates, noscript, head, the
labels of drawings (svg) and the choices and captions of select, datalist and button.

Defined cases: null or empty html gives an empty text; broken markup is closed
the way browsers do, unknown tags are plain containers; markup without text has
no blocks; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import LAYOUTS
from .shared import about, ship
from .words import slices

TRAIN_PAGES = 2000
LAYOUT_WEIGHT = 40.0
SMOOTH = 0.5
THRESHOLD = 0.5
TEMPER = 0.4
STATES = BOILER, CONTENT, MIXED = 0, 1, 2
NEUTRAL = (0.0, 0.0, 0.0)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style textarea title xmp iframe noembed noframes noscript template head svg select button object audio video canvas datalist annotation annotation-xml".split())
MATH = frozenset(
    "math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()) | MATH
# an open element of the key's group is closed by the start of one of these
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul center dir summary".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "thead": {"tr", "td", "th", "thead", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
STOPS = frozenset("ul ol dl table body html article section div td th".split())

# words in class, id and role that tell what an element is for
LEXICON = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc tabs toolbar topbar skip",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more popular trending archive archives tags tagcloud teaser",
    "frame": "footer foot header masthead banner copyright legal colophon contentinfo branding logo top bottom",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted outbrain taboola dfp affiliate partner",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog banner-notice disclaimer toast paywall warning privacy",
    "comment": "comment comments commentlist disqus discussion replies reply respond reviews feedback",
    "form": "form search searchbox login signin signup subscribe subscription newsletter register contact poll survey",
    "share": "share sharing social follow facebook twitter byline meta author avatar metadata postmeta",
    "main": "article content post entry story body main text articlebody hentry page-content maincontent copy prose",
}
_CATEGORY = {w: c for c, words in LEXICON.items() for w in words.split()}
_TAGS = frozenset("html body div article main section nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th tbody blockquote pre figure figcaption address".split())

_ATTR = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_PART = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "kinds", "parent", "children", "parts", "chars", "linked", "label", "inside")

    def __init__(self, tag: str, kinds: frozenset, parent: "Node | None", label: int | None = None):
        self.tag, self.kinds, self.parent, self.label = tag, kinds, parent, label
        self.children: list[Node] = []
        self.parts: list[str] | None = None
        self.chars = self.linked = 0
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)


def _kinds(attrs: str) -> tuple[frozenset, int | None]:
    found, label = set(), None
    for name, a, b, c in _ATTR.findall(attrs):
        name = name.lower()
        if name in ("class", "id", "role"):
            parts = _PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower())
            found.update(_CATEGORY[p] for p in parts if p in _CATEGORY)
        elif name == "data-content":
            label = int((a or b or c) == "1")
    return frozenset(found), label


class _Tags:
    """Tags, comments and declarations of a page, found in time linear in its length.

    A tag ends at the first ``>`` outside of quotes; if its quotes do not close, at
    the first ``>`` of all.  The quotes at which a search ran to the page's end
    without success are noted, so that no later search follows them again.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.open_ended: set[int] = set()

    def find(self, at: int) -> tuple[int, int] | None:
        """Start and end of the next one from ``at``; the end is -1 for a tag that the page breaks off."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                close = page.find("-->", at + 4)
                return at, close + 3 if close >= 0 else len(page)
            if page.startswith(("<!", "<?"), at):
                if at < self.last:
                    return at, page.find(">", at) + 1
            elif name := _NAME.match(page, at):
                return at, self._end(at, name.end()) if at < self.last else -1
            at += 1
        return None

    def _end(self, start: int, at: int) -> int:
        page, seen = self.page, []
        while (stop := _STOP.search(page, at)) and stop.start() not in self.open_ended:
            at = stop.start()
            if page[at] == ">":
                return at + 1
            seen.append(at)
            at = page.find(page[at], at + 1) + 1
            if at == 0:
                break
        self.open_ended.update(seen)
        return page.find(">", start) + 1


def parse(page: str) -> tuple[list[Node], list[Node]]:
    """All nodes in document order (parents first), and the text blocks among them."""
    root = Node("html", frozenset(), None)
    nodes, blocks = [root], []
    # open elements: (tag, block node that holds its text, hidden, in a link)
    stack: list[tuple[str, Node, bool, bool]] = [("html", root, False, False)]
    # places in the stack: of each tag; of blocks; of what a p does not reach beyond; of list and table parts and their bounds
    opened: dict[str, list[int]] = {}
    blocked, firm, listed = [0], [0], [0]
    leaf: Node | None = None
    at = 0

    def add_text(raw: str) -> None:
        nonlocal leaf
        tag, holder, hidden, linked = stack[-1]
        if hidden or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if leaf is None:
            if not text.strip():
                return
            leaf = Node("#text", frozenset(), holder)
            leaf.parts = []
            holder.children.append(leaf)
            nodes.append(leaf)
            blocks.append(leaf)
        leaf.parts.append(text)
        n = len(text.strip())
        leaf.chars += n
        leaf.linked += n if linked else 0

    def push(name: str, *entry) -> None:
        depth = len(stack)
        stack.append((name, *entry))
        opened.setdefault(name, []).append(depth)
        if name not in INLINE:
            blocked.append(depth)
        if name not in INLINE or name == "annotation-xml":
            firm.append(depth)
        if name in SIBLINGS or name in STOPS:
            listed.append(depth)

    def pop_to(depth: int) -> None:
        nonlocal leaf
        if blocked[-1] >= depth or stack[depth][1] is not stack[depth - 1][1]:
            leaf = None
        for entry in stack[depth:]:
            opened[entry[0]].pop()
        del stack[depth:]
        for places in (blocked, firm, listed):
            while places[-1] >= depth:
                places.pop()

    end = len(page)
    tags = _Tags(page)
    while at < end:
        found = tags.find(at)
        if found is None:
            add_text(page[at:])
            break
        add_text(page[at : found[0]])
        token, at = page[found[0] : found[1]], found[1]
        if at < 0:
            # an unfinished tag at the very end is dropped
            break
        if token[1] in "!?":
            continue
        name = _NAME.match(token)[1].lower()
        if token[1] == "/":
            # an inline element is not closed from within a block inside it
            if opened.get(name) and not (name in INLINE and blocked[-1] > opened[name][-1]):
                pop_to(opened[name][-1])
            if name == "br":
                add_text(" ")
            continue
        if name == "br":
            if leaf is not None:
                leaf.parts.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                leaf = None
            continue
        if name in CLOSES_P and stack[firm[-1]][0] == "p":
            pop_to(firm[-1])
        if name in SIBLINGS:
            for i in range(len(listed) - 1, 0, -1):
                depth = listed[i]
                if stack[depth][0] in SIBLINGS[name]:
                    pop_to(depth)
                    if name not in ("thead", "tbody", "tfoot", "tr"):
                        break
                elif stack[depth][0] in STOPS:
                    break
        if name == "body" or name == "html":
            kinds, label = _kinds(token)
            if name == "body" and label is not None:
                root.label = label
            while len(stack) > 1 and name == "body":
                pop_to(len(stack) - 1)
            continue
        _, holder, hidden, linked = stack[-1]
        hidden = hidden or name in HIDDEN
        if name in RAW:
            close = re.compile(f"</{name}\\b", re.I).search(page, at)
            at = page.find(">", close.end()) + 1 if close else 0
            at = at or end
            continue
        kinds, label = _kinds(token) if "=" in token else (frozenset(), None)
        if token.endswith("/>") and (name in MATH or name in ("path", "use", "circle", "rect", "g")):
            continue
        block = name not in INLINE
        if not hidden and (block or label is not None or (kinds and name != "a" and name not in MATH)):
            node = Node(name, kinds, holder, label)
            holder.children.append(node)
            nodes.append(node)
            holder = node
            leaf = None
        push(name, holder, hidden, linked or name == "a")
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return nodes, blocks


def _bin(n: int) -> int:
    return min(6, int(math.log2(n + 1) / 1.5))


def features(node: Node) -> list[str]:
    """Discrete features of a node."""
    share = node.linked / node.chars if node.chars else 0.0
    links = f"l{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}"
    if node.tag == "#text":
        text = "".join(node.parts).rstrip()
        stop = text[-1:] in ".!?:;»”\""
        holder = node.parent.tag if node.parent.tag in _TAGS else "other"
        return [f"t:{holder}", f"t:n{_bin(node.chars)}", f"t:{links}", f"t:stop{int(stop)}"]
    tag = node.tag if node.tag in _TAGS else "other"
    if tag in ("header", "footer"):
        # the page's own, or an article's
        tag += "-inside" if node.inside else "-page"
    out = [f"e:{tag}", f"e:{links}" if node.chars else "e:none"]
    # an element that is named for a purpose other than the text is told by that name alone
    named = [k for k in node.kinds if k != "main"] or list(node.kinds)
    return out + [f"k:{k}" for k in sorted(named)]


class Model:
    """Log prior, parent-child table and feature likelihoods over the states BOILER, CONTENT and MIXED."""

    def __init__(self, counts: dict[str, float]):
        get = lambda k: counts.get(k, 0.0)
        total = [get(f"n|{y}") for y in STATES]
        roots = sum(get(f"root|{y}") for y in STATES)
        self.prior = [math.log((get(f"root|{y}") + SMOOTH) / (roots + 3 * SMOOTH)) for y in STATES]
        pairs = [[get(f"pair|{p}{c}") + SMOOTH for c in STATES] for p in STATES]
        self.step = [[math.log(n / sum(row)) for n in row] for row in pairs]
        self.like: dict[str, tuple[float, ...]] = {}
        for f in {k[2:-2] for k in counts if k.startswith("f|")}:
            self.like[f] = tuple(math.log((get(f"f|{f}|{y}") + SMOOTH) / (total[y] + 3 * SMOOTH)) for y in STATES)

    def _own(self, node: Node) -> list[float]:
        if node.tag == "#text":
            # its features say much the same, so they do not count as separate evidence in full
            a, b, _ = (TEMPER * sum(x) for x in zip(*(self.like.get(f, NEUTRAL) for f in features(node))))
            return [a, b, -1e9]  # a text block is never mixed
        return [sum(x) for x in zip(*(self.like.get(f, NEUTRAL) for f in features(node)))]

    def marginals(self, nodes: list[Node]) -> dict[int, float]:
        """Probability of content for every text block (by its place in ``nodes``)."""
        place = {id(n): i for i, n in enumerate(nodes)}
        s = self.step
        inside = [self._own(n) for n in nodes]
        up: list = [NEUTRAL] * len(nodes)
        # leaves to root: what a subtree says about its parent's state
        for i in range(len(nodes) - 1, 0, -1):
            mine = inside[i]
            m = up[i] = tuple(_add(*(s[p][c] + mine[c] for c in STATES)) for p in STATES)
            above = inside[place[id(nodes[i].parent)]]
            for p in STATES:
                above[p] += m[p]
        # root to leaves: all that the rest of the page says
        outside: list = [self.prior] * len(nodes)
        out = {}
        for i, n in enumerate(nodes):
            if i:
                j = place[id(n.parent)]
                rest = [outside[j][p] + inside[j][p] - up[i][p] for p in STATES]
                outside[i] = [_add(*(rest[p] + s[p][c] for p in STATES)) for c in STATES]
            if n.tag == "#text":
                d = outside[i][BOILER] + inside[i][BOILER] - outside[i][CONTENT] - inside[i][CONTENT]
                out[i] = 1 / (1 + math.exp(min(d, 700)))
        return out

    def extract(self, page: str) -> str:
        """The main text: blocks that are likely content, white space collapsed, joined by one space."""
        nodes, _ = parse(page)
        p = self.marginals(nodes)
        kept = ("".join(nodes[i].parts) for i in sorted(p) if p[i] >= THRESHOLD)
        return " ".join(" ".join(kept).split())


def _add(a: float, b: float, c: float) -> float:
    """log(exp(a) + exp(b) + exp(c))"""
    m = max(a, b, c)
    return m + math.log(math.exp(a - m) + math.exp(b - m) + math.exp(c - m))


def count(page: str, labelled: bool, weight: float) -> Counter:
    """Sufficient statistics of one labelled page; nothing if it has no label.

    ``labelled`` pages carry data-content marks, others are labelled by article
    and main and by what elements are named for.
    """
    nodes, blocks = parse(page)
    label: dict[int, int] = {}
    if not labelled and not any(n.tag in ("article", "main") for n in nodes):
        return Counter()
    for n in nodes:
        above = label.get(id(n.parent), 0)
        if labelled:
            label[id(n)] = above if n.label is None else n.label
        elif n.tag in ("article", "main") and "comment" not in n.kinds:
            label[id(n)] = 1
        else:
            other = n.tag in ("nav", "aside", "footer", "form") or (n.kinds and "main" not in n.kinds)
            label[id(n)] = 0 if other else above
    # an element is mixed if it holds text of both kinds
    mine = {id(n): (n.chars if label[id(n)] else 0) if n.tag == "#text" else 0 for n in nodes}
    for n in reversed(nodes):
        if n.parent is not None:
            mine[id(n.parent)] += mine[id(n)]
    y = {id(n): BOILER if not mine[id(n)] else CONTENT if mine[id(n)] == n.chars else MIXED for n in nodes}
    out: Counter = Counter()
    for n in nodes:
        if not n.chars:
            continue
        of = y[id(n)]
        out[f"n|{of}"] += weight
        out[f"pair|{y[id(n.parent)]}{of}" if n.parent is not None else f"root|{of}"] += weight
        for f in features(n):
            out[f"f|{f}|{of}"] += weight
    return out


def fit(pages: DataFrame, sample: int = TRAIN_PAGES) -> Model:
    """Model from the labelled layouts and about ``sample`` self-labelled pages (chosen by hash, each text once)."""
    ship(pages.sparkSession)
    total: Counter = Counter()
    for page in LAYOUTS:
        total.update(count(page, True, LAYOUT_WEIGHT))

    def run(batches):
        for batch in slices(batches, "html"):
            got: Counter = Counter()
            for page in batch.column("html").to_pylist():
                got.update(count(page or "", False, 1.0))
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.float64())], names=["k", "n"])

    texts = pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
    chosen = about(texts, F.xxhash64("html"), sample).distinct()
    # the keys are features and labels: a few hundred, whatever the pages
    counts = chosen.repartition(8).mapInArrow(run, "k string, n double").groupBy("k").agg(F.sum("n").alias("n")).collect()
    total.update({r["k"]: r["n"] for r in counts})
    return Model(total)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages(page_id, url, html)``."""
    ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(model or fit(pages))

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [held.value.extract(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                names=["page_id", "url", "text", "n_chars"])

    typed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return typed.mapInArrow(run, "page_id long, url string, text string, n_chars long")
