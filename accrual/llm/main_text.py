"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is read into a tree of its block elements. Every node gets features: its kind of tag, tokens of
its attributes and of its ancestors', depth, density of text, links and punctuation in its subtree,
place among its siblings and in the page. Boosted trees give the odds that a node holds article text.
Decoding is hierarchical: dropping a node drops its subtree, and of all choices without
contradiction the one with the highest total log odds is taken.

The trees are trained (by Spark's ``GBTClassifier``) on a sample of at most about ``TRAINING_PAGES``
pages. Pages come without labels, so each sampled page is taken apart into its article and its other
texts by the tags that name them, and put together again in ``LAYOUTS`` random layouts, whose labels are
known; how nodes of an unseen layout look is learned from those.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import free_name, stored

TRAINING_PAGES = 400
LAYOUTS = 4
ROUNDS = 20
DEPTH = 5
SEED = 7

# Element names of HTML by what they mean for the tree.
SKIPPED = {"script", "style", "template", "head", "title"}
# What stands in for something else.
EMBEDDED = {"noscript", "object", "iframe", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TEXT_BLOCKS = {"p", "blockquote", "pre", "dd", "figcaption", "address"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ITEMS = {"li", "dt", "td", "th", "tr", "option", "summary", "caption"}
ARTICLES = {"article", "main"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "select", "textarea", "button", "label", "legend"}
GENERIC = {"body", "div", "section", "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "center", "figure", "details", "hgroup", "search", "ins"} | EMBEDDED
# These stay in the run of text that they are in; elsewhere they are elements of their own.
PHRASING = EMBEDDED | {"ins", "label", "button"}
RUNS = {"p", "pre", "figcaption"} | HEADINGS
BLOCKS = TEXT_BLOCKS | HEADINGS | ITEMS | ARTICLES | OUTSIDE | GENERIC
CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# Words in class, id and role that speak for and against article text.
FOR = {"article", "content", "main", "post", "entry", "story", "body", "text", "maincontent", "articlebody", "blog", "page"}
AGAINST = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "banner", "topbar",
    "footer", "bottom", "copyright", "legal", "sidebar", "side", "aside", "widget", "related", "recommended",
    "recommendations", "secondary", "complementary", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "dialog",
    "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "form", "share", "sharing", "social",
    "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "responses", "reader",
    "pagination", "pager", "tags", "toolbar", "skip", "contentinfo", "byline", "teaser", "outbrain", "taboola",
}
_SPLIT = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_WHITE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?]")
MARK = "data-main"


class Node:
    __slots__ = ("tag", "parent", "at", "depth", "tokens", "mark", "children", "place", "kinds", "chars", "linked", "points")

    def __init__(self, tag, parent, at, depth, tokens, mark, place=0):
        self.tag, self.parent, self.at, self.depth = tag, parent, at, depth
        self.tokens, self.mark, self.children = tokens, mark, []
        self.place, self.kinds = place, {}  # among the siblings; how many children have a tag
        self.chars = self.linked = self.points = 0


class Page(HTMLParser):
    """The block elements of a page and its text blocks, in page order.

    ``blocks`` holds (node number, text); white space is one space, character references are decoded.
    ``skip`` holds the open elements without text and the blocks open in them, ``inline`` the open
    phrasing elements inside a run of text, which are no nodes. An advert's ``ins`` is one and leaves its
    paragraph open.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("body", -1, 0, 0, frozenset(), False)]
        self.blocks: list[tuple[int, str]] = []
        self.stack = [0]
        self.skip: list[str] = []
        self.inline: list[str] = []
        self.link = False
        self.run: list[str] = []
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.run:
            text = _WHITE.sub(" ", "".join(self.run)).strip()
            self.run = []
            if text:
                node = self.stack[-1]
                self.blocks.append((node, text))
                self.nodes[node].points += len(_PUNCTUATION.findall(text))

    def _leave(self, depth: int) -> None:
        self.flush()
        del self.stack[depth:]
        self.inline.clear()
        self.link = False

    def handle_starttag(self, tag, attrs):
        if self.skip:
            in_head = self.skip[0] == "head" and set(self.skip) <= {"head", "noscript"}
            if tag == "body" or in_head and tag != "noscript" and (tag in BLOCKS or tag in ("svg", "math")):
                self.skip.clear()
            elif tag in SKIPPED or tag in BLOCKS:
                self.skip.append(tag)
                return
            else:
                return
        if tag in SKIPPED:
            self.skip.append(tag)
            return
        if tag == "a":
            self.link = True
        elif tag in ("br", "hr"):
            self.run.append(" ")
        if tag in VOID or tag not in BLOCKS or tag == "body":
            return
        tokens, mark = set(), False
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                tokens.update(t.lower() for t in _SPLIT.findall(value))
            mark |= name == MARK
        names = [self.nodes[i].tag for i in self.stack]
        if tag in PHRASING and names[-1] in RUNS and not (tag == "ins" and tokens & AGAINST):
            self.inline.append(tag)
            return
        self.flush()
        if names[-1] == "p" and tag not in PHRASING:
            self._leave(len(self.stack) - 1)
            names.pop()
        if tag in CLOSES:
            for depth in range(len(names) - 1, 0, -1):
                if names[depth] in CLOSES[tag]:
                    break
                if names[depth] == tag or (tag in ("td", "th") and names[depth] in ("td", "th")):
                    self._leave(depth)
                    break
        parent = self.stack[-1]
        siblings, kinds = self.nodes[parent].children, self.nodes[parent].kinds
        node = Node(tag, parent, len(self.nodes), len(self.stack), tokens, mark, len(siblings))
        siblings.append(node.at)
        kinds[tag] = kinds.get(tag, 0) + 1
        self.stack.append(node.at)
        self.nodes.append(node)

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIPPED and tag not in PHRASING:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag):]
                return
            # The end of a block around what is skipped ends that too.
            if tag not in BLOCKS or all(self.nodes[i].tag != tag for i in self.stack[1:]):
                return
            self.skip.clear()
        if tag == "a":
            self.link = False
        if tag not in BLOCKS or tag == "body":
            return
        if tag in self.inline:
            del self.inline[len(self.inline) - 1 - self.inline[::-1].index(tag):]
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.nodes[self.stack[depth]].tag == tag:
                self._leave(depth)
                return

    def handle_data(self, data):
        if self.skip:
            return
        self.run.append(data)
        size = len(data) - data.count(" ")
        node = self.nodes[self.stack[-1]]
        node.chars += size
        if self.link:
            node.linked += size


FEATURES = 29


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` numbers for every node."""
    nodes = page.nodes
    count = len(nodes)
    chars, linked, points = ([getattr(n, a) for n in nodes] for a in ("chars", "linked", "points"))
    size = [1] * count
    for i in range(count - 1, 0, -1):
        up = nodes[i].parent
        chars[up] += chars[i]
        linked[up] += linked[i]
        points[up] += points[i]
        size[up] += size[i]
    total = chars[0] + 1
    before, seen = [0] * count, 0
    for i, n in enumerate(nodes):
        before[i] = seen
        seen += n.chars
    out = np.zeros((count, FEATURES))
    good, bad, article, outside = ([0] * count for _ in range(4))
    for i, n in enumerate(nodes):
        up = n.parent
        own_good, own_bad = len(n.tokens & FOR), len(n.tokens & AGAINST)
        own_article, own_outside = n.tag in ARTICLES, n.tag in OUTSIDE
        if i:
            good[i], bad[i] = good[up] + own_good, bad[up] + own_bad
            article[i], outside[i] = article[up] + own_article, outside[up] + own_outside
            siblings = nodes[up].children
            place, alike = n.place, nodes[up].kinds[n.tag]
            left = siblings[place - 1] if place else up
            right = siblings[place + 1] if place + 1 < len(siblings) else up
        else:
            siblings, place, alike, left, right = [0], 0, 1, 0, 0
        c = chars[i]
        out[i] = (
            n.tag in TEXT_BLOCKS, n.tag in HEADINGS, n.tag in ITEMS, own_article, own_outside,
            n.tag in GENERIC, own_good, own_bad, good[i], bad[i], article[i], outside[i],
            n.depth, np.log1p(c), linked[i] / (c + 1), points[i] / (c + 1), c / size[i], size[i],
            len(n.children), len(siblings), place / len(siblings), alike / len(siblings),
            before[i] / total, c / total, chars[up] / total if i else 1.0,
            linked[up] / (chars[up] + 1) if i else 0.0, np.log1p(chars[left]), np.log1p(chars[right]),
            len(n.tokens),
        )
    return out


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes stay: the best choice in which no node stays below one that is dropped."""
    keep = np.log(np.clip(odds, 1e-4, 1 - 1e-4))
    drop = np.log(np.clip(1 - odds, 1e-4, 1 - 1e-4))
    dropped, best = drop.copy(), keep.copy()
    nodes = page.nodes
    for i in range(len(nodes) - 1, 0, -1):
        best[i] = max(best[i], dropped[i])
        dropped[nodes[i].parent] += dropped[i]
        best[nodes[i].parent] += best[i]
    stays = np.zeros(len(nodes), dtype=bool)
    stays[0] = True
    for i in range(1, len(nodes)):
        stays[i] = stays[nodes[i].parent] and best[i] > dropped[i]
    return stays


# Training pages

_LINK_CLASSES = ["menu", "nav", "navbar", "navigation", "top-menu", "mainNav"]
_ARTICLES = [
    ("article", ""), ("main", ""), ("article", 'class="post"'), ("div", 'class="content"'), ("div", 'id="main-content"'),
    ("div", 'class="entry-content"'), ("section", 'class="story"'), ("div", 'id="articleBody"'), ("div", ""), ("td", ""),
    ("div", 'class="post-body"'), ("div", 'class="text"'), ("div", 'role="main"'),
]
_NOTICES = ['class="cookie-notice"', 'id="gdpr-consent"', 'role="dialog" class="consent"', 'class="alert notice"', 'class="cookie-banner"']
_ADS = ['class="ad"', 'class="advert"', 'id="sponsored"', 'class="ads box"', 'class="promo"', 'class="ad-slot"']
_SIDES = [("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="secondary"'), ("aside", 'class="widget"'), ("div", 'class="related-posts"')]
_COMMENTS = [("section", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="reader-comments"'), ("div", 'id="disqus_thread"'), ("section", 'id="discussion"')]
_HEADS = [("header", ""), ("div", 'id="header"'), ("div", 'class="site-header"'), ("div", 'class="masthead"')]
_FEET = [("footer", ""), ("div", 'id="footer"'), ("div", 'class="site-footer"'), ("footer", 'class="bottom"')]


def take_apart(page: Page) -> tuple[list[str], list[str]]:
    """Texts of the article (by tags or attributes that name it, else of the richest parent), and others."""
    nodes = page.nodes
    inside, out = [False] * len(nodes), [False] * len(nodes)
    for i in range(1, len(nodes)):
        n, up = nodes[i], nodes[i].parent
        inside[i] = inside[up] or n.tag in ARTICLES or bool(n.tokens & FOR and not n.tokens & AGAINST)
        out[i] = out[up] or n.tag in OUTSIDE or bool(n.tokens & AGAINST)
    if not any(inside[i] for i, _ in page.blocks):
        weight: dict[int, int] = {}
        for i, text in page.blocks:
            if not out[i]:
                weight[nodes[i].parent] = weight.get(nodes[i].parent, 0) + len(text)
        richest = max(weight, key=weight.get, default=-1)
        inside = [n.parent == richest for n in nodes]
    article = [t for i, t in page.blocks if inside[i] and not out[i]]
    return article, [t for i, t in page.blocks if not inside[i] or out[i]]


def relayout(article: list[str], other: list[str], dice: random.Random) -> str:
    """A page with these texts in a random layout; blocks of the article carry the mark."""
    pick, maybe = dice.choice, lambda p: dice.random() < p
    other = other or ["Home", "About", "Contact"]

    def words(n: int) -> str:
        return " ".join(pick(pick([other, article or other])).split()[:n]) or "More"

    def prose() -> str:
        return pick(article or other) if maybe(0.7) else pick(other)

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(2)}</a></li>' for _ in range(n)) + "</ul>"

    def wrap(kind: tuple[str, str], inner: str) -> str:
        return f"<{kind[0]} {kind[1]}>{inner}</{kind[0]}>"

    def nav() -> str:
        inner = links(dice.randint(2, 8))
        return f"<nav>{inner}</nav>" if maybe(0.5) else f'<div class="{pick(_LINK_CLASSES)}">{inner}</div>'

    def form() -> str:
        attrs = pick(["", 'class="newsletter"', 'id="search"', 'class="signup"'])
        return f"<form {attrs}><label>{words(3)}</label><input><button>{words(1)}</button></form>"

    def advert() -> str:
        return f"<div {pick(_ADS)}>{'<p>' + prose() + '</p>' if maybe(0.4) else prose()}</div>"

    def comments() -> str:
        one = lambda: f'<div class="{pick(["comment", "reply", "item"])}"><b>{words(2)}</b><p>{prose()}</p></div>'
        heading = f"<h3>{words(2)}</h3>" if maybe(0.5) else ""
        return wrap(pick(_COMMENTS), heading + "".join(one() for _ in range(dice.randint(1, 5))))

    def side() -> str:
        inner = f"<h3>{words(2)}</h3>" + (links(dice.randint(2, 6)) if maybe(0.7) else f"<p>{prose()}</p>")
        return wrap(pick(_SIDES), inner)

    def foot() -> str:
        inner = prose() if maybe(0.5) else f"<p>{prose()}</p>"
        return wrap(pick(_FEET), (links(3) if maybe(0.4) else "") + inner)

    tag = pick(["p", "p", "p", "div", "li"])
    body = []
    for i, text in enumerate(article):
        own = pick(["h1", "h2"]) if i == 0 and maybe(0.7) else "h2" if len(text) < 60 and maybe(0.2) else tag
        style = pick(["", "", "<b>", "<a href='/y'>ref</a> "]) if own == tag else ""
        text = text.replace("&", "&amp;").replace("<", "&lt;")
        body.append(f"<{own} {MARK}>{style}{text}" + (f"</{own}>" if maybe(0.9) or own != "p" else ""))
        if maybe(0.06):
            body.append(pick([advert, form, side])())
    inner = "".join(body)
    if tag == "li":
        inner = f"<ul>{inner}</ul>"
    main = wrap(pick(_ARTICLES), inner)
    if maybe(0.3):
        main = wrap(pick([("main", ""), ("div", 'id="content"'), ("div", 'class="container"'), ("div", "")]), main)
    if maybe(0.1):
        main = f"<table><tr><td>{nav()}</td>{main if main.startswith('<td') else '<td>' + main + '</td>'}</tr></table>"
    parts = [wrap(pick(_HEADS), f"<a href='/'>{words(2)}</a>" + nav()) if maybe(0.5) else nav()]
    for chance, make in ((0.4, advert), (0.3, lambda: f"<div {pick(_NOTICES)}><p>{prose()}</p></div>"), (0.2, side)):
        if maybe(chance):
            parts.append(make())
    parts.append(main)
    for chance, make in ((0.4, side), (0.4, comments), (0.3, form), (0.2, advert), (0.8, foot)):
        if maybe(chance):
            parts.append(make())
    page = "".join(parts)
    if maybe(0.4):
        page = f'<div class="{pick(["page", "wrapper", "container", "site"])}">{page}</div>'
    return page


def training_nodes(html: str, layouts: int, seed: int) -> Iterator[tuple[list[float], float]]:
    """Features and labels of the nodes of random layouts of one page; a node's label is whether its
    subtree has article text."""
    article, other = take_apart(Page(html))
    dice = random.Random(seed)
    for _ in range(layouts if article else 0):
        page = Page(relayout(article, other, dice))
        label = [n.mark for n in page.nodes]
        for i in range(len(label) - 1, 0, -1):
            label[page.nodes[i].parent] |= label[i]
        for row, kept in zip(features(page)[1:], label[1:]):
            yield row.tolist(), float(kept)


def _training_frames(layouts: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                node
                for html, seed in zip(frame["html"], frame["seed"])
                for node in training_nodes(html, layouts, int(seed))
            ]
            yield pd.DataFrame(rows, columns=["values", "label"])

    return run


Trees = list[tuple[float, np.ndarray]]


def _flat(tree, weight: float) -> tuple[float, np.ndarray]:
    """A fitted tree as rows of (feature, threshold, left, right, value); leaves have feature -1."""
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0, 0, 0, node.prediction()])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            rows[at][:2] = [split.featureIndex(), split.threshold()]
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        return at

    walk(tree._call_java("rootNode"))
    return weight, np.array(rows)


def train_trees(
    pages: DataFrame, most: int = TRAINING_PAGES, layouts: int = LAYOUTS, rounds: int = ROUNDS, depth: int = DEPTH
) -> Trees:
    """Boosted trees from a random sample of about ``most`` pages at most.

    Without a page that has text there is nothing to learn, and no trees are returned.
    """
    known = pages.where(F.col("html").isNotNull())
    number = known.count()
    sample = known.sample(min(1.0, most / max(number, 1)), seed=SEED).select(
        "html", F.xxhash64("html").alias("seed")
    )
    nodes = sample.mapInPandas(_training_frames(layouts), "values array<double>, label double")
    nodes = stored(nodes, "training-nodes")
    if nodes.select("label").distinct().count() < 2:
        return []
    boosting = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=SEED, maxBins=64)
    model = boosting.fit(nodes.select(array_to_vector("values").alias("features"), "label"))
    return [_flat(tree, weight) for tree, weight in zip(model.trees, model.treeWeights)]


def odds_of(values: np.ndarray, trees: Trees) -> np.ndarray:
    """Probability of article text for rows of features."""
    score = np.zeros(len(values))
    rows = np.arange(len(values))
    for weight, tree in trees:
        at = np.zeros(len(values), dtype=np.int64)
        while True:
            feature = tree[at, 0].astype(np.int64)
            inner = feature >= 0
            if not inner.any():
                break
            left = values[rows, np.maximum(feature, 0)] <= tree[at, 1]
            at = np.where(inner, np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64), at)
        score += weight * tree[at, 4]
    return 1 / (1 + np.exp(-2 * score))


def main_texts(htmls: list[str], trees: Trees) -> list[str]:
    """Main text of each page."""
    pages = [Page(h) for h in htmls]
    values = [features(p) for p in pages]
    odds = odds_of(np.concatenate(values), trees) if pages else np.empty(0)
    texts, at = [], 0
    for page in pages:
        stays = decode(page, odds[at : at + len(page.nodes)])
        at += len(page.nodes)
        texts.append("\n".join(t for i, t in page.blocks if stays[i]))
    return texts


def extract_main_text(pages: DataFrame, trees: Trees, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (empty where there is none) and ``n_chars`` (columns so named are replaced).

    A NULL html has no text. Pages are read whole, equal pages give equal texts. Without trees no
    node can be told from another, and every text is empty.
    """
    kept = pages.drop("text", "n_chars")
    shipped = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def extract(column: pd.Series) -> pd.Series:
        out: list[str] = []
        for at in range(0, len(column), 256):
            out += main_texts(column.iloc[at : at + 256].tolist(), shipped.value)
        return pd.Series(out, dtype=object)

    if not trees:
        return kept.withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long"))
    found = extract(F.coalesce(F.col(html), F.lit("")))
    text = free_name(kept, "_text")
    return kept.withColumn(text, found).select(
        *kept.columns, F.col(text).alias("text"), F.char_length(text).cast("long").alias("n_chars")
    )
