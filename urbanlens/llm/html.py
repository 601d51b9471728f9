"""Main-text extraction with boosted trees over DOM nodes (operator 4).

A page is parsed into its block elements (inline elements only add to the text and to
the link length of the block they are in). A run of text beside block elements of the same
parent is a leaf of its own, so it can be rejected where its parent is kept. Every node has features: text and link
density of its subtree, attribute tokens, tag, depth and statistics of its siblings,
and the same of its ancestors. Gradient-boosted trees (``pyspark.ml``), trained on a
bounded sample of pages, score how likely an element belongs to the article.

Decoding is hierarchical: an element below a rejected one is rejected, so the chosen set
is the one of the highest total score among those closed under parents (one pass from
the leaves up, one down). No ancestor and descendant can contradict each other.

Training labels come from pages that mark their article (``article``, ``main``): what
stands inside, outside of marked boilerplate, is article, the rest isn't. A ``header`` with
a heading inside an ``article`` is the article's title, not boilerplate. Copies with
boilerplate of further kinds put in, and with their telling tags or attributes hidden,
teach the trees to use text density and structure where a page marks nothing.

Text: character references are decoded, white space inside a block becomes one space,
``br`` counts as white space, blocks are trimmed, empty ones left out, and joined in
page order by an empty line. Scripts, styles, the head, titles, templates, drawings (svg),
frames, comments and controls of forms have no text; ``noscript`` has. A head ends at its
closing tag or at the first tag or text that can't stand in it. One of the other elements
ends at its closing tag; written as ``<x/>`` it is empty; if it isn't closed before the end
of the block it is in, it ends at the next tag of a block. A script or style that isn't
closed, and a comment, go on to the end of the page, as in browsers.

Defined cases: a null or empty page, or one without text, gives an empty text; unclosed
and unmatched tags are tolerated; a null id or url is kept (a null id is not in the
training sample); repeated rows give equal results; without a usable training page the
marking rule itself decides; an empty table gives an empty result; other columns are
ignored. Pages are read whole.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 300  # bound of the training sample: the pages of the smallest id hashes
TREES, DEPTH = 15, 4

_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+"  # a quote counts at the start of a value
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    rf"|<(script|style)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})>", re.S | re.I)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")

#: Block elements; others are inline.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre "
    "figure figcaption nav header footer aside form fieldset address details summary center hr".split())
VOID = frozenset("br hr img input meta link wbr col source area base embed track param".split())
#: Elements without text, besides scripts, styles and the head; those that may stand in a head.
DROPPED = frozenset("title template svg iframe textarea select button".split())
HEAD = frozenset("title template noscript noframes base basefont bgsound link meta".split())
#: An opening tag of the key ends an open element of these.
_P_ENDS = BLOCKS - {"html", "body"}
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = frozenset("ul ol dl table article section div nav aside main body".split())

GROUPS = {
    "article": {"article", "main"}, "nav": {"nav"}, "ends": {"header", "footer"}, "aside": {"aside"}, "form": {"form", "fieldset"},
    "heading": {"h1", "h2", "h3", "h4", "h5", "h6"}, "paragraph": {"p", "blockquote", "pre"}, "list": {"ul", "ol", "dl"},
    "run": {"#text"}, "item": {"li", "dt", "dd"}, "table": {"table", "thead", "tbody", "tr", "td", "th"}, "box": {"div", "section", "figure"},
}
ATTRIBUTES = {
    "content": {"article", "content", "post", "entry", "story", "main", "body", "articlebody", "text"},
    "ad": {"ad", "ads", "advert", "advertisement", "promo", "sponsor", "sponsored", "banner"},
    "menu": {"nav", "menu", "navigation", "breadcrumb", "breadcrumbs", "toolbar", "pagination"},
    "edge": {"header", "footer", "masthead", "copyright", "legal"},
    "side": {"sidebar", "related", "widget", "share", "social", "recommended"},
    "comment": {"comment", "comments", "disqus", "reply", "replies", "respond"},
    "notice": {"cookie", "cookies", "notice", "consent", "newsletter", "subscribe", "popup", "modal", "alert"},
}
_ARTICLE, _OUT = {"article"}, {"nav", "ends", "aside", "form"}
_OUT_ATTRIBUTES = set(ATTRIBUTES) - {"content"}
_GROUP_OF = {tag: g for g, tags in GROUPS.items() for tag in tags}
_ATTRIBUTE_OF = {t: a for a, ts in ATTRIBUTES.items() for t in ts}
_GROUPS, _ATTRS = list(GROUPS), list(ATTRIBUTES)  # the first attribute group is that of content
_OUT_AT = [_GROUPS.index(g) for g in sorted(_OUT)]


@dataclass
class Page:
    """Block elements and runs of text (``#text``) in page order, parents first, and the blocks of text."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    attrs: list[frozenset] = field(default_factory=lambda: [frozenset()])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, link characters


def _closings(tags: list[re.Match], names: list[str]) -> dict[int, int]:
    """Number of a dropped element's opening tag -> of its closing tag, for those closed
    before the block they are in."""
    found: dict[int, int] = {}
    if DROPPED.isdisjoint(names):
        return found
    stack, count = [], dict.fromkeys(BLOCKS | DROPPED, 0)
    for i, (m, tag) in enumerate(zip(tags, names)):
        if tag not in count or tag in VOID:
            continue
        if not m[2]:
            if tag in BLOCKS or not m[4].endswith("/"):
                stack.append(i)
                count[tag] += 1
        elif count[tag]:
            while True:
                opened = stack.pop()
                count[names[opened]] -= 1
                if names[opened] == tag:
                    break
            if tag in DROPPED:
                found[opened] = i
    return found


def parse(source: str | None) -> Page:
    page, stack, text, links, in_link, at = Page(), [0], [], 0, False, 0
    source = source or ""

    def flush():
        nonlocal links
        if text:
            block = " ".join("".join(text).split())
            if block:
                page.blocks.append((len(page.tags), block, min(links, len(block))))
                page.tags.append("#text")
                page.parents.append(stack[-1])
                page.attrs.append(frozenset())
            text.clear()
        links = 0

    def add(run: str):
        nonlocal links
        if "&" in run:
            run = entities.unescape(run)
        if in_link:
            links += len(run)
        text.append(run)

    tags = list(_TAG.finditer(source))
    names = [m[3].lower() if m[3] else "" for m in tags]
    ends = _closings(tags, names)
    head, unclosed, skip_to = False, False, -1
    for i, (m, tag) in enumerate(zip(tags, names)):
        run, at = source[at:m.start()], m.end()
        if i <= skip_to:
            continue
        if run:
            head = head and not run.strip()
            if not unclosed:
                add(run)
        if not tag:
            continue
        closing = bool(m[2])
        if tag == "head":
            head = not closing
        elif tag in ("html", "body") if closing else tag not in HEAD:
            head = False
        if tag in DROPPED:
            skip_to = ends.get(i, -1)
            unclosed = not closing and skip_to < 0 and not m[4].endswith("/")
            continue
        if tag not in BLOCKS:
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        in_link = unclosed = False
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if page.tags[stack[i]] == tag:
                    del stack[i:]
                    break
            continue
        if tag in _P_ENDS and page.tags[stack[-1]] == "p":
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            open_tag = page.tags[stack[i]]
            if open_tag in IMPLIED.get(tag, ()):
                del stack[i:]
                break
            if open_tag in _SCOPES:
                break
        if tag in VOID:
            continue
        page.tags.append(tag)
        page.parents.append(stack[-1])
        attrs = frozenset(_ATTRIBUTE_OF[t] for a in _ATTRIBUTE.findall(m[4]) for t in _TOKEN.findall("".join(a).lower())
                          if t in _ATTRIBUTE_OF) if m[4] else frozenset()
        page.attrs.append(attrs)
        stack.append(len(page.tags) - 1)
    if at < len(source) and not unclosed:
        add(source[at:])
    flush()
    return _with_own_text(page)


def _with_own_text(page: Page) -> Page:
    """The page where an element without block elements below has its runs as its own blocks."""
    mixed = [False] * len(page.tags)
    for tag, parent in zip(page.tags[1:], page.parents[1:]):
        mixed[parent] |= tag != "#text"
    out, number = Page([], [], [], []), []
    for e, (tag, parent) in enumerate(zip(page.tags, page.parents)):
        if tag == "#text" and not mixed[parent]:
            number.append(number[parent])
            continue
        number.append(len(out.tags))
        out.tags.append(tag)
        out.parents.append(number[parent] if e else -1)
        out.attrs.append(page.attrs[e])
    out.blocks = [(number[e], text, links) for e, text, links in page.blocks]
    return out


def _kinds(page: Page) -> tuple[list[str | None], list[frozenset]]:
    """Group and attribute groups of every node; a ``header`` with a heading inside an
    ``article`` is a heading, without the attributes of an edge."""
    groups, attrs = [_GROUP_OF.get(t) for t in page.tags], page.attrs
    if "header" in page.tags and "article" in page.tags:
        attrs, within, heading = list(attrs), [t == "article" for t in page.tags], [g == "heading" for g in groups]
        for e in range(1, len(groups)):
            within[e] = within[e] or within[page.parents[e]]
        for e in range(len(groups) - 1, 0, -1):
            heading[page.parents[e]] |= heading[e]
        for e, tag in enumerate(page.tags):
            if tag == "header" and within[e] and heading[e]:
                groups[e], attrs[e] = "heading", attrs[e] - {"edge"}
    return groups, attrs


_MARKS = re.compile(r"[.,;:!?]")


def features(page: Page) -> np.ndarray:
    """One row for each element."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own, links, marks, blocks = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    first = np.full(n, -1.0)
    seen = 0
    for e, text, linked in page.blocks:
        own[e] += len(text)
        links[e] += linked
        marks[e] += len(_MARKS.findall(text))
        blocks[e] += 1
        if first[e] < 0:
            first[e] = seen
        seen += len(text)
    chars, inside, below = own.copy(), links.copy(), np.ones(n)
    depth, kids = np.zeros(n), np.zeros(n)
    for e in range(n - 1, 0, -1):
        p = page.parents[e]
        chars[p] += chars[e]
        inside[p] += inside[e]
        marks[p] += marks[e]
        blocks[p] += blocks[e]
        below[p] += below[e]
        kids[p] += 1
        if first[e] >= 0 and (first[p] < 0 or first[e] < first[p]):
            first[p] = first[e]
    groups, attrs = _kinds(page)
    group = np.array([_GROUPS.index(g) if g else -1 for g in groups])
    tag = np.zeros((n, len(_GROUPS)))
    tag[group >= 0, group[group >= 0]] = 1
    attr = np.zeros((n, len(_ATTRS)))
    for e, a in enumerate(attrs):
        for name in a:
            attr[e, _ATTRS.index(name)] = 1
    tag_above, attr_above = tag.copy(), attr.copy()
    order, same = np.zeros(n), np.zeros(n)
    count: dict[tuple[int, str], int] = {}
    rank: dict[int, int] = {}
    for e in range(1, n):
        p = page.parents[e]
        depth[e] = depth[p] + 1
        tag_above[e] = np.maximum(tag_above[e], tag_above[p])
        attr_above[e] = np.maximum(attr_above[e], attr_above[p])
        rank[p] = rank.get(p, 0) + 1
        order[e] = rank[p]
        count[p, page.tags[e]] = count.get((p, page.tags[e]), 0) + 1
    for e in range(1, n):
        same[e] = count[page.parents[e], page.tags[e]]
    up = np.maximum(parents, 0)
    most, second = np.zeros(n), np.zeros(n)  # characters of the largest children
    for e in range(1, n):
        p = page.parents[e]
        if chars[e] > most[p]:
            most[p], second[p] = chars[e], most[p]
        elif chars[e] > second[p]:
            second[p] = chars[e]
    beside = np.where(chars < most[up], most[up], second[up])  # the largest of the other children
    article = _GROUPS.index("article")
    link_share, density = inside / np.maximum(chars, 1), np.log1p(chars / below)
    siblings = np.maximum(kids[up], 1)
    return np.column_stack([
        depth, np.log1p(chars), link_share, np.log1p(below), density, np.log1p(own), 100 * marks / np.maximum(chars, 20),
        np.log1p(chars / np.maximum(blocks, 1)), chars / max(seen, 1), siblings, same, order / siblings,
        np.log1p(chars[up] / siblings), chars / np.maximum(chars[up], 1), first / max(seen, 1), link_share[up], density[up],
        beside / max(seen, 1), tag[:, article].max() * (1 - tag_above[:, article]),
        np.full(n, tag[:, article].max()), np.maximum(tag_above[:, _OUT_AT].max(1), attr_above[:, 1:].max(1)), tag, tag_above, attr, attr_above])


def marked(page: Page) -> list[int] | None:
    """Labels by the page's own marks: 1 for elements of the article and those around it;
    None if the page marks no article."""
    inside, out, labels = [False], [False], [1]
    groups, attrs = _kinds(page)
    for e in range(1, len(page.tags)):
        p, group = page.parents[e], groups[e]
        out.append(out[p] or group in _OUT or bool(attrs[e] & _OUT_ATTRIBUTES))
        inside.append((inside[p] or group in _ARTICLE) and not out[e])
        labels.append(int(inside[e]))
    if not any(labels[1:]):
        return None
    for e in range(len(page.tags) - 1, 0, -1):
        if labels[e]:
            labels[page.parents[e]] = 1
    return labels


def decode(page: Page, scores: np.ndarray) -> str:
    """The blocks of the set of elements, closed under parents, of the highest total."""
    n = len(page.tags)
    gain = np.array(scores, dtype=float)  # of keeping an element, with its best choice below
    gain[0] = 0.0
    for e in range(n - 1, 0, -1):
        if gain[e] > 0:
            gain[page.parents[e]] += gain[e]
    kept = [True] * n
    for e in range(1, n):
        kept[e] = kept[page.parents[e]] and gain[e] > 0
    return "\n\n".join(text for e, text, _ in page.blocks if kept[e])


# --- training --------------------------------------------------------------------------

_EXTRA = (("div", "comments"), ("section", "comment reply"), ("aside", "sidebar"), ("aside", "related"), ("form", "subscribe"),
          ("div", "cookie notice"), ("header", "masthead"), ("div", "advert"), ("div", "share social"), ("nav", "breadcrumb"),
          ("footer", "legal"))


def _with_extras(page: Page, pick: random.Random) -> Page:
    """A copy with a few elements of further boilerplate, made of the page's own words."""
    spare = [b[1] for b in page.blocks] or ["more"]
    out = Page(list(page.tags), list(page.parents), list(page.attrs), list(page.blocks))
    inside = [e for e, t in enumerate(page.tags) if t in ("body", "article", "main")] or [0]
    for tag, names in pick.sample(_EXTRA, 4):
        out.tags.append(tag)
        out.parents.append(pick.choice(inside))
        out.attrs.append(frozenset(_ATTRIBUTE_OF[t] for t in names.split() if t in _ATTRIBUTE_OF))
        box = len(out.tags) - 1
        for _ in range(pick.randint(1, 5)):
            out.tags.append(pick.choice(("p", "li", "div")))
            out.parents.append(box)
            out.attrs.append(frozenset())
            words = pick.choice(spare).split()[:pick.randint(2, 25)]
            out.blocks.append((len(out.tags) - 1, " ".join(words), 0))
    return out


def _end(page: Page, node: int) -> int:
    """The first node after ``node``'s subtree."""
    return next((e for e in range(node + 1, len(page.tags)) if page.parents[e] < node), len(page.tags))


def _wrapped(page: Page) -> Page:
    """A copy with a ``div`` around the article."""
    at = next((e for e, t in enumerate(page.tags) if t in ("article", "main")), None)
    if at is None:
        return page
    moved = lambda e: e + (e >= at)
    parents = [moved(p) for p in page.parents]
    parents[at] = at
    return Page([*page.tags[:at], "div", *page.tags[at:]], [*parents[:at], page.parents[at], *parents[at:]],
                [*page.attrs[:at], frozenset(), *page.attrs[at:]], [(moved(e), text, links) for e, text, links in page.blocks])


def _with_runs(page: Page, pick: random.Random) -> Page:
    """A copy with runs of text beside the article and inside it, and a header with its title,
    in their places of the page, made of the page's own words."""
    spare = [b[1] for b in page.blocks] or ["more"]
    article = next((e for e, t in enumerate(page.tags) if t in ("article", "main")), None)
    if article is None:
        return page
    around = page.parents[article]
    end = _end(page, article)
    short = lambda: " ".join(pick.choice(spare).split()[:pick.randint(1, 8)])
    whole = lambda: pick.choice([t for t in spare if len(t) > 80] or spare)
    new: dict[int, list] = {}  # node before which it stands -> (tag, parent, text)
    first = next((e for e in range(1, article) if page.parents[e] == around), article)
    for at in {first, article, end, _end(page, around)}:
        new.setdefault(at, []).append(("#text", around, short()))
    if pick.random() < 0.5:
        new.setdefault(article + 1, []).append(("header", article, short()))
    if end > article + 1:
        at = pick.randint(article + 1, end)
        at = next((e for e in range(at, end) if page.parents[e] == article), end)
        new.setdefault(at, []).append(("#text", article, whole()))
    out, number, blocks, own = Page([], [], [], []), [], [], {}
    for block in page.blocks:
        own.setdefault(block[0], []).append(block)

    def add(tag, parent, attrs, texts):
        out.tags.append(tag)
        out.parents.append(parent)
        out.attrs.append(attrs)
        blocks.extend((len(out.tags) - 1, text, links) for text, links in texts)
        return len(out.tags) - 1

    for e in range(len(page.tags) + 1):
        for tag, parent, text in new.get(e, ()):
            if tag == "header":
                title = add(tag, number[parent], frozenset({"edge"} if pick.random() < 0.5 else ()), ())
                add("h1", title, frozenset(), [(text, 0)])
            else:
                add(tag, number[parent], frozenset(), [(text, pick.choice((0, 0, len(text) // 2)) if parent == around else 0)])
        if e < len(page.tags):
            parent = number[page.parents[e]] if e else -1
            number.append(add(page.tags[e], parent, page.attrs[e], [b[1:] for b in own.get(e, ())]))
    out.blocks = blocks
    return out


def _alone(page: Page) -> Page:
    """Only the texts of the marked article, in one unmarked element."""
    labels = marked(page) or []
    blocks = [(1, text, links) for e, text, links in page.blocks if labels and labels[e]]
    return Page(["#page", "div"], [-1, 0], [frozenset()] * 2, blocks)


def _hidden(page: Page) -> Page:
    """A copy whose telling tags and attributes are hidden."""
    tags = ["div" if _GROUP_OF.get(t) in {"article", *_OUT} else t for t in page.tags]
    return Page(tags, page.parents, [frozenset()] * len(tags), page.blocks)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for page_id, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page, pick = parse(source), random.Random(page_id)
            extra, runs, wrapped = _with_extras(page, pick), _with_runs(page, pick), _with_runs(_wrapped(page), pick)
            for shown, own in ((page, marked(page)), (extra, marked(extra)), (_hidden(page), marked(page)),
                               (runs, marked(runs)), (_hidden(runs), marked(runs)),
                               (_hidden(wrapped), marked(wrapped)), (_alone(page), marked(page) and [1, 1])):
                if own:
                    rows += features(shown)[1:].tolist()
                    labels += own[1:]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["x", "label"])


def _flat(tree) -> list[tuple]:
    """(feature, threshold, left, right, value) of each node of a trained tree."""
    out: list = []

    def visit(node) -> int:
        at = len(out)
        out.append((-1, 0.0, at, at, float(node.prediction())))
        if node.subtreeDepth() > 0:
            split = node.split()
            out[at] = (split.featureIndex(), float(split.threshold()), visit(node.leftChild()), visit(node.rightChild()), 0.0)
        return at

    visit(tree._java_obj.rootNode())
    return out


class Trees:
    """Boosted trees as arrays: the sum of their weighted values is half the log-odds."""

    def __init__(self, trees: list[list[tuple]], weights: list[float]):
        self.parts = [tuple(map(np.array, zip(*t))) for t in trees]
        self.weights = weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for (feature, threshold, left, right, value), weight in zip(self.parts, self.weights):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
            total += weight * value[at]
        return 2 * total


def train(pages: DataFrame) -> Trees | None:
    """``pages``: page_id, html. Fits on the bounded sample; None without both labels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    chosen = (pages.select("page_id").filter("page_id is not null").distinct()
              .orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES).collect())
    ids = [r["page_id"] for r in chosen]
    if not ids:
        return None
    found = pages.filter(F.col("page_id").isin(ids)).dropDuplicates(["page_id"]).coalesce(4)  # a bounded sample
    rows = found.select("page_id", "html").mapInArrow(_examples, "x array<double>, label double")
    rows = rows.select(array_to_vector("x").alias("features"), "label").persist()
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=1).fit(rows)
        return Trees([_flat(t) for t in model.trees], list(model.treeWeights))
    finally:
        rows.unpersist()


_OUT_SCHEMA = "page_id long, url string, text string, n_chars long"


def _extract(trees: Trees | None):
    def by_marks(page: Page) -> np.ndarray:
        return np.array(marked(page) or [1] * len(page.tags)) - 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first in range(0, batch.num_rows, 64):
                pages = [parse(s.as_py()) for s in batch.column(2)[first:first + 64]]
                if trees is None:
                    scores = [by_marks(p) for p in pages]
                else:
                    ends = np.cumsum([len(p.tags) for p in pages])
                    scores = np.split(trees(np.concatenate([features(p) for p in pages])), ends[:-1])
                out += [decode(p, s) for p, s in zip(pages, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page."""
    own = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                       pages[html_col].cast("string").alias("html"))
    return own.mapInArrow(_extract(train(own)), _OUT_SCHEMA)
