"""Main text of HTML pages by boosted trees over DOM nodes.

A page becomes a tree of block elements and text blocks. Each node has features of its subtree
(text, link and punctuation density), its attribute words, its depth and its place among its
siblings. Boosted trees, fitted on a bounded sample of pages whose own marks (``article``,
``nav``, words like "sidebar") label their nodes, give each node the odds that its whole subtree
is main text.

Decoding goes down the tree: a node is kept whole, dropped whole, or left to its children,
whichever has the best sum of log odds. A kept node has no dropped descendants and the other
way round, so choices of ancestors and descendants never contradict each other.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.llm.words import small_batches
from textrisk.session import staged

#: Pages that the trees are fitted on, about.
TRAINING_PAGES = 2000

# Element kinds of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var img br wbr "
    # Formulas and embedded things stand in a line; what is between their tags is its text.
    "object param canvas math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub "
    "msup msubsup munder mover munderover mmultiscripts mprescripts mspace mtable mtr mtd semantics".split()
)
_UNSEEN = set("script style template noscript iframe head title".split())
# What may stand in a head; anything else ends a head left open.
_HEAD_CONTENT = set(
    "head base link meta title style script noscript template basefont bgsound noframes".split()
)
_CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
    "ul li dd dt".split()
)
_CLOSED_BY = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
# An implied end does not reach beyond these.
_SCOPES = set("table ul ol dl div section article body html select".split())
_CONTENT_TAGS = {"article", "main"}
_FURNITURE_TAGS = set(
    "nav header footer aside form button select option textarea label fieldset menu dialog".split()
)
# Words of class, id and role attributes.
_CONTENT_WORDS = set("article articlebody main content post entry story body maincontent".split())
_FURNITURE_WORDS = set(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar side aside widget footer header masthead cookie "
    "cookies consent notice notices alert popup modal overlay comment comments reply replies discussion "
    "disqus respond related recommended share sharing social follow subscribe newsletter signup login "
    "search form pagination pager toolbar legal copyright disclaimer complementary contentinfo".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|noscript|iframe|title)(?=[\s/>])[^>]*+>"
    r".*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^<>]*+)>"
    r"|<[!?][^<>]*+>"
    r"|<[!?/a-zA-Z][^<>]*+\Z",
    re.DOTALL | re.IGNORECASE,
)
# Not seen up to their end tag; without one, or closed at once, only the tag itself is skipped.
_ISLANDS = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE)
    for name in ("svg", "annotation", "annotation-xml")
}
_BLANKS = " \t\n\r\f"
_NAMES = re.compile(
    r"(?:class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.IGNORECASE
)
_NAME_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

_TAG_KINDS = {
    "#text": 0, "p": 1, "div": 2, "section": 2, **{f"h{i}": 3 for i in range(1, 7)},
    "ul": 4, "ol": 4, "li": 4, "dl": 4, "dt": 4, "dd": 4, "table": 5, "tbody": 5, "tr": 5, "td": 5,
    "th": 5, "thead": 5, "tfoot": 5, "article": 6, "main": 6, "blockquote": 7, "pre": 7, "figure": 7,
    "figcaption": 7, "body": 8, "html": 8,
}
_OTHER_KIND, _FURNITURE_KIND = 9, 10
#: Features that name what a node is; half of the training rows are repeated without them.
NAMED = ["content_mark", "furniture_mark", "below_content", "below_furniture", "tag"]
FEATURES = [
    *NAMED, "depth", "chars", "words", "link_share", "punctuation", "mean_block", "blocks",
    "inline_share", "nodes", "sibling_place", "siblings", "sibling_share", "page_place", "page_share",
]


@dataclass
class Page:
    """Nodes in page order; ``end`` is the number behind the last node of the subtree."""

    parent: list[int]
    end: list[int]
    depth: list[int]
    tag: list[int]
    content: list[int]
    furniture: list[int]
    text: list[str | None]
    links: list[int]
    inline: list[int]


def _words_of(attrs: str) -> set[str]:
    found: set[str] = set()
    for groups in _NAMES.findall(attrs):
        found.update(word.lower() for value in groups if value for word in _NAME_WORDS.findall(value))
    return found


class _Builder:
    def __init__(self):
        self.page = Page([], [], [], [], [], [], [], [], [])
        self.open: list[tuple[str, int]] = []  # block elements
        self.unseen = 0
        self.links = 0
        self._clear()

    def _clear(self):
        self.pieces: list[str] = []
        self.linked = self.marks = 0

    def _add(self, kind: int, content: int, furniture: int, text: str | None, links=0, inline=0) -> int:
        page, number = self.page, len(self.page.parent)
        page.parent.append(self.open[-1][1] if self.open else -1)
        page.depth.append(len(self.open))
        page.end.append(number + 1)
        for column, value in (
            (page.tag, kind), (page.content, content), (page.furniture, furniture),
            (page.text, text), (page.links, links), (page.inline, inline),
        ):
            column.append(value)
        return number

    def _close_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self.close(1)

    def words(self, raw: str) -> None:
        if self.unseen and raw.strip(_BLANKS):
            self._close_head()
        if self.unseen:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self.links:
            self.linked += len(text)

    def flush(self) -> None:
        """End the text block, if there is one."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self._add(0, 0, 0, text, min(self.linked, len(text)), self.marks)
        self._clear()

    def close(self, count: int) -> None:
        """End the last ``count`` open elements."""
        self.flush()
        for _ in range(count):
            tag, number = self.open.pop()
            self.page.end[number] = len(self.page.parent)
            self.unseen -= tag in _UNSEEN
        self.links = 0

    def _close_implied(self, tags: set[str]) -> None:
        for back, (tag, _) in enumerate(reversed(self.open), 1):
            if tag in tags:
                self.close(back)
                return
            if tag in _SCOPES:
                return

    def start(self, tag: str, attrs: str) -> None:
        if tag not in _HEAD_CONTENT:
            self._close_head()
        elif tag == "head" and any(name != "html" for name, _ in self.open):
            return
        if tag in _INLINE:
            self.marks += 1
            if tag == "a":
                self.links = 1
            elif tag == "br":
                self.words(" ")
            return
        self.flush()
        if tag in _CLOSES_P:
            self._close_implied({"p"})
        if tag in _CLOSED_BY:
            self._close_implied(_CLOSED_BY[tag])
        if tag in _VOID:
            return
        words = _words_of(attrs) if attrs and "=" in attrs else set()
        furniture = tag in _FURNITURE_TAGS or bool(words & _FURNITURE_WORDS)
        content = not furniture and (tag in _CONTENT_TAGS or bool(words & _CONTENT_WORDS))
        kind = _FURNITURE_KIND if tag in _FURNITURE_TAGS else _TAG_KINDS.get(tag, _OTHER_KIND)
        self.open.append((tag, self._add(kind, int(content), int(furniture), None)))
        self.unseen += tag in _UNSEEN

    def finish(self, tag: str) -> None:
        if tag in _INLINE:
            if tag == "a":
                self.links = 0
            return
        for back, (name, _) in enumerate(reversed(self.open), 1):
            if name == tag:
                self.close(back)
                return


def parse_page(source: str | None) -> Page:
    """The tree of a whole page. Broken markup is read as browsers do in the common cases: tags
    left open end with their parent, stray end tags are ignored."""
    builder = _Builder()
    at = 0
    source = source or ""
    unended = set()
    while token := _TOKEN.search(source, at):
        if token.start() > at:
            builder.words(source[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if tag in _ISLANDS:
            if token["end"] or token["attrs"].endswith("/") or tag in unended:
                continue
            if end := _ISLANDS[tag].search(source, at):
                at = end.end()
            else:
                unended.add(tag)
        elif tag:
            if token["end"]:
                builder.finish(tag)
            else:
                builder.start(tag, token["attrs"])
    if at < len(source):
        builder.words(source[at:])
    builder.close(len(builder.open))
    return builder.page


class Nodes:
    """The nodes of several pages, one page after the other, with their features."""

    def __init__(self, pages: list[Page]):
        self.pages = pages
        sizes = np.array([len(page.parent) for page in pages], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(self.first[:-1], sizes)

        def column(name: str) -> np.ndarray:
            return np.array([x for page in pages for x in getattr(page, name)], np.int64)

        parent = column("parent")
        self.parent = np.where(parent >= 0, parent + shift, -1)
        self.end = column("end") + shift
        self.depth, self.tag = column("depth"), column("tag")
        self.content, self.furniture = column("content"), column("furniture")
        self.links, self.inline = column("links"), column("inline")
        self.text = [x for page in pages for x in page.text]
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.chars = np.array([len(x) if x else 0 for x in self.text], np.int64)
        self.words = np.array([x.count(" ") + 1 if x else 0 for x in self.text], np.int64)
        self.stops = np.array(
            [sum(map(x.count, ".,;:!?")) if x else 0 for x in self.text], np.int64
        )

    def __len__(self) -> int:
        return len(self.parent)

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.end] - sums[np.arange(len(self))]

    def above(self, marks: np.ndarray) -> np.ndarray:
        """Whether a node or one of its ancestors is marked."""
        change = np.zeros(len(self) + 1, np.int64)
        marked = np.flatnonzero(marks)
        np.add.at(change, marked, 1)
        np.add.at(change, self.end[marked], -1)
        return np.cumsum(change[:-1]) > 0

    def features(self) -> np.ndarray:
        count = len(self)
        chars, blocks = self.below(self.chars), self.below((self.chars > 0).astype(np.int64))
        nodes = self.end - np.arange(count)
        root = self.parent < 0
        group = np.where(root, -1 - self.page, self.parent)
        order = np.lexsort((np.arange(count), group))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
        sizes = np.diff(np.concatenate([starts, [count]]))
        place, siblings, family = (np.zeros(count) for _ in range(3))
        place[order] = np.arange(count) - np.repeat(starts, sizes)
        siblings[order] = np.repeat(sizes, sizes)
        totals = np.add.reduceat(chars[order], starts) if count else chars
        family[order] = np.repeat(totals, sizes)
        page_chars = np.add.reduceat(self.chars, self.first[:-1][np.diff(self.first) > 0]) if count else chars
        whole = np.zeros(len(self.pages))
        whole[np.diff(self.first) > 0] = page_chars
        whole = whole[self.page]
        before = np.cumsum(self.chars) - self.chars
        before = before - before[self.first[:-1][self.page]] if count else before
        some = np.maximum(chars, 1)
        return np.stack(
            [
                self.content, self.furniture, self.above(self.content), self.above(self.furniture),
                self.tag, self.depth, np.log1p(chars), np.log1p(self.below(self.words)),
                self.below(self.links) / some, self.below(self.stops) / some,
                np.log1p(chars / np.maximum(blocks, 1)), np.log1p(blocks),
                self.below(self.inline) / np.maximum(self.below(self.words), 1), np.log1p(nodes),
                place / np.maximum(siblings - 1, 1), np.log1p(siblings),
                chars / np.maximum(family, 1), before / np.maximum(whole, 1), chars / np.maximum(whole, 1),
            ],
            axis=1,
        ).astype(np.float64)

    def labels(self) -> np.ndarray:
        """1: the subtree is main text by the page's own marks, 0: it has none, -1: mixed, empty,
        or on a page without such marks."""
        furniture, content = self.above(self.furniture), self.above(self.content)
        main = self.below(np.where(content & ~furniture, self.chars, 0))
        chars = self.below(self.chars)
        marked = np.zeros(len(self.pages), bool)
        marked[self.page[(self.content == 1)]] = True
        label = np.where(main == chars, 1, np.where(main == 0, 0, -1))
        unknown = (chars == 0) | (~marked[self.page] & ~furniture)
        return np.where(unknown, -1, label)


@dataclass(frozen=True)
class NodeTrees:
    """Boosted trees as arrays: per tree feature (-1: leaf), threshold, children, value."""

    trees: tuple[tuple[np.ndarray, ...], ...]

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros(len(features))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(features), np.int64)
            while True:
                split = np.flatnonzero(feature[at] >= 0)
                if not len(split):
                    break
                now = at[split]
                low = features[split, feature[now]] <= threshold[now]
                at[split] = np.where(low, left[now], right[now])
            total += value[at]
        return 2 * total


def _tree_arrays(root, weight: float) -> tuple[np.ndarray, ...]:
    rows: list[list] = []
    todo = [(root, None)]
    while todo:
        node, link = todo.pop()
        number = len(rows)
        if link:
            rows[link[0]][link[1]] = number
        if node.subtreeDepth() == 0:
            rows.append([-1, 0.0, 0, 0, weight * node.prediction()])
        else:
            split = node.split()
            rows.append([split.featureIndex(), split.threshold(), 0, 0, 0.0])
            todo += [(node.leftChild(), (number, 2)), (node.rightChild(), (number, 3))]
    columns = list(zip(*rows))
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return tuple(np.array(column, kind) for column, kind in zip(columns, kinds))


def _training_rows(batches):
    for batch in batches:
        for begin in range(0, batch.num_rows, 200):
            part = batch.column(0).slice(begin, 200)
            nodes = Nodes([parse_page(source) for source in part.to_pylist()])
            label, features = nodes.labels(), nodes.features()
            known = label >= 0
            plain = features[known].copy()
            # Nodes of every second page are also shown without their names.
            bare = plain[nodes.page[known] % 2 == 0]
            bare[:, : len(NAMED)] = 0
            rows = np.concatenate([plain, bare])
            labels = np.concatenate([label[known], label[known][nodes.page[known] % 2 == 0]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels.astype(np.float64)), pa.array(list(rows), pa.list_(pa.float64()))],
                names=["label", "features"],
            )


def fit_node_trees(
    pages: DataFrame, training_pages: int = TRAINING_PAGES, trees: int = 20, depth: int = 4
) -> NodeTrees | None:
    """Fit on the nodes of ``training_pages`` different pages, those with the smallest hashes;
    None if they do not show both classes."""
    small_batches(pages.sparkSession)
    sources = pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
    # Different pages, by the order of their hashes: copies of a page count once, and so many
    # are drawn whatever number there is. Only hashes are put in order.
    hashes = sources.select(F.xxhash64("html").alias("hash")).distinct()
    first = hashes.orderBy("hash").limit(training_pages).agg(F.max("hash")).first()[0]
    drawn = sources.where(F.xxhash64("html") <= F.lit(first)).groupBy(F.xxhash64("html").alias("hash")).agg(
        F.min("html").alias("html")
    ).select("html")
    rows = staged(drawn.mapInArrow(_training_rows, "label double, features array<double>"))
    if rows.select("label").distinct().count() < 2:
        return None
    ready = rows.select("label", array_to_vector("features").alias("features"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(ready)
    return NodeTrees(
        tuple(
            _tree_arrays(tree._call_java("rootNode"), weight)
            for tree, weight in zip(model.trees, model.treeWeights)
        )
    )


def decode(nodes: Nodes, odds: np.ndarray, mixed: float = 0.1) -> list[str]:
    """The main text of each page: its kept text blocks, one per line."""
    odds = np.clip(odds, -20, 20)
    weight = (nodes.below((nodes.chars > 0).astype(np.int64)) > 0).astype(float)
    keep = nodes.below(-np.logaddexp(0, -odds) * weight)
    drop = nodes.below(-np.logaddexp(0, odds) * weight)
    best = np.maximum(keep, drop)
    inside = np.zeros(len(nodes))  # best sum of the children
    split = np.zeros(len(nodes), bool)
    parent, text = nodes.parent.tolist(), nodes.text
    for node in range(len(nodes) - 1, -1, -1):
        if text[node] is None and inside[node] - mixed > best[node]:
            split[node] = True
            best[node] = inside[node] - mixed
        if parent[node] >= 0:
            inside[parent[node]] += best[node]
    out: list[list[str]] = [[] for _ in nodes.pages]
    state = np.where(keep > drop, 1, 0)  # 1 kept, 0 dropped
    decided = np.zeros(len(nodes), bool)
    for node in range(len(nodes)):
        up = parent[node]
        if up >= 0 and decided[up]:
            decided[node], state[node] = True, state[up]
        elif not split[node]:
            decided[node] = True
        if text[node] is not None and state[node]:
            out[nodes.page[node]].append(text[node])
    return ["\n".join(blocks) for blocks in out]


def _extract_rows(batches, trees: NodeTrees | None):
    for batch in batches:
        last = batch.num_columns - 1
        for begin in range(0, batch.num_rows, 200):
            part = batch.slice(begin, 200)
            nodes = Nodes([parse_page(source) for source in part.column(last).to_pylist()])
            if trees is None:
                odds = np.where(nodes.above(nodes.furniture), -5.0, 5.0)
            else:
                odds = trees.log_odds(nodes.features())
            texts = decode(nodes, odds)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:last], pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                names=[*part.schema.names[:last], "text", "n_chars"],
            )


def extract_text(pages: DataFrame, trees: NodeTrees | None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` per row of ``pages``.

    Null and empty pages have an empty text, repeated rows repeated results. Without trees
    (nothing to learn from), all text outside of marked furniture is kept. Further columns are
    ignored.
    """
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(
        lambda batches: _extract_rows(batches, trees), f"{schema}, text string, n_chars bigint"
    )
