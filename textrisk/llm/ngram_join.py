"""Similarity join of texts by their word n-gram sets (exact Jaccard threshold).

The work is cut so that no group grows without bound and no pair of a group is written out:

1. Each text becomes a set of 64-bit n-gram hashes. Texts with equal sets form one class;
   only classes go on.
2. Two sets that are similar enough differ in at most ``d`` elements. The hash range is cut
   into somewhat more than ``d`` parts. If more than ``d`` parts of a set have elements, it
   agrees with each similar set in at least one of them. A hash of such a part is the posting
   by which classes meet. The few sets with too many parts without elements post these too.
   N-grams that very many sets have are left out where the others suffice, so that a passage
   of many texts ties only texts that consist of such passages.
3. Classes that share a posting are tied to the smallest of them. Components of these ties
   hold every similar pair. They are dealt into tasks of bounded size; a large component is
   cut into blocks, and each pair of blocks is one task.
4. Inside a task the sets, ordered by hash, are stored in a prefix tree. Each set walks the
   tree once: sets with a common prefix share its partial overlap, and a subtree is left when
   the remaining lengths cannot reach the threshold, or when all its sets are already
   connected with the walking one (their link would change no component).
5. Links found give the components of the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.llm.components import connected
from textrisk.llm.words import SPACED, chain, find_words, mix, slices, small_batches, text_bytes
from textrisk.session import staged

#: N-grams of the sets in one block; a task holds two blocks.
BLOCK_GRAMS = 500_000
#: N-grams known to all tasks as common, at most, and of how many sets one must have them.
COMMON_GRAMS = 50_000
COMMON_SHARE = 2000


@dataclass(frozen=True)
class Threshold:
    """Sets are similar if ``whole * common >= share * union``."""

    share: int = 90
    whole: int = 100

    def similar(self, common, left, right):
        return self.whole * common >= self.share * (left + right - common)

    def least_common(self, left: int, right: int) -> int:
        return -(-self.share * (left + right) // (self.share + self.whole))

    def largest_partner(self, size: int) -> int:
        return size * self.whole // self.share

    def size_classes(self, largest: int) -> np.ndarray:
        """First size of each class; similar sets are in the same or in adjacent classes."""
        firsts = [1]
        while firsts[-1] <= largest:
            firsts.append(self.largest_partner(firsts[-1]) + 1)
        return np.array(firsts)

    def differences(self, last_size: int) -> int:
        """Most elements in which a set of up to ``last_size`` elements and a larger one that is
        similar differ."""
        both = last_size + self.largest_partner(last_size)
        return both * (self.whole - self.share) // (self.whole + self.share)


def gram_sets(column: pa.Array, grams: int) -> Iterator[np.ndarray]:
    """The set of each text as ascending hashes: its word n-grams, or the whole sequence of
    a text with fewer words; empty without words."""
    for begin, end in slices(column):
        data, bounds = text_bytes(column.slice(begin, end - begin))
        words = find_words(data, bounds, SPACED)
        chained = chain(words.hashes, grams)
        for text in range(end - begin):
            own = words.of(text)
            count = own.stop - own.start
            if count == 0:
                yield np.zeros(0, np.uint64)
            elif count < grams:
                yield chain(words.hashes[own], count)
            else:
                yield _distinct(chained[own.start : own.stop - grams + 1])


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    keep = np.ones(len(ordered), bool)
    keep[1:] = ordered[1:] != ordered[:-1]
    return ordered[keep]


def set_hash(grams: np.ndarray) -> int:
    """64-bit identity of a set. Two different sets share it with a chance of about 2^-64 per
    pair, that is one in a billion for all pairs of 100,000 sets."""
    seed = np.array([len(grams)], np.uint64)
    return int(mix(mix(grams).sum(dtype=np.uint64) + mix(seed)).view(np.int64)[0])


_NONE = np.zeros(0, np.uint64)


def _part_hashes(grams: np.ndarray, parts: int, label: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each part, and which parts have elements."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams), out=sums[1:])
    edges = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)
    cuts = np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])
    inside = sums[cuts[1:]] - sums[cuts[:-1]]
    labels = np.arange(parts, dtype=np.uint64) + np.uint64(label << 40)
    return mix(inside + mix(labels + np.uint64(1))), cuts[1:] > cuts[:-1]


def postings(
    grams: np.ndarray, firsts: np.ndarray, threshold: Threshold, common: np.ndarray = _NONE
) -> np.ndarray:
    """Hashes of the set's parts, for pairs with larger and with smaller partners.

    N-grams in ``common`` are left out first: without them two sets differ in no more elements
    than with them. Only a set whose other n-grams fill too few parts also posts its parts with
    them.
    """
    rare = grams[~np.isin(grams, common)] if len(common) else grams
    own = int(np.searchsorted(firsts, len(grams), "right")) - 1
    found = []
    for cls in (own, own - 1):
        if cls < 0:
            continue
        differences = threshold.differences(int(firsts[cls + 1]) - 1)
        # A set without differences is one part.
        parts = differences + differences // 8 + 3 if differences else 1
        hashes, filled = _part_hashes(rare, parts, 2 * cls)
        found.append(hashes[filled])
        if filled.sum() <= differences:
            hashes, filled = _part_hashes(grams, parts, 2 * cls + 1)
            found.append(hashes[filled] if filled.sum() > differences else hashes)
    return np.concatenate(found).view(np.int64)


def _set_rows(batches, grams: int):
    for batch in batches:
        sizes, ids = [], []
        for one in gram_sets(batch.column(1), grams):
            sizes.append(len(one))
            ids.append(set_hash(one) if len(one) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array(sizes, pa.int64()),
                pa.array(ids, pa.int64()),
            ],
            names=["doc_id", "text_key", "n_shingles", "set_id"],
        )


def _common_rows(batches, grams: int):
    """N-grams that several different sets of a batch have, with the number of these sets."""
    for batch in batches:
        sets = {set_hash(one): one for one in gram_sets(batch.column(0), grams) if len(one)}
        found, counts = np.unique(
            np.concatenate([_NONE, *sets.values()]), return_counts=True
        )
        often = counts >= max(3, len(sets) // 200)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[often].view(np.int64)), pa.array(counts[often].astype(np.int64))],
            names=["gram", "sets"],
        )


def _common_grams(texts: DataFrame, grams: int, classes: int) -> np.ndarray:
    """The most common n-grams, at most ``COMMON_GRAMS``. Which they are decides how many
    candidates there are, never which links are found."""
    counted = texts.mapInArrow(
        lambda batches: _common_rows(batches, grams), "gram bigint, sets bigint"
    )
    sums = counted.groupBy("gram").agg(F.sum("sets").alias("sets"))
    often = sums.where(F.col("sets") >= max(10, classes // COMMON_SHARE))
    top = often.orderBy(F.desc("sets"), "gram").limit(COMMON_GRAMS).collect()
    return np.sort(np.array([row.gram for row in top], np.int64).view(np.uint64))


def _posting_rows(batches, grams: int, threshold: Threshold, common: np.ndarray):
    """The postings of each set that the task has not met before."""
    firsts = threshold.size_classes(1)
    met: set[int] = set()
    for batch in batches:
        found, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for one in gram_sets(batch.column(0), grams):
            if not len(one) or (name := set_hash(one)) in met:
                continue
            met.add(name)
            if len(one) >= firsts[-1]:
                firsts = threshold.size_classes(len(one))
            found.append(postings(one, firsts, threshold, common))
            owners.append(np.full(len(found[-1]), name))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(found)), pa.array(np.concatenate(owners))],
            names=["posting", "set_id"],
        )


@dataclass
class Node:
    """Sets ``[lo, hi)`` in dictionary order agree in their first ``depth`` elements, the first
    ``above`` of which belong to the parent. Children are made when the node is first visited."""

    lo: int
    hi: int
    above: int
    depth: int
    children: list[Node] | None = None


class PrefixTree:
    """Ascending sequences of element numbers in a path-compressed prefix tree.

    ``flat`` holds the sequences one after the other in dictionary order. Nodes of up to
    ``BUCKET`` sets are leaves, whose remaining elements are compared in one go.
    """

    BUCKET = 512

    def __init__(self, sets: list[np.ndarray]):
        keys = [one.astype(">u8").tobytes() for one in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        ordered = [sets[i] for i in self.order]
        self.sizes = np.array([len(one) for one in ordered])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        elements, self.flat = np.unique(np.concatenate(ordered), return_inverse=True)
        self.flat = self.flat.astype(np.int32)
        self.elements = len(elements)
        self.common = np.zeros(len(sets), np.int64)
        for i in range(1, len(sets)):
            left, right = self.sequence(i - 1), self.sequence(i)
            shortest = min(len(left), len(right))
            differs = left[:shortest] != right[:shortest]
            self.common[i] = differs.argmax() if differs.any() else shortest
        self.root = self._node(0, len(sets), 0)

    def sequence(self, place: int) -> np.ndarray:
        return self.flat[self.begins[place] : self.begins[place + 1]]

    def _node(self, lo: int, hi: int, above: int) -> Node:
        depth = int(self.common[lo + 1 : hi].min()) if hi - lo > 1 else int(self.sizes[lo])
        return Node(lo, hi, above, depth)

    def children(self, node: Node) -> list[Node]:
        """Empty for a leaf. Neighbouring small children share one leaf."""
        if node.children is None:
            node.children = []
            if node.hi - node.lo > self.BUCKET:
                splits = np.flatnonzero(self.common[node.lo + 1 : node.hi] == node.depth)
                begins = [node.lo, *(node.lo + 1 + splits).tolist(), node.hi]
                taken = [node.lo]
                for begin, end in zip(begins[1:-1], begins[2:]):
                    if end - taken[-1] > self.BUCKET:
                        taken.append(begin)
                for begin, end in zip(taken, [*taken[1:], node.hi]):
                    large = end - begin > self.BUCKET
                    node.children.append(
                        self._node(begin, end, node.depth)
                        if large
                        else Node(begin, end, node.depth, node.depth)
                    )
        return node.children


def tree_links(sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Pairs of positions that are similar: enough of them to connect all that similar pairs
    connect, and no others."""
    if len(sets) < 2:
        return []
    tree = PrefixTree(sets)
    group = np.arange(len(sets))  # connected sets carry the same number
    marked = np.zeros(tree.elements, bool)
    links = []
    for me in range(len(sets) - 1):
        walker = tree.sequence(me)
        marked[walker] = True
        todo = [(tree.root, 0)]
        while todo:
            node, overlap = todo.pop()
            lo = max(node.lo, me + 1)
            if lo >= node.hi:
                continue
            open_ = group[lo : node.hi] != group[me]
            if not open_.any():
                continue
            shared = tree.sequence(node.lo)[node.above : node.depth]
            overlap += int(np.count_nonzero(marked[shared]))
            left = len(walker)
            if node.depth:
                left -= int(np.searchsorted(walker, tree.sequence(node.lo)[node.depth - 1], "right"))
            sizes = tree.sizes[lo : node.hi]
            reach = overlap + np.minimum(left, sizes - node.depth)
            open_ &= threshold.similar(reach, len(walker), sizes)
            if not open_.any():
                continue
            children = tree.children(node)
            if children:
                todo.extend((child, overlap) for child in children)
                continue
            begins = tree.begins[lo : node.hi + 1]
            hits = np.zeros(begins[-1] - begins[0] + 1, np.int32)
            np.cumsum(marked[tree.flat[begins[0] : begins[-1]]], out=hits[1:])
            common = np.diff(hits[begins - begins[0]])
            alike = lo + np.flatnonzero(open_ & threshold.similar(common, len(walker), sizes))
            for other in alike:
                if group[other] != group[me]:
                    links.append((tree.order[me], tree.order[other]))
                    group[group == group[other]] = group[me]
        marked[walker] = False
    return links


def _task_links(rows: pd.DataFrame, grams: int, threshold: Threshold) -> pd.DataFrame:
    rows = rows.drop_duplicates(["tie", "set_id", "text"])
    sets = gram_sets(pa.array(rows["text"], pa.large_string()), grams)
    by_tie: dict[int, dict] = {}
    for tie, set_id, one in zip(rows["tie"], rows["set_id"], sets):
        if set_hash(one) == set_id:  # a key may stand for several texts
            by_tie.setdefault(tie, {})[set_id] = one
    found = []
    for own in by_tie.values():
        members = list(own.items())
        for left, right in tree_links([one for _, one in members], threshold):
            found.append((members[left][0], members[right][0]))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def similar_components(
    documents: DataFrame,
    grams: int = 3,
    threshold: Threshold = Threshold(),
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` (set size), ``set_id`` and ``component_id``, the smallest
    ``doc_id`` that links reach.

    Two rows link when their n-gram sets are similar (equal sets are). Rows without words or
    text have an empty set, link with nothing and are their own component. Every row gets one
    row, also a repeated one; rows of one ``doc_id`` with different texts are linked only if
    the texts are similar. A row without ``doc_id`` takes part in no link; its component is
    null. Further columns are ignored.
    """
    return marked_components(documents, grams, threshold, block_grams).select(
        "doc_id", "n_shingles", "set_id", "component_id"
    )


def text_key(text: Column) -> Column:
    """Tells the texts of one ``doc_id`` apart."""
    return F.xxhash64(text.cast("string"))


def marked_components(
    documents: DataFrame,
    grams: int = 3,
    threshold: Threshold = Threshold(),
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``similar_components`` with the ``text_key`` of each row, and with ``stands``: whether the
    row's ``doc_id`` and text are the one text that stands for its component. Rows in no
    component of others stand for themselves."""
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"),
        text_key(F.col("text")).alias("text_key"),
    )
    sets = staged(
        rows.mapInArrow(
            lambda batches: _set_rows(batches, grams),
            "doc_id bigint, text_key bigint, n_shingles bigint, set_id bigint",
        )
    )
    # A class is read from the one text that stands for it, whatever other texts its id has.
    classes = staged(
        sets.where("doc_id is not null and set_id is not null")
        .groupBy("set_id")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"),
            F.max("n_shingles").alias("grams"),
        )
        .select(
            "set_id", F.col("first.doc_id").alias("class_doc"),
            F.col("first.text_key").alias("class_text"), "grams",
        )
    )
    texts = rows.where("doc_id is not null").select("text")
    common = _common_grams(texts, grams, classes.count())
    entries = texts.mapInArrow(
        lambda batches: _posting_rows(batches, grams, threshold, common),
        "posting bigint, set_id bigint",
    )
    hub = F.min("set_id").over(Window.partitionBy("posting"))
    ties = staged(
        entries.withColumn("hub", hub).where("set_id <> hub").select("hub", "set_id").distinct()
    )
    tied = staged(
        connected(ties, "hub", "set_id")
        .withColumnRenamed("id", "set_id")
        .withColumnRenamed("label", "tie")
        .join(classes, "set_id")
    )
    tasks, bins = _deal(tied, block_grams)
    # The tasks grow with the documents, so neither side is broadcast at any size.
    dealt = tasks.withColumnsRenamed({"class_doc": "doc_id", "class_text": "text_key"})
    members = rows.hint("merge").join(dealt, ["doc_id", "text_key"]).drop("text_key")
    links = staged(
        members.repartition(bins, "task", "left_block", "right_block")
        .groupBy("task", "left_block", "right_block")
        .applyInPandas(lambda group: _task_links(group, grams, threshold), "a bigint, b bigint")
        .distinct()
    )
    linked = connected(links, "a", "b").withColumnRenamed("id", "set_id")
    grouped = classes.join(linked, "set_id", "left").select(
        "set_id", "class_doc", "class_text", F.coalesce("label", "set_id").alias("label")
    )
    firsts = grouped.groupBy("label").agg(
        F.min(F.struct("class_doc", "class_text")).alias("first")
    )
    component = grouped.join(firsts, "label").select("set_id", "first")
    return (
        sets.join(component, "set_id", "left")
        .select(
            "doc_id", "text_key", "n_shingles", "set_id",
            F.when(F.col("set_id").isNull(), F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.col("first.class_doc"))
            .alias("component_id"),
            F.coalesce(
                F.col("first") == F.struct(
                    F.col("doc_id").alias("class_doc"), F.col("text_key").alias("class_text")
                ),
                F.lit(True),
            ).alias("stands"),
        )
    )


def _deal(tied: DataFrame, block_grams: int) -> tuple[DataFrame, int]:
    """Give each tied class its tasks: small groups of ties share a task, a large one is cut
    into blocks and goes to every pair of its blocks. Also returns the number of shared tasks."""
    groups = tied.groupBy("tie").agg(F.sum("grams").alias("total"))
    total = groups.agg(F.sum("total")).first()[0] or 0
    bins = max(-(-total // block_grams), 64)
    blocks = F.ceil(F.col("total") / block_grams).cast("int")
    cut = tied.join(groups.select("tie", blocks.alias("blocks")), "tie").withColumn(
        "own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    )
    partner = F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own"))
        )
    )
    spread = cut.withColumn("partner", partner)
    dealt = spread.select(
        "set_id", "class_doc", "class_text", "tie",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("tie"), F.lit(bins)))
        .otherwise(F.col("tie")).alias("task"),
        F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.least("own", "partner")).alias("left_block"),
        F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.greatest("own", "partner")).alias("right_block"),
    )
    return dealt, bins
