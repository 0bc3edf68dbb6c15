"""A random forest over any number of rows, all trees grown a level at a time.

Rows lie in blocks: their entries as bins, and the node of each row in each tree. Per level a map
over the blocks counts, for every open node, the entries of the features drawn for it by bin and
class; the counts are dealt by node, and the tasks that get them find the best cuts. Only bins
that rows have are counted, so that a node of few rows costs little and a level costs what the
rows in open nodes have, however many nodes there are.

A tree's features are dealt anew to groups per level, and each node draws a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.session import staged, unstaged

BINS = 32  # fixed value: MLlib's trees use as many
_ROWS, _ENTRIES = 4096, 2_000_000  # of a block, at most
_AT_ONCE = 2_000_000  # counts dealt out together, and about as many per task that finds cuts
_BLOCK = "block bigint, positive binary, begin binary, feature binary, bin binary, place binary"


@dataclass(frozen=True)
class ForestSettings:
    trees: int
    depth: int
    min_leaf: int
    seed: int


@dataclass(frozen=True)
class Level:
    """The nodes of one depth, by tree. ``cut`` is the last bin that goes to the child at ``left``
    of the next level; the child behind it takes the rest. A leaf has feature -1."""

    tree: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    chance: np.ndarray
    worth: np.ndarray


@dataclass(frozen=True)
class Bins:
    """``edges`` has a row of rising values per feature, infinite behind the last: bin ``i`` takes
    the values above edge ``i - 1`` up to edge ``i``. ``zero`` is the bin of 0."""

    edges: np.ndarray
    zero: np.ndarray

    def of(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        found = np.zeros(len(feature), np.int64)
        for step in (16, 8, 4, 2, 1):
            found += step * (self.edges[feature, found + step - 1] < value)
        return found.astype(np.uint8)


def find_bins(parts: DataFrame, features: int) -> Bins:
    """Edges at 0 and the quantiles of the other values, of all rows."""
    shares = [i / (BINS - 1) for i in range(1, BINS - 1)]
    slot = F.coalesce("indices", F.sequence(F.lit(0), F.size("values") - 1))
    pairs = F.arrays_zip(slot.alias("slot"), F.col("values").alias("value"))
    known = parts.where(F.size("values") > 0).select(F.inline(pairs).alias("slot", "value"))
    cuts = known.where(F.col("value") != 0).groupBy("slot").agg(
        F.percentile_approx("value", shares, F.lit(1000)).alias("cuts")
    )
    edges = np.full((features, BINS - 1), np.inf)
    edges[:, 0] = 0.0
    for row in cuts.collect():  # one per feature
        own = np.unique([0.0, *row["cuts"]])
        edges[row["slot"], : len(own)] = own
    return Bins(edges, (edges < 0).sum(axis=1).astype(np.uint8))


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the entries of vectors, as stored."""
    values, indices = vectors.field("values"), vectors.field("indices")
    lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    begin = np.cumsum(lengths) - lengths
    feature = np.arange(len(row)) - begin[row]  # of dense vectors
    sparse = indices.is_valid().to_numpy(zero_copy_only=False)
    feature[sparse[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, feature, values.flatten().to_numpy(zero_copy_only=False)


def _binned(vectors: pa.StructArray, bins: Bins) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where rows begin, feature and bin of the entries outside the bin of 0."""
    row, feature, value = _entries(vectors)
    bin = bins.of(feature, value)
    kept = bin != bins.zero[feature]
    return np.searchsorted(row[kept], np.arange(len(vectors) + 1)), feature[kept], bin[kept]


def _bag(settings: ForestSettings, block: int, rows: int) -> np.ndarray:
    """How often each tree draws each row of a block; a single tree takes all."""
    if settings.trees == 1:
        return np.ones((1, rows), np.int32)
    return np.random.default_rng([settings.seed, 1, block]).poisson(1.0, (settings.trees, rows)).astype(np.int32)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = batch.column("_vector").field("values").value_lengths().fill_null(0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = min(int(np.searchsorted(ends, before + _ENTRIES, "right")), begin + _ROWS)
        end = max(end, begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    kinds = (np.bool_, np.int64, np.int32, np.uint8, np.int32)
    for i in range(batch.num_rows):
        number, *blobs = (column[i] for column in batch.columns)
        yield number.as_py(), *(np.frombuffer(b.as_buffer(), kind) for b, kind in zip(blobs, kinds))


def _written(number: int, *arrays: np.ndarray) -> pa.RecordBatch:
    blobs = [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]
    names = ["block", "positive", "begin", "feature", "bin", "place"]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *blobs], names)


def _blocks(rows: DataFrame, bins, settings: ForestSettings) -> DataFrame:
    """``rows`` have ``positive`` and ``_vector``; a row is at the root of the trees that drew it."""

    def work(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _slices(batch):
                begin, feature, bin = _binned(part.column("_vector"), bins.value)
                positive = part.column("positive").to_numpy(zero_copy_only=False).astype(bool)
                bag = _bag(settings, number, part.num_rows)
                place = np.where(bag > 0, np.arange(settings.trees, dtype=np.int32)[:, None], np.int32(-1))
                yield _written(number, positive, begin, feature.astype(np.int32), bin, place)
                number += 1

    return rows.mapInArrow(work, _BLOCK)


def _root_counts(blocks: DataFrame, settings: ForestSettings) -> np.ndarray:
    """Per tree, the draws of negatives and positives, and once, the entries of all blocks."""

    def work(batches):
        sums, entries = np.zeros((settings.trees, 2), np.int64), 0
        for batch in batches:
            for number, positive, _, feature, _, _ in _read(batch):
                bag = _bag(settings, number, len(positive))
                sums += np.stack([bag[:, ~positive].sum(axis=1), bag[:, positive].sum(axis=1)], axis=1)
                entries += len(feature)
        numbers = pa.array([*range(settings.trees), settings.trees])
        n0, n1 = (pa.array([*sums[:, i].tolist(), entries]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([numbers, n0, n1], ["tree", "n0", "n1"])

    rows = blocks.mapInArrow(work, "tree bigint, n0 bigint, n1 bigint")
    # One row per tree, and one.
    found = rows.groupBy("tree").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("tree").collect()
    return np.array([(row["n0"], row["n1"]) for row in found], np.int64)


def _drawn(settings: ForestSettings, features: int) -> int:
    """Features that a node draws; those of a single tree take all."""
    return features if settings.trees == 1 else math.ceil(math.sqrt(features))


def drawn_groups(settings: ForestSettings, tree: int, depth: int, features: int, nodes: int):
    """The group of each feature (-2: none) and of each node, at one depth of a tree."""
    size = _drawn(settings, features)
    source = np.random.default_rng([settings.seed, 2, tree, depth])
    groups = features // size
    group = np.full(features, -2, np.int32)
    group[source.permutation(features)[: groups * size]] = np.repeat(np.arange(groups, dtype=np.int32), size)
    return group, source.integers(0, groups, nodes, dtype=np.int32)


def _count_block(block: tuple, begins: np.ndarray, depth: int, features: int, settings: ForestSettings):
    """Per tree with open nodes: sorted keys of node, feature and bin, and the draws of negatives and
    positives. ``begins`` has the first node of each tree at this depth."""
    number, positive, begin, feature, bin, place = block
    place = place.reshape(settings.trees, -1)
    bag, lengths = _bag(settings, number, len(positive)), np.diff(begin)
    row, feature = np.repeat(np.arange(len(positive)), lengths), feature.astype(np.intp)
    code = feature * BINS + bin
    for tree, at in enumerate(place):
        some = at >= 0
        if not some.any():
            continue
        first, last = begins[tree : tree + 2]
        group, picks = drawn_groups(settings, tree, depth, features, last - first)
        wanted = np.full(len(at), -1, np.int32)
        wanted[some] = picks[at[some] - first]
        hit = np.flatnonzero(np.repeat(wanted, lengths) == group.take(feature))
        rows = row[hit]
        key = at[rows] * np.int64(features * BINS) + code[hit]
        order = np.argsort(key)
        key, rows = key[order], rows[order]
        yield merged(key, np.where(positive[rows], 0, bag[tree][rows]), np.where(positive[rows], bag[tree][rows], 0))


def merged(key: np.ndarray, n0: np.ndarray, n1: np.ndarray):
    """Sums by key; keys are in order."""
    if not len(key):
        return key, n0.astype(np.int32), n1.astype(np.int32)
    begins = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[begins], *(np.add.reduceat(n, begins).astype(np.int32) for n in (n0, n1))


def _dealt(counts: list[tuple], parts: int, width: int) -> pa.RecordBatch:
    key, n0, n1 = (np.concatenate(one) for one in zip(*counts))
    owner = key // width % parts
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(parts + 1))
    some = [i for i in range(parts) if cuts[i] < cuts[i + 1]]
    blobs = [
        pa.array([column[order[cuts[i] : cuts[i + 1]]].tobytes() for i in some], pa.binary()) for column in (key, n0, n1)
    ]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *blobs], ["part", "key", "n0", "n1"])


def best_cuts(key, n0, n1, bins_of_zero, totals: np.ndarray, factors: Sequence[float], min_leaf: int):
    """Of every node that can be cut: node, feature, bin, draws of negatives and positives on the
    left, and the gain. ``totals`` has the draws by node; what no entry tells of has the bin of 0."""
    features = len(bins_of_zero)
    order = np.argsort(key)
    key, n0, n1 = merged(key[order], n0[order], n1[order])
    if not len(key):
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, np.int64, float))
    pair = key // BINS
    begins = np.flatnonzero(np.diff(pair, prepend=-1))
    owner, feature = np.divmod(pair[begins], features)
    rest0 = totals[owner, 0] - np.add.reduceat(n0.astype(np.int64), begins)
    rest1 = totals[owner, 1] - np.add.reduceat(n1.astype(np.int64), begins)
    key = np.concatenate([key, pair[begins] * BINS + bins_of_zero[feature]])
    order = np.argsort(key)
    key = key[order]
    left = np.stack([np.concatenate([n0, rest0])[order], np.concatenate([n1, rest1])[order]], axis=1).cumsum(axis=0)
    pair, bin = np.divmod(key, BINS)
    node, feature = np.divmod(pair, features)
    # A feature's bins hold all draws of its node: what lies before is the sum of the nodes before.
    begins = np.flatnonzero(np.diff(pair, prepend=-1))
    before = np.concatenate([np.zeros((1, 2), np.int64), left[begins[1:] - 1]])
    left -= np.repeat(before, np.diff(begins, append=len(pair)), axis=0)
    right = totals[node] - left
    some = (left.sum(axis=1) >= min_leaf) & (right.sum(axis=1) >= min_leaf)
    node, feature, bin, left, right = (one[some] for one in (node, feature, bin, left, right))
    weights = np.asarray(factors, float)
    gain = _impurity((left + right) * weights) - _impurity(left * weights) - _impurity(right * weights)
    gain /= np.maximum(((left + right) * weights).sum(axis=1), 1e-300)
    order = np.lexsort((np.arange(len(node)), -gain, node))
    order = order[np.flatnonzero(np.diff(node[order], prepend=-1))]
    order = order[gain[order] > 1e-12]
    return node[order], feature[order], bin[order], left[order, 0], left[order, 1], gain[order]


def _impurity(weights: np.ndarray) -> np.ndarray:
    """The Gini impurity times the weight."""
    whole = weights.sum(axis=1)
    return 2.0 * weights[:, 0] * weights[:, 1] / np.where(whole > 0, whole, 1.0)


def _found_cuts(blocks: DataFrame, depth: int, begins, totals, bins, factors, settings: ForestSettings, parts: int):
    features = len(bins.value.zero)
    width = features * BINS

    def count(batches):
        for batch in batches:
            for block in _read(batch):
                held, size = [], 0
                for counts in _count_block(block, begins.value, depth, features, settings):
                    held.append(counts)
                    size += len(counts[0])
                    if size > _AT_ONCE:
                        yield _dealt(held, parts, width)
                        held, size = [], 0
                if size:
                    yield _dealt(held, parts, width)

    def find(batches):
        held: tuple[list, ...] = ([], [], [])
        for batch in batches:
            for column, into, kind in zip(batch.columns[1:], held, (np.int64, np.int32, np.int32)):
                into.extend(np.frombuffer(blob.as_buffer(), kind) for blob in column)
        if held[0]:
            key, n0, n1 = (np.concatenate(one) for one in held)
            for one in held:
                one.clear()
            found = best_cuts(key, n0, n1, bins.value.zero, totals.value, factors, settings.min_leaf)
            names = ["node", "feature", "bin", "left0", "left1", "gain"]
            yield pa.RecordBatch.from_arrays([pa.array(one) for one in found], names)

    counted = blocks.mapInArrow(count, "part int, key binary, n0 binary, n1 binary")
    cuts = counted.repartitionById(parts, F.col("part")).mapInArrow(
        find, "node bigint, feature bigint, bin bigint, left0 bigint, left1 bigint, gain double"
    )
    # One row per node that is cut.
    table = cuts.toArrow().sort_by("node")
    return [table.column(name).to_numpy() for name in table.column_names]


def _spread(begin: np.ndarray, feature: np.ndarray, bin: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """The bins of all features of some rows."""
    rows = len(begin) - 1
    spread = np.tile(zero, (rows, 1))
    some = slice(begin[0], begin[-1])
    spread[np.repeat(np.arange(rows), np.diff(begin)), feature[some]] = bin[some]
    return spread


def _step(place: np.ndarray, level: Level, spread: np.ndarray) -> np.ndarray:
    """The nodes of the next level of rows (columns) that are in nodes of a level, -1 if in a leaf."""
    tree, row = np.nonzero(place >= 0)
    at = place[tree, row]
    feature = level.feature[at]
    child = level.left[at] + (spread[row, feature] > level.cut[at])
    moved = np.full_like(place, -1)
    moved[tree, row] = np.where(feature >= 0, child, -1)
    return moved


_SPREAD = 256  # rows whose bins are spread out together


def _moved(blocks: DataFrame, level, opened, bins) -> DataFrame:
    """Rows go on to the open nodes of the next level."""

    def work(batches):
        for batch in batches:
            for number, positive, begin, feature, bin, place in _read(batch):
                place = place.reshape(-1, len(positive)).copy()
                for a in range(0, len(positive), _SPREAD):
                    b = min(a + _SPREAD, len(positive))
                    spread = _spread(begin[a : b + 1], feature, bin, bins.value.zero)
                    at = _step(place[:, a:b], level.value, spread)
                    place[:, a:b] = np.where((at >= 0) & opened.value[at], at, -1)
                yield _written(number, positive, begin, feature, bin, place)

    return blocks.mapInArrow(work, _BLOCK)


@dataclass(frozen=True)
class Forest:
    settings: ForestSettings
    bins: Bins = field(repr=False)
    levels: list[Level] = field(repr=False)

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the gains, weighed by what the nodes hold; of each tree, then of all."""
        shares = np.zeros((self.settings.trees, len(self.bins.zero)))
        for level in self.levels:
            cut = level.feature >= 0
            np.add.at(shares, (level.tree[cut], level.feature[cut]), level.worth[cut])
        whole = shares.sum(axis=1, keepdims=True)
        shares = (shares / np.where(whole > 0, whole, 1.0)).sum(axis=0)
        return DenseVector(shares / (shares.sum() or 1.0))

    def chances(self, vectors: pa.StructArray) -> np.ndarray:
        """The mean over the trees of the share of positives in a row's leaf."""
        begin, feature, bin = _binned(vectors, self.bins)
        sums = np.zeros(len(vectors))
        for a in range(0, len(vectors), _SPREAD):
            b = min(a + _SPREAD, len(vectors))
            spread = _spread(begin[a : b + 1], feature, bin, self.bins.zero)
            place = np.repeat(np.arange(self.settings.trees)[:, None], b - a, axis=1)
            for level in self.levels:
                if not (place >= 0).any():
                    break
                ended = (place >= 0) & (level.feature[place] < 0)
                sums[a:b] += np.where(ended, level.chance[place], 0.0).sum(axis=0)
                place = _step(place, level, spread)
        return sums / self.settings.trees

    def score(self, df: DataFrame, vector: str, name: str) -> DataFrame:
        """Append the positive-class probability in place of ``vector``. A map, no shuffle."""
        kept = df.drop(vector).schema.fields
        names = [f.name for f in kept]
        forest = df.sparkSession.sparkContext.broadcast(self)

        def work(batches):
            for batch in batches:
                score = pa.array(forest.value.chances(batch.column(batch.num_columns - 1)), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], [*names, name])

        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        return kept_with(df, names, vector).mapInArrow(work, ", ".join([*kinds, f"`{name}` double"]))


def kept_with(df: DataFrame, columns: Sequence[str], vector: str) -> DataFrame:
    """Some columns, and a vector by its stored parts."""
    return df.select(*columns, F.unwrap_udt(vector).alias("_vector"))


def grow_forest(
    ready: DataFrame, label: str, vector: str, features: int, factors: Sequence[float], settings: ForestSettings
) -> Forest:
    """Trees of the rows of ``ready``, a staged frame; ``label`` is 0 or 1, and ``factors`` are the
    weights of a row of either class."""
    context = ready.sparkSession.sparkContext
    positive = F.when(F.col(label).isin(0, 1), F.col(label) == 1).otherwise(
        F.raise_error(F.lit("a label is neither 0 nor 1")).cast("boolean")
    )
    rows = kept_with(ready.withColumn("positive", positive), ["positive"], vector)
    bins = context.broadcast(find_bins(rows.select("_vector.*"), features))
    tasks = max(context.defaultParallelism, len(ready.inputFiles()))
    blocks = staged(_blocks(rows.repartition(tasks), bins, settings))
    *totals, (entries, _) = _root_counts(blocks, settings)
    totals = np.array(totals).reshape(-1, 2)
    # A node draws one of the groups, and a tree about two of three rows.
    counts = entries * settings.trees * 0.64 * _drawn(settings, features) / features
    parts = max(context.defaultParallelism, math.ceil(counts / _AT_ONCE))
    tree, levels = np.arange(settings.trees, dtype=np.int32), []
    opened = _open(totals, 0, settings)
    for depth in range(settings.depth + 1):
        if not len(tree):
            break
        weights = totals * np.asarray(factors, float)
        chance = weights[:, 1] / np.maximum(weights.sum(axis=1), 1e-300)
        level = Level(
            tree, np.full(len(tree), -1, np.int32), np.zeros(len(tree), np.uint8),
            np.zeros(len(tree), np.int32), chance, np.zeros(len(tree)),
        )
        levels.append(level)
        if not opened.any():
            break
        begins = np.searchsorted(tree, np.arange(settings.trees + 1))
        sent = [context.broadcast(one) for one in (begins, totals)]
        node, feature, bin, left0, left1, gain = _found_cuts(
            blocks, depth, *sent, bins, factors, settings, parts
        )
        level.feature[node], level.cut[node], level.left[node] = feature, bin, 2 * np.arange(len(node))
        level.worth[node] = gain * weights[node].sum(axis=1)
        left = np.stack([left0, left1], axis=1)
        totals = np.stack([left, totals[node] - left], axis=1).reshape(-1, 2)
        tree = np.repeat(tree[node], 2)
        opened = _open(totals, depth + 1, settings)
        if opened.any():
            moving = [context.broadcast(level), context.broadcast(opened)]
            before, blocks = blocks, staged(_moved(blocks, *moving, bins))
            unstaged(before)
            sent += moving
        for one in sent:
            one.unpersist()
    unstaged(blocks)
    return Forest(settings, bins.value, levels)


def _open(totals: np.ndarray, depth: int, settings: ForestSettings) -> np.ndarray:
    """The nodes that may be cut."""
    mixed = (totals > 0).all(axis=1) & (totals.sum(axis=1) >= 2 * settings.min_leaf)
    return mixed & (depth < settings.depth)
