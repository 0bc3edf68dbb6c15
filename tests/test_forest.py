"""The forest's levels against trees grown node by node, and its jobs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textrisk.operators import forest
from textrisk.operators.forest import BINS, ForestSettings
from textrisk.session import staged

FEATURES, ROWS = 40, 260


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((ROWS, FEATURES)) < 0.2, rng.integers(-2, 5, (ROWS, FEATURES)) / 4, 0.0)
    dense[:, 39] = rng.integers(-3, 4, ROWS)
    positive = ((dense[:, 3] > 0) | (dense[:, 39] > 1)) ^ (rng.random(ROWS) < 0.1)
    return dense, positive.astype(int)


def grown_alone(bins, positive, bag, factors, settings, tree, features):
    """One tree, its nodes in the order of the levels: (feature, cut, chance) and the leaf of a row of bins."""
    nodes, at, levels = [np.ones(len(bins), bool)], 0, []
    factors = np.asarray(factors)

    def impurity(rows):
        n = np.array([bag[rows & (positive == c)].sum() for c in (0, 1)]) * factors
        return 2 * n[0] * n[1] / n.sum() if n.sum() else 0.0

    for depth in range(settings.depth + 1):
        group, picks = forest.drawn_groups(settings, tree, depth, features, len(nodes))
        level, after = [], []
        for rows, pick in zip(nodes, picks):
            drawn = [bag[rows & (positive == c)].sum() for c in (0, 1)]
            best = (1e-12, None, None)
            if min(drawn) > 0 and sum(drawn) >= 2 * settings.min_leaf and depth < settings.depth:
                for feature in np.flatnonzero(group == pick):
                    for cut in range(BINS):
                        left = rows & (bins[:, feature] <= cut)
                        if min(bag[left].sum(), bag[rows & ~left].sum()) < settings.min_leaf:
                            continue
                        gain = impurity(rows) - impurity(left) - impurity(rows & ~left)
                        gain /= (np.array(drawn) * factors).sum()
                        if gain > best[0] + 1e-12:
                            best = (gain, feature, cut)
            weights = np.array(drawn) * factors
            _, feature, cut = best
            level.append((-1 if feature is None else feature, weights[1] / max(weights.sum(), 1e-300), rows))
            if feature is not None:
                left = bins[:, feature] <= cut
                after += [rows & left, rows & ~left]
        levels.append(level)
        if not after:
            break
        nodes = after
    return levels


def test_levels_are_those_of_trees_grown_alone(spark, data):
    dense, positive = data
    settings, factors = ForestSettings(trees=6, depth=5, min_leaf=2, seed=3), (0.7, 1.9)
    frame = spark.createDataFrame(
        [(int(y), Vectors.sparse(FEATURES, np.flatnonzero(x).tolist(), x[x != 0].tolist())) for x, y in zip(dense, positive)],
        ["label", "vector"],
    ).coalesce(1)
    model = forest.grow_forest(staged(frame), "label", "vector", FEATURES, factors, settings)
    # The rows as the blocks hold them: the same draws.
    kept = staged(frame)
    blocks = forest._blocks(
        forest.kept_with(kept.withColumn("positive", F.col("label") == 1), ["positive"], "vector")
        .repartition(max(spark.sparkContext.defaultParallelism, 1)),
        spark.sparkContext.broadcast(model.bins), settings,
    ).collect()
    bins, labels, bags = [], [], []
    for one in blocks:
        begin, feature, bin = (np.frombuffer(one[n], k) for n, k in (("begin", np.int64), ("feature", np.int32), ("bin", np.uint8)))
        bins.append(forest._spread(begin, feature, bin, model.bins.zero))
        labels.append(np.frombuffer(one["positive"], bool))
        bags.append(forest._bag(settings, one["block"], len(labels[-1])))
    bins, labels, bags = np.concatenate(bins), np.concatenate(labels).astype(int), np.concatenate(bags, axis=1)
    assert len(bins) == ROWS and bins.dtype == np.uint8
    sums = np.zeros(ROWS)
    for tree in range(settings.trees):
        alone = grown_alone(bins, labels, bags[tree], factors, settings, tree, FEATURES)
        for depth, nodes in enumerate(alone):
            own = model.levels[depth].tree == tree
            assert model.levels[depth].feature[own].tolist() == [n[0] for n in nodes]
            assert model.levels[depth].chance[own] == pytest.approx([n[1] for n in nodes])
            for feature, chance, inside in nodes:
                if feature < 0:
                    sums[inside] += chance
        assert not any((level.tree == tree).any() for level in model.levels[len(alone):])
    scored = sorted(r[0] for r in model.score(frame.select("vector"), "vector", "score").collect())
    assert scored == pytest.approx(sorted(sums / settings.trees))
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_forest_learns_and_leaves_nothing_staged(spark, data):
    from textrisk import session

    dense, positive = data
    frame = staged(spark.createDataFrame(
        [(int(y), Vectors.dense(x.tolist())) for x, y in zip(dense, positive)], ["label", "vector"]
    ))
    before = list(session._made)
    model = forest.grow_forest(frame, "label", "vector", FEATURES, (1.0, 1.0), ForestSettings(25, 12, 2, 1))
    assert session._made == before
    rated = model.score(frame, "vector", "score").select("label", "score").collect()
    assert np.mean([(r.score > 0.5) == (r.label == 1) for r in rated]) > 0.85
    top = np.argsort(-model.featureImportances.toArray())[:2]
    assert set(top.tolist()) == {3, 39}


def test_one_class_gives_roots(spark):
    frame = staged(spark.createDataFrame([(1, Vectors.dense([float(i), 0.0])) for i in range(9)], ["label", "vector"]))
    model = forest.grow_forest(frame, "label", "vector", 2, (1.0, 1.0), ForestSettings(2, 4, 2, 1))
    assert len(model.levels) == 1
    assert {r.score for r in model.score(frame, "vector", "score").collect()} == {1.0}


def test_bins_are_those_of_ordered_values():
    edges = np.full((2, BINS - 1), np.inf)
    edges[0, :4] = [-2.0, -0.5, 0.0, 1.5]
    edges[1, 0] = 0.0
    bins = forest.Bins(edges, (edges < 0).sum(axis=1).astype(np.uint8))
    feature = np.array([0, 0, 0, 0, 0, 0, 1, 1, 1])
    value = np.array([-3.0, -2.0, -1.0, 0.0, 1.5, 2.0, -1.0, 0.0, 9.0])
    assert bins.of(feature, value).tolist() == [0, 0, 1, 2, 3, 4, 0, 0, 1]
    assert bins.zero.tolist() == [2, 0]


def test_forests_wait_for_others_and_equal_features_are_fitted_once(spark, monkeypatch):
    from dataclasses import dataclass

    from textrisk.operators import models
    from textrisk.operators.textvec import FeatureModel, FeatureSpec

    fitted, told = [], []
    monkeypatch.setattr(FeatureSpec, "fit", lambda self, train: fitted.append(self) or FeatureModel(self, [], [], {}))
    monkeypatch.setattr(models, "_rate", lambda *_: [{"f1": 0.5, "roc_auc": 0.5}])

    @dataclass(frozen=True)
    class Told:
        name: str
        features: FeatureSpec = FeatureSpec(max_features=7)
        alone: bool = False

        def fit(self, train, label, block):
            told.append(self.name)
            return block

    specs = {"a": Told("a", FeatureSpec(max_features=5), alone=True), "b": Told("b"), "c": Told("c")}
    found, board = models.fit_all(spark.range(1), spark.range(1), specs)
    assert [spec.max_features for spec in fitted] == [5, 7]
    assert told[-1] == "a" and sorted(told) == ["a", "b", "c"]
    assert list(found) == ["a", "b", "c"] and board.count() == 3
    assert [block.spec.max_features for block in found.values()] == [5, 7, 7]
