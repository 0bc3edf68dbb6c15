"""Classifiers on MLlib: fitting, probabilities, leaderboard, sweeps, search, importances.

A fit runs on the cluster; the driver only decides what to fit next. Small result tables
(one row per model, size or trial) come back as DataFrames.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields, replace
from functools import reduce
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.operators.evaluation import binary_metrics
from textrisk.operators.forest import ForestSettings, grow_forest
from textrisk.operators.ordering import top_rows
from textrisk.operators.sampling import assign_folds, learning_prefixes, stratified_subsample
from textrisk.operators.studies import Fit, rate_fits
from textrisk.operators.summary import class_weights
from textrisk.operators.textvec import FeatureModel, FeatureSpec
from textrisk.session import staged

_WEIGHT = "_weight"
_VECTOR = "features"


@dataclass(frozen=True)
class ClassCounts:
    rows: int
    negatives: int
    positives: int
    smallest: int
    balanced: Mapping[int, float]
    pos_weight: float


def count_classes(df: DataFrame, label: str = "toxic") -> ClassCounts:
    found = {row[label]: row for row in class_weights(df, label).collect()}  # one row per class
    counts = {k: row["count"] for k, row in found.items()}
    return ClassCounts(
        sum(counts.values()),
        counts.get(0, 0),
        counts.get(1, 0),
        min(counts.values()),
        {k: row["balanced_weight"] for k, row in found.items()},
        next(iter(found.values()))["pos_weight"],
    )


def balanced_weight(label: str, counts: ClassCounts) -> Column:
    weight = F.lit(1.0)
    for value, factor in counts.balanced.items():
        weight = F.when(F.col(label) == value, F.lit(float(factor))).otherwise(weight)
    return weight


def positive_weight(label: str, counts: ClassCounts) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(counts.pos_weight))).otherwise(F.lit(1.0))


def _ready(vectors: DataFrame) -> DataFrame:
    """Vectors made with all tasks and staged, then dealt evenly, one part per core: every
    training iteration is a job over all parts."""
    return staged(vectors).repartition(vectors.sparkSession.sparkContext.defaultParallelism)


@dataclass(frozen=True)
class FittedClassifier:
    """Feature block and model. ``score`` appends the positive-class probability."""

    features: FeatureModel
    probability: Callable[[DataFrame], DataFrame] = field(repr=False)
    model: Any = field(repr=False, default=None)

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        scored = self.probability(self.features.transform(df))
        return scored.withColumnRenamed("_probability", name).drop(_VECTOR)

    def predict(self, df: DataFrame, cut: float = 0.5) -> DataFrame:
        """Append ``score`` and the 0/1 ``prediction``."""
        return self.score(df).withColumn("prediction", (F.col("score") > cut).cast("int"))


def _positive(model, df: DataFrame) -> DataFrame:
    scored = model.transform(df).withColumn(
        "_probability", F.get(vector_to_array("probability"), F.lit(1))
    )
    return scored.drop("rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class LogisticSpec:
    """Balanced logistic regression with an L2 penalty of strength 1/C."""

    features: FeatureSpec = FeatureSpec(max_features=15_000)
    max_iter: int = 1000
    c: float = 1.0

    def fit(
        self, train: DataFrame, label: str = "toxic", block: FeatureModel | None = None
    ) -> FittedClassifier:
        counts = count_classes(train, label)
        block = block or self.features.fit(train)
        ready = block.transform(train).withColumn(_WEIGHT, balanced_weight(label, counts))
        model = LogisticRegression(
            featuresCol=_VECTOR, labelCol=label, weightCol=_WEIGHT, maxIter=self.max_iter,
            standardization=False, regParam=1.0 / (self.c * counts.rows),
        ).fit(_ready(ready.select(label, _VECTOR, _WEIGHT)))
        return FittedClassifier(block, lambda df: _positive(model, df), model)


@dataclass(frozen=True)
class CalibratedSvmSpec:
    """Balanced linear SVM per fold; each fold's held-out rows fit a sigmoid on the margin
    (``fit_sigmoid``), and the probability is the mean over the folds."""

    features: FeatureSpec = FeatureSpec(max_features=15_000)
    max_folds: int = 3
    max_iter: int = 100
    id_columns: Sequence[str] = ("message_hash",)
    seed: int = fixed.DEFAULT_SEED

    def fit(
        self, train: DataFrame, label: str = "toxic", block: FeatureModel | None = None
    ) -> FittedClassifier:
        counts = count_classes(train, label)
        folds = max(2, min(self.max_folds, counts.smallest))
        block = block or self.features.fit(train)
        ready = assign_folds(train, label, self.id_columns, folds, self.seed, "_fold")
        ready = block.transform(ready).withColumn(_WEIGHT, balanced_weight(label, counts))
        ready = _ready(ready.select(label, _VECTOR, _WEIGHT, "_fold"))
        ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            pairs = [self._fit_fold(ready, fold, label, counts) for fold in range(folds)]
        finally:
            ready.unpersist()

        def probability(df: DataFrame) -> DataFrame:
            total = F.lit(0.0)
            for i, (svm, slope, intercept) in enumerate(pairs):
                df = svm.transform(df).drop("prediction")
                margin = F.get(vector_to_array("rawPrediction"), F.lit(1))
                df = df.withColumn(f"_p{i}", 1 / (1 + F.exp(-(margin * slope + intercept))))
                df = df.drop("rawPrediction")
                total = total + F.col(f"_p{i}")
            mean = total / len(pairs)
            return df.withColumn("_probability", mean).drop(*[f"_p{i}" for i in range(len(pairs))])

        return FittedClassifier(block, probability, [svm for svm, _, _ in pairs])

    def _fit_fold(self, ready: DataFrame, fold: int, label: str, counts: ClassCounts):
        inside = ready.where(F.col("_fold") != fold)
        svm = LinearSVC(
            featuresCol=_VECTOR, labelCol=label, weightCol=_WEIGHT, maxIter=self.max_iter,
            standardization=False, regParam=1.0 / counts.rows,
        ).fit(inside)
        held = svm.transform(ready.where(F.col("_fold") == fold)).withColumn(
            "_margin", F.get(vector_to_array("rawPrediction"), F.lit(1))
        )
        return svm, *fit_sigmoid(held.select(label, "_margin"), label, "_margin")


def fit_sigmoid(rows: DataFrame, label: str, margin: str) -> tuple[float, float]:
    """Slope and intercept of the chance of a positive as a sigmoid of the margin.

    The targets are smoothed, (p + 1) / (p + 2) for positives and 1 / (n + 2) for negatives with
    ``p`` and ``n`` rows of either class, so classes that a margin separates get a finite
    slope. A soft target is a row of each class, weighted by the target and its rest.
    """
    positive = F.col(label) == 1
    counts = rows.agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n")).first()
    target = F.when(positive, (counts["p"] + 1.0) / (counts["p"] + 2.0)).otherwise(1.0 / (counts["n"] + 2.0))
    sides = F.array(
        F.struct(F.lit(1.0).alias("side"), target.alias(_WEIGHT)),
        F.struct(F.lit(0.0).alias("side"), (1.0 - target).alias(_WEIGHT)),
    )
    soft = rows.select(margin, F.inline(sides))
    margins = VectorAssembler(inputCols=[margin], outputCol="_margins").transform(soft)
    sigmoid = LogisticRegression(featuresCol="_margins", labelCol="side", weightCol=_WEIGHT).fit(margins)
    return float(sigmoid.coefficients[0]), float(sigmoid.intercept)


@dataclass(frozen=True)
class ForestSpec:
    """Balanced random forest (``forest``), grown level by level on the whole cluster."""

    features: FeatureSpec = FeatureSpec(max_features=5_000)
    trees: int = 300
    min_leaf: int = 2
    depth: int = 30
    seed: int = fixed.DEFAULT_SEED
    #: Its long stages would hold up the many short jobs of other fits.
    alone = True

    def fit(
        self, train: DataFrame, label: str = "toxic", block: FeatureModel | None = None
    ) -> FittedClassifier:
        counts = count_classes(train, label)
        block = block or self.features.fit(train)
        ready = staged(block.transform(train).select(label, _VECTOR))
        factors = [float(counts.balanced.get(value, 1.0)) for value in (0, 1)]
        settings = ForestSettings(self.trees, self.depth, self.min_leaf, self.seed)
        model = grow_forest(ready, label, _VECTOR, len(block.names), factors, settings)
        return FittedClassifier(block, lambda df: model.score(df, _VECTOR, "_probability"), model)


@dataclass(frozen=True)
class BoostedSpec:
    """Gradient-boosted trees with logistic loss; positives weigh negatives / positives."""

    features: FeatureSpec = FeatureSpec(
        numeric=fixed.BOOSTED_FEATURES, max_df=0.95, max_features=20_000, sublinear=True,
        scale=False,
    )
    # fixed values: default settings of the boosted trees
    rounds: int = 250
    depth: int = 3
    rate: float = 0.08
    row_share: float = 0.9
    column_share: float = 0.9
    min_leaf: int = 1
    seed: int = fixed.DEFAULT_SEED

    def fit(
        self, train: DataFrame, label: str = "toxic", block: FeatureModel | None = None
    ) -> FittedClassifier:
        counts = count_classes(train, label)
        block = block or self.features.fit(train)
        ready = block.transform(train).withColumn(_WEIGHT, positive_weight(label, counts))
        model = GBTClassifier(
            featuresCol=_VECTOR, labelCol=label, weightCol=_WEIGHT, maxIter=self.rounds,
            maxDepth=self.depth, stepSize=self.rate, subsamplingRate=self.row_share,
            featureSubsetStrategy=str(self.column_share), minInstancesPerNode=self.min_leaf,
            seed=self.seed,
        ).fit(_ready(ready.select(label, _VECTOR, _WEIGHT)))
        return FittedClassifier(block, lambda df: _positive(model, df), model)


DEFAULT_MODELS: Mapping[str, Any] = {
    "Logistic Regression": LogisticSpec(),
    "Linear SVM": CalibratedSvmSpec(),
    "RandomForest": ForestSpec(),
}


def quality(rated: DataFrame, label: str = "toxic") -> dict[str, float]:
    """F1 and ROC-AUC of rows with ``score`` and ``prediction``."""
    kept = rated.select(F.col(label).cast("double").alias("label"), "score", "prediction")
    auc = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(kept)
    return {"f1": float(binary_metrics(kept).first()["f1"]), "roc_auc": float(auc)}


def _rate(fitted: FittedClassifier, df: DataFrame, label: str, *parts: Column) -> list[dict]:
    """Quality on each part of ``df``; every row is scored once."""
    flags = {f"_part{i}": part for i, part in enumerate(parts)}
    rated = fitted.predict(df).select(label, "score", "prediction", *[c.alias(n) for n, c in flags.items()])
    rated = rated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [quality(rated.where(name), label) for name in flags]
    finally:
        rated.unpersist()


def _submit(work: Callable, items: Sequence, parallelism: int) -> list:
    """Run ``work`` for each item, ``parallelism`` at a time, from driver threads."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(work, items))


def fit_all(
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Any] = DEFAULT_MODELS,
    label: str = "toxic",
    parallelism: int = 3,
) -> tuple[dict[str, FittedClassifier], DataFrame]:
    """Fit every model and rate it on the test rows: the models and their leaderboard.

    Specs that are to be ``alone`` are fitted one by one after the others. Specs of equal
    features share the fitted block.
    """
    blocks: list[FeatureModel] = []
    for features in [getattr(spec, "features", None) for spec in models.values()]:
        if isinstance(features, FeatureSpec) and all(block.spec != features for block in blocks):
            blocks.append(features.fit(train))

    def fit(spec) -> tuple[FittedClassifier, dict]:
        known = [block for block in blocks if block.spec == getattr(spec, "features", None)]
        model = spec.fit(train, label, *known)
        return model, _rate(model, test, label, F.lit(True))[0]

    alone = [name for name, spec in models.items() if getattr(spec, "alone", False)]
    done = {}
    for names, at_once in (([n for n in models if n not in alone], parallelism), (alone, 1)):
        done |= zip(names, _submit(fit, [models[name] for name in names], at_once))
    done = {name: done[name] for name in models}
    rows = [(name, rating["f1"], rating["roc_auc"]) for name, (_, rating) in done.items()]
    board = train.sparkSession.createDataFrame(rows, "model string, f1 double, roc_auc double")
    return {name: model for name, (model, _) in done.items()}, leaderboard(board)


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("f1"), F.desc("roc_auc"), "model")


def best_model(metrics: DataFrame) -> str:
    best = top_rows(metrics, [F.desc("f1"), F.desc("roc_auc"), F.asc("model")], 1)
    return best.first()["model"]


def score_messages(
    fitted: FittedClassifier, messages: DataFrame, name: str = "toxicity_score"
) -> DataFrame:
    """Score all messages and keep the columns that identify nobody. A map, no shuffle."""
    kept = ["message_hash", "chat", "date", "hour", "month", "user"]
    return fitted.score(messages, name).select(*kept, name)


def run_fits(
    rows: DataFrame, spec, fits: Sequence[Fit], label: str = "toxic", parallelism: int = 2
) -> list[dict[str, float]]:
    """Both sides of every fit rated, in the order of ``fits``; see ``studies`` for the rows.

    A spec with ``score_fits`` scores all fits over shared passes. Others are fitted one by
    one, ``parallelism`` at a time, each on the whole cluster.
    """
    if hasattr(spec, "score_fits"):
        # Two rows per fit.
        found = {(r["fit"], r["teaches"]): r for r in rate_fits(spec.score_fits(rows, fits, label), label).collect()}
        return [
            {
                f"{side}_{name}": float(found[fit.number, teaches][name])
                for side, teaches in (("train", True), ("cv", False))
                for name in ("f1", "roc_auc")
            }
            for fit in fits
        ]

    def rate(fit: Fit) -> dict[str, float]:
        own = rows if "part" not in rows.columns else rows.where(F.col("part") == fit.part)
        inside = F.col("fold") != fit.fold
        inside = inside if fit.step is None else inside & (F.col("prefix") <= fit.step)
        fitted = with_settings(spec, fit.settings).fit(own.where(inside), label)
        train, valid = _rate(fitted, own, label, inside, F.col("fold") == fit.fold)
        return {
            "train_f1": train["f1"], "train_roc_auc": train["roc_auc"],
            "cv_f1": valid["f1"], "cv_roc_auc": valid["roc_auc"],
        }

    return _submit(rate, fits, parallelism)


def bounded(train: DataFrame, spec, label: str, id_columns: Sequence[str], seed: int) -> DataFrame:
    """As many rows as a spec may ``fit`` in one task (``most_rows``), drawn from ``train``. Studies and
    ``fit_whole`` take all rows."""
    most = getattr(spec, "most_rows", None)
    return train if most is None else stratified_subsample(train, label, id_columns, most, seed)


def fit_whole(train: DataFrame, spec, label: str = "toxic"):
    """A spec fitted to all rows, however many: by all tasks together if its ``fit`` is bounded."""
    return getattr(spec, "fit_spread", spec.fit)(train, label)


def _mean_std(results: Sequence[Mapping[str, float]], name: str) -> tuple[float, float]:
    values = [r[name] for r in results]
    mean = sum(values) / len(values)
    return mean, (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5


def _folds_for(smallest: int, most: int) -> int:
    return max(2, min(most, smallest))


def size_sweep(
    train: DataFrame,
    spec,
    sizes: Sequence[int],
    id_columns: Sequence[str],
    label: str = "toxic",
    max_folds: int = 5,
    seed: int = fixed.DEFAULT_SEED,
) -> DataFrame:
    """Cross-validated F1 by training size, up to and including all rows."""
    total = train.count()
    drawn, counted, fits = [], [], []
    for part, size in enumerate(sorted({s for s in sizes if s <= total} | {total})):
        sample = stratified_subsample(train, label, id_columns, size, seed)
        counts = count_classes(sample, label)
        folds = _folds_for(counts.smallest, max_folds)
        folded = assign_folds(sample, label, id_columns, folds, seed)
        drawn.append(folded.withColumn("part", F.lit(part)))
        counted.append(counts)
        fits += [Fit(len(fits) + fold, fold, part) for fold in range(folds)]
    rows = staged(reduce(DataFrame.unionByName, drawn))
    rated = run_fits(rows, spec, fits, label)
    table = []
    for part, counts in enumerate(counted):
        results = [result for fit, result in zip(fits, rated) if fit.part == part]
        table.append(
            (counts.rows, *_mean_std(results, "train_f1"), *_mean_std(results, "cv_f1"),
             counts.positives / counts.rows)
        )
    return train.sparkSession.createDataFrame(
        table,
        "sample_size bigint, train_f1_mean double, train_f1_std double, "
        "cv_f1_mean double, cv_f1_std double, positive_share double",
    )


def near_best_size(sweep: DataFrame, tolerance: float = 0.98) -> DataFrame:
    """The smallest size whose F1 is at least ``tolerance`` of the best."""
    best = sweep.agg(F.max("cv_f1_mean").alias("best")).scalar()
    return sweep.where(F.col("cv_f1_mean") >= best * F.lit(tolerance)).agg(
        F.min("sample_size").alias("sample_size")
    )


def draw_settings(trials: int, seed: int = fixed.DEFAULT_SEED) -> list[dict[str, Any]]:
    """Random settings of the boosted pipeline, in ten dimensions. MLlib trees have no leaf
    penalties: ``with_settings`` leaves out what a spec does not have."""
    source = random.Random(seed)
    # fixed values: ranges of the search
    return [
        {
            "max_features": source.randint(3000, 25000),
            "ngram_high": source.choice([1, 2, 3]),
            "rounds": source.randint(120, 600),
            "depth": source.randint(2, 6),
            "rate": source.uniform(0.02, 0.18),
            "row_share": source.uniform(0.65, 1.0),
            "column_share": source.uniform(0.65, 1.0),
            "min_leaf": source.randint(1, 7),
            "l1": source.uniform(0.0, 1.0),
            "l2": source.uniform(0.5, 3.5),
        }
        for _ in range(trials)
    ]


def with_settings(spec, settings: Mapping[str, Any]):
    if hasattr(spec, "with_settings"):
        return spec.with_settings(settings)
    text = {}
    if "max_features" in settings:
        text["max_features"] = settings["max_features"]
    if "ngram_high" in settings:
        text["ngram_range"] = (1, settings["ngram_high"])
    own = {one.name for one in fields(spec)}
    trees = {k: v for k, v in settings.items() if k in own}
    return replace(spec, features=replace(spec.features, **text), **trees) if text else replace(spec, **trees)


def random_search(
    train: DataFrame,
    spec,
    settings: Sequence[Mapping[str, Any]],
    id_columns: Sequence[str],
    label: str = "toxic",
    max_folds: int = 5,
    parallelism: int = 2,
    seed: int = fixed.DEFAULT_SEED,
) -> tuple[DataFrame, Any]:
    """Rate settings over the same folds; the table of trials and the spec with the best F1.

    Fits of a spec without ``score_fits`` are submitted ``parallelism`` at a time; each runs
    on the whole cluster.
    """
    folds = _folds_for(count_classes(train, label).smallest, max_folds)
    folded = staged(assign_folds(train, label, id_columns, folds, seed))
    fits = [
        Fit(trial * folds + fold, fold, settings=chosen)
        for trial, chosen in enumerate(settings)
        for fold in range(folds)
    ]
    every = run_fits(folded, spec, fits, label, parallelism)
    rated = [every[trial * folds : (trial + 1) * folds] for trial in range(len(settings))]
    rows = []  # ranked by the rounded mean, so that equal folds tie whatever order they come in
    for trial, (chosen, results) in enumerate(zip(settings, rated)):
        mean_f1, std_f1 = _mean_std(results, "cv_f1")
        rows.append(
            (trial, mean_f1, std_f1, _mean_std(results, "cv_roc_auc")[0],
             _mean_std(results, "train_f1")[0], ", ".join(f"{k}={v}" for k, v in chosen.items()))
        )
    ranked = [(1 + sum(round(r[1], 9) > round(row[1], 9) for r in rows), *row) for row in rows]
    best = next(row[1:] for row in ranked if row[0] == 1)
    table = train.sparkSession.createDataFrame(
        ranked,
        "rank_test_f1 int, trial int, mean_test_f1 double, std_test_f1 double, "
        "mean_test_roc_auc double, mean_train_f1 double, params string",
    )
    return table.orderBy("rank_test_f1", "trial"), with_settings(spec, settings[best[0]])


def learning_curve(
    train: DataFrame,
    spec,
    fractions: Sequence[float],
    id_columns: Sequence[str],
    label: str = "toxic",
    max_folds: int = 5,
    seed: int = fixed.DEFAULT_SEED,
) -> DataFrame:
    """F1 and ROC-AUC on growing, nested parts of each training fold."""
    folds = _folds_for(count_classes(train, label).smallest, max_folds)
    fractions = sorted(fractions)
    folded = assign_folds(train, label, id_columns, folds, seed)
    folded = staged(learning_prefixes(folded, label, id_columns, fractions, seed))
    fits = [
        Fit((step - 1) * folds + fold, fold, step=step)
        for step in range(1, len(fractions) + 1)
        for fold in range(folds)
    ]
    every = run_fits(folded, spec, fits, label)
    sizes = dict(folded.where(F.col("fold") != 0).groupBy("prefix").count().collect())
    rows = []
    for step in range(1, len(fractions) + 1):
        results = every[(step - 1) * folds : step * folds]
        size = sum(n for prefix, n in sizes.items() if prefix <= step)
        summary = [
            value
            for name in ("train_f1", "cv_f1", "train_roc_auc", "cv_roc_auc")
            for value in _mean_std(results, name)
        ]
        rows.append((size, *summary))
    return train.sparkSession.createDataFrame(
        rows,
        "train_size bigint, train_f1_mean double, train_f1_std double, cv_f1_mean double, "
        "cv_f1_std double, train_roc_auc_mean double, train_roc_auc_std double, "
        "cv_roc_auc_mean double, cv_roc_auc_std double",
    )


def feature_importance(fitted, spark, count: int = 30) -> DataFrame:
    """The most important features by name (at most one row per vector slot is built)."""
    if hasattr(fitted, "importance"):
        rows = list(fitted.importance().items())
    else:
        weights = fitted.model.featureImportances.toArray()
        rows = [(n, float(w)) for n, w in zip(fitted.features.names, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return top_rows(table, [F.desc("importance"), F.asc("feature")], count)
