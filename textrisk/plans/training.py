"""Train the classifiers, pick the best, score all messages, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.operators import evaluation, models, trends
from textrisk.operators.boosted_fits import PenalisedSpec
from textrisk.operators.checks import require_classes, require_columns
from textrisk.operators.labels import resolve_labels, training_rows
from textrisk.operators.sampling import holdout_split, stratified_subsample
from textrisk.operators.summary import class_balance
from textrisk.session import staged


@dataclass(frozen=True)
class Report:
    """``tables`` holds the result tables by name, ``fitted`` the chosen model."""

    best: str
    fitted: models.FittedClassifier
    tables: Mapping[str, DataFrame]


def train_and_report(
    labelled: DataFrame,
    messages: DataFrame,
    specs: Mapping[str, Any] = models.DEFAULT_MODELS,
    id_columns: Sequence[str] = ("message_hash",),
    seed: int = fixed.DEFAULT_SEED,
    min_messages: int = 100,
) -> Report:
    """``labelled`` is a sample (labels in any accepted form), ``messages`` have features."""
    resolved = resolve_labels(labelled)
    require_columns(resolved, ["text", "toxic", *fixed.FEATURES])
    rows = staged(resolved)
    require_classes(rows)
    split = holdout_split(rows, "toxic", id_columns, 0.2, seed)
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    fitted, board = models.fit_all(train, test, specs)
    best = models.best_model(board)
    rated = staged(
        fitted[best].predict(test).select(*id_columns, "toxic", "score", "prediction")
    )
    scored = staged(models.score_messages(fitted[best], messages))
    tables = {
        "class_balance": class_balance(rows),
        "leaderboard": board,
        "confusion_matrix": evaluation.confusion_matrix(rated, "toxic"),
        "roc_points": evaluation.roc_points(evaluation.score_points(rated, "toxic")),
        "errors": evaluation.error_slices(rated, "toxic"),
        "scored": scored,
        "hourly": trends.hourly_trend(scored),
        "day_parts": trends.day_part_trend(scored),
        "monthly": trends.monthly_trend(scored),
        "top_users": trends.top_users(scored, min_messages),
    }
    return Report(best, fitted[best], tables)


# fixed values: training sizes tried, parts of the learning curve, size of the search
SIZES = (200, 500, 1000, 2000, 5000, 10000)
FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)
TRIALS = 30
SWEEP_ROUNDS = 180


def boosted_study(
    labelled: DataFrame,
    spec=PenalisedSpec(),
    sweep_spec=PenalisedSpec(rounds=SWEEP_ROUNDS),
    sizes: Sequence[int] = SIZES,
    settings: Sequence[Mapping[str, Any]] | None = None,
    fractions: Sequence[float] = FRACTIONS,
    id_columns: Sequence[str] = ("message_hash",),
    max_folds: int = 5,
    parallelism: int = 2,
    seed: int = fixed.DEFAULT_SEED,
) -> Report:
    """Choose a training size, search the settings, refit, and report the boosted trees.

    Fits of a spec with ``score_fits`` share their passes. All fits learn from all rows they are
    given, however many.
    """
    rows = staged(training_rows(labelled))
    require_classes(rows)
    split = staged(holdout_split(rows, "toxic", id_columns, 0.2, seed))
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    sweep = models.size_sweep(train, sweep_spec, sizes, id_columns, max_folds=max_folds, seed=seed)
    size = models.near_best_size(sweep).first()["sample_size"]
    tuned = stratified_subsample(train, "toxic", id_columns, size, seed=seed)
    trials, chosen = models.random_search(
        tuned, spec, models.draw_settings(TRIALS, seed) if settings is None else settings,
        id_columns, max_folds=max_folds, parallelism=parallelism, seed=seed,
    )
    fitted = models.fit_whole(train, chosen)
    rated = staged(fitted.predict(test).select(*id_columns, "toxic", "score", "prediction"))
    points = evaluation.score_points(rated, "toxic")
    tables = {
        "class_balance": class_balance(rows),
        "size_sweep": sweep,
        "search": trials,
        "metrics": evaluation.binary_metrics(rated, "toxic").withColumn(
            "roc_auc", evaluation.roc_auc(points).scalar()
        ),
        "class_report": evaluation.class_report(rated, "toxic"),
        "confusion_matrix": evaluation.confusion_matrix(rated, "toxic"),
        "roc_points": evaluation.roc_points(points),
        "pr_points": evaluation.pr_points(points),
        "average_precision": evaluation.average_precision(points),
        "learning_curve": models.learning_curve(
            train, chosen, fractions, id_columns, max_folds=max_folds, seed=seed
        ),
        "feature_importance": models.feature_importance(fitted, labelled.sparkSession),
    }
    return Report("boosted", fitted, tables)
