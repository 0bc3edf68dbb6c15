"""Classifier evaluation as tables computed in Spark.

Rows are ``label`` (0/1) with a 0/1 ``prediction`` or a ``score``. The curves start from
one row per distinct score with its positive and negative counts, so copies and ties are
gone before anything is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.operators.ordering import running_totals, top_rows


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0.0 when there is nothing to divide by."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def _cells(label: str, prediction: str) -> list[Column]:
    positive, flagged = F.col(label) == 1, F.col(prediction) == 1
    return [
        F.count_if(~positive & ~flagged).alias("tn"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
        F.count_if(positive & flagged).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Four rows: label, prediction, rows (0 for an empty cell)."""
    cells = df.agg(*_cells(label, prediction))
    order = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("rows"))
        for y, p, c in order
    ]
    return cells.select(F.inline(F.array(*rows)))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, precision, recall and F1 of the positive class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = df.agg(*_cells(label, prediction)).select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )
    return rates.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted rows."""
    cells = df.agg(*_cells(label, prediction))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def side(name: str, hit: Column, flagged_wrong: Column, missed: Column) -> Column:
        precision, recall = ratio(hit, hit + flagged_wrong), ratio(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            _f1(precision, recall).alias("f1"),
            (hit + missed).alias("support"),
        )

    sides = cells.select(
        side("0", tn, fn, fp).alias("neg"),
        side("1", tp, fp, fn).alias("pos"),
        (tn + fp + fn + tp).alias("all"),
        ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
    )

    def average(name: str, weight_neg: Column, weight_pos: Column) -> Column:
        def mixed(field: str) -> Column:
            total = F.col(f"neg.{field}") * weight_neg + F.col(f"pos.{field}") * weight_pos
            return ratio(total, weight_neg + weight_pos).alias(field)

        return F.struct(
            F.lit(name).alias("class"),
            mixed("precision"), mixed("recall"), mixed("f1"),
            F.col("all").alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        F.col("accuracy").alias("f1"),
        F.col("all").alias("support"),
    )
    macro = average("macro avg", F.lit(1.0), F.lit(1.0))
    weighted = average("weighted avg", F.col("neg.support"), F.col("pos.support"))
    return sides.select(F.inline(F.array("neg", "pos", accuracy, macro, weighted)))


def score_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: its positives and negatives, and ``tp``/``fp`` when the cut is there.

    Also ``all_pos`` and ``all_neg``. The sort is a range partitioning, not one task; the
    result is staged, so several curves can share it.
    """
    points = (
        df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
        )
    )
    ranked = running_totals(
        points, [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    totals = ranked.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return ranked.withColumns(
        {
            "all_pos": totals.select("all_pos").scalar(),
            "all_neg": totals.select("all_neg").scalar(),
        }
    )


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the ROC curve; ties count half. Null when a class is missing."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    pairs = F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return points.agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))


def roc_points(points: DataFrame) -> DataFrame:
    """False and true positive rate per threshold, and the origin (threshold null)."""
    curve = points.select(
        "threshold",
        ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    return curve.unionByName(_end_row(points, {"fpr": 0.0, "tpr": 0.0}))


def pr_points(points: DataFrame) -> DataFrame:
    """Precision and recall per threshold, and the end point (threshold null)."""
    curve = points.select("threshold", *_precision_recall())
    return curve.unionByName(_end_row(points, {"precision": 1.0, "recall": 0.0}))


def _precision_recall() -> list[Column]:
    return [
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
    ]


def _end_row(points: DataFrame, values: dict[str, float]) -> DataFrame:
    return points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(v).alias(n) for n, v in values.items()],
    )


def average_precision(points: DataFrame) -> DataFrame:
    """Sum of precision times the step in recall, from the highest score down."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return points.agg(
        F.sum(precision * F.col("pos") / F.col("all_pos")).alias("average_precision")
    )


def best_threshold(points: DataFrame) -> DataFrame:
    """The threshold with the highest F1; the highest such threshold on ties."""
    rated = points.select("threshold", *_precision_recall()).withColumn(
        "f1", F.round(_f1(F.col("precision"), F.col("recall")), 12)
    )
    return top_rows(rated, [F.desc("f1"), F.desc("threshold")], 1)


def calibration_bins(
    df: DataFrame, label: str = "label", score: str = "score", bins: int = 10
) -> DataFrame:
    """Per score bin: rows, mean score and share of positives."""
    bucket = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(bucket.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("positive_share"),
    )


def error_slices(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The wrongly classified rows, marked FP or FN."""
    wrong = df.where(F.col(label) != F.col(prediction))
    return wrong.withColumn(
        "error", F.when(F.col(prediction) == 1, F.lit("FP")).otherwise(F.lit("FN"))
    )
