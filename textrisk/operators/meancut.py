"""A classifier in closed form: one number, cut between the means of the two classes."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.operators.studies import Fit, with_fits


def cut_score(value: Column, low: Column, high: Column, position: Column) -> Column:
    """0 to 1, and 0.5 at the cut. ``low`` and ``high`` are the means of negatives and positives,
    ``position`` the place of the cut between them. Classes with equal means, or only one
    class, give 0.5 everywhere."""
    span = high - low
    raw = F.lit(0.5) + (value - (low + position * span)) / span * F.lit(0.5)
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))
    return F.when(span != 0, bounded).otherwise(F.lit(0.5))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _means(value: Column, label: str) -> list[Column]:
    return [
        F.avg(F.when(F.col(label) == mark, value)).alias(name) for name, mark in (("low", 0), ("high", 1))
    ]


@dataclass(frozen=True)
class FittedMeanCut:
    number: str
    low: float | None
    high: float | None
    position: float

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        ends = [F.lit(end).cast("double") for end in (self.low, self.high)]
        return df.withColumn(name, cut_score(_number(self.number), *ends, F.lit(self.position)))

    def predict(self, df: DataFrame, cut: float = 0.5) -> DataFrame:
        return self.score(df).withColumn("prediction", (F.col("score") > cut).cast("int"))


@dataclass(frozen=True)
class MeanCutSpec:
    """Null numbers count as 0."""

    number: str = "risk_score"
    position: float = 0.5

    def with_settings(self, settings) -> "MeanCutSpec":
        return replace(self, **settings)

    def fit(self, train: DataFrame, label: str = "toxic") -> FittedMeanCut:
        means = train.agg(*_means(_number(self.number), label)).first()
        return FittedMeanCut(self.number, means["low"], means["high"], self.position)

    def score_fits(self, rows: DataFrame, fits: Sequence[Fit], label: str = "toxic") -> DataFrame:
        """``fit``, ``teaches``, the label, ``score`` and ``prediction`` of every row in every fit:
        one aggregation for the means of all fits, one map for the scores."""
        specs = [self.with_settings(fit.settings) for fit in fits]
        member = with_fits(
            rows, fits, number=("string", [s.number for s in specs]),
            position=("double", [s.position for s in specs]),
        )
        names = sorted({s.number for s in specs})
        value = F.coalesce(*[F.when(F.col("number") == name, _number(name)) for name in names])
        member = member.select("fit", "teaches", label, "position", value.alias("value"))
        # One row per fit.
        means = member.where("teaches").groupBy("fit").agg(*_means(F.col("value"), label))
        score = cut_score(F.col("value"), F.col("low"), F.col("high"), F.col("position"))
        scored = member.join(F.broadcast(means), "fit", "left").withColumn("score", score)
        return scored.select(
            "fit", "teaches", label, "score", (F.col("score") > 0.5).cast("int").alias("prediction")
        )


def draw_cuts(trials: int, seed: int = fixed.DEFAULT_SEED) -> list[dict]:
    """Random settings: the number, and the place of the cut."""
    source = random.Random(seed)
    return [
        {"number": source.choice(fixed.BOOSTED_FEATURES), "position": round(source.uniform(0.1, 0.9), 3)}
        for _ in range(trials)
    ]
