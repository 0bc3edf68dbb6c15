"""Mean score and message count over time and users.

Every table is one aggregation with partial sums on the scan side, so a busy hour,
month or user does not load a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.functions import dates
from textrisk.operators.messages import name_users
from textrisk.operators.ordering import top_rows


def _mean_and_count(score: str):
    return F.avg(score).alias("mean_toxicity"), F.count(F.lit(1)).alias("messages")


def hourly_trend(scored: DataFrame, score: str = "toxicity_score") -> DataFrame:
    """Per hour of day; hours without messages have no row."""
    return scored.dropna(subset=["hour"]).groupBy("hour").agg(*_mean_and_count(score))


def day_part_trend(scored: DataFrame, score: str = "toxicity_score") -> DataFrame:
    """Evening against the rest of the day, highest mean first."""
    parts = scored.dropna(subset=["hour"]).withColumn("time_period", dates.day_part("hour"))
    return parts.groupBy("time_period").agg(*_mean_and_count(score)).orderBy(
        F.desc("mean_toxicity"), "time_period"
    )


def monthly_trend(scored: DataFrame, score: str = "toxicity_score") -> DataFrame:
    """Per calendar month from the first to the last, by month end; empty months count 0."""
    filled = (
        scored.dropna(subset=["date"])
        .groupBy(dates.month_end("date").alias("month_end"))
        .agg(*_mean_and_count(score))
    )
    first, last = F.trunc(F.min("month_end"), "month"), F.trunc(F.max("month_end"), "month")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    ends = F.transform(months, lambda month: F.last_day(month))
    spine = filled.agg(ends.alias("ends")).select(F.explode("ends").alias("month_end"))
    return spine.join(filled, "month_end", "left").select(
        "month_end", "mean_toxicity", F.coalesce("messages", F.lit(0)).alias("messages")
    )


def user_trend(scored: DataFrame, user: str = "user", score: str = "toxicity_score") -> DataFrame:
    return scored.groupBy(user).agg(*_mean_and_count(score))


def top_users(
    scored: DataFrame,
    min_messages: int = 100,
    count: int = 10,
    user: str = "user",
    score: str = "toxicity_score",
) -> DataFrame:
    """Users with enough messages, highest mean score first."""
    enough = user_trend(scored, user, score).where(F.col("messages") >= min_messages)
    return top_rows(enough, [F.desc("mean_toxicity"), F.asc(user)], count)


def top_raw_users(
    scored: DataFrame, min_messages: int = 100, count: int = 10, score: str = "toxicity_score"
) -> DataFrame:
    """``top_users`` for scored rows that still carry raw ids.

    Aggregates first and names the users on the aggregate, which saves the join of all
    messages with the pseudonyms.
    """
    named = name_users(user_trend(scored, "raw_user_id", score), "raw_user_id")
    enough = named.drop("raw_user_id").where(F.col("messages") >= min_messages)
    return top_rows(enough, [F.desc("mean_toxicity"), F.asc("user")], count)
