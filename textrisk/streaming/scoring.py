"""The stateless part of the work on a stream, and the hourly trend over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.functions.risk import Lexicon, add_features
from textrisk.operators.messages import clean_messages


def featured_stream(raw: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """Clean messages with features. Pseudonyms need all users, so raw ids are hashed away."""
    clean = clean_messages(raw).withColumn("user", F.substring(F.sha2("raw_user_id", 256), 1, 16))
    return add_features(clean.drop("raw_user_id"), lexicon=lexicon)


def hourly_stream(
    scored: DataFrame, score: str = "risk_score", lateness: str = "1 hour"
) -> DataFrame:
    """Mean score and count per clock hour; an hour is final once the watermark passed it.

    A watermark needs a time with a zone, so the wall clock is read in the session's zone.
    """
    timed = scored.where(F.col("date").isNotNull()).withColumn("at", F.col("date").cast("timestamp"))
    hours = timed.withWatermark("at", lateness).groupBy(F.window("at", "1 hour"))
    return hours.agg(
        F.avg(score).alias("mean_toxicity"), F.count(F.lit(1)).alias("messages")
    ).select(F.col("window.start").alias("hour_start"), "mean_toxicity", "messages")
