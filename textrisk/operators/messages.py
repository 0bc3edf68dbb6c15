"""From raw messages to clean, pseudonymous message rows.

A raw message has the columns ``file, id, type, date, date_unixtime, from_id, text``
(see ``sources``); ``present`` is false for a file without messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.functions import dates, fixed, text
from textrisk.operators.lookups import BROADCAST_ROWS, join_lookup
from textrisk.operators.ordering import number_rows
from textrisk.session import staged


def is_ordinary() -> Column:
    return F.col("type") == "message"


def keep_ordinary(raw: DataFrame) -> DataFrame:
    """Drop service entries; an entry without a type is dropped too."""
    return raw.where(is_ordinary())


def drop_blank(df: DataFrame, column: str = "text") -> DataFrame:
    """Drop null, empty and all-white-space texts."""
    return df.where(text.has_text(column))


def raw_user(from_id: Column | str = "from_id") -> Column:
    given = text.as_column(from_id).cast("string")
    return F.when(F.length(given) > 0, given).otherwise(fixed.UNKNOWN_USER)


def clean_messages(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Filter, mask, hash and date the messages: one pass, no shuffle.

    Output: ``message_hash, date, date_unixtime, hour, month, chat, raw_user_id, text``, and
    ``file`` or ``id`` if in ``keep``.
    """
    kept = drop_blank(keep_ordinary(raw)).select(
        "file",
        "id",
        "date_unixtime",
        raw_user().alias("raw_user_id"),
        text.anonymize("text").alias("text"),
        dates.parse_iso("date").alias("date"),
    )
    return kept.select(
        text.short_hash("file", "id", "raw_user_id", "text").alias("message_hash"),
        "date",
        "date_unixtime",
        F.hour("date").alias("hour"),
        dates.month_of("date").alias("month"),
        text.file_stem("file").alias("chat"),
        "raw_user_id",
        "text",
        *keep,
    )


def file_counters(raw: DataFrame) -> DataFrame:
    """Messages read, dropped and kept per file, from the raw frame. No mask is run.

    A column ``visible`` tells which texts are not blank, for frames that carry no texts.
    """
    present = F.col("present") if "present" in raw.columns else F.lit(True)
    ordinary = F.coalesce(is_ordinary(), F.lit(False))
    visible = F.col("visible") if "visible" in raw.columns else text.has_text("text")

    def tally(condition: Column, name: str) -> Column:
        return F.count_if(present & condition).alias(name)

    return raw.groupBy("file").agg(
        tally(F.lit(True), "raw_messages"),
        tally(ordinary & visible, "kept_messages"),
        tally(~ordinary, "service_or_non_message"),
        tally(ordinary & ~visible, "empty_text"),
    )


def counter_totals(counters: DataFrame) -> DataFrame:
    return counters.agg(
        F.coalesce(F.sum("raw_messages"), F.lit(0)).alias("total_raw_messages"),
        F.coalesce(F.sum("kept_messages"), F.lit(0)).alias("total_kept_messages"),
    )


def pseudonyms(df: DataFrame, user: str = "raw_user_id") -> DataFrame:
    """One row per user: the id, its pseudonym (by sorted id, from 001) and its row count."""
    users = df.groupBy(user).agg(F.count(F.lit(1)).alias("user_rows"))
    return name_users(users, user)


def name_users(users: DataFrame, user: str = "raw_user_id") -> DataFrame:
    """Add the pseudonym ``user`` to a frame with one row per raw id."""
    numbered = number_rows(users, [F.col(user)], "user_number")
    return numbered.withColumn(
        "user", F.format_string(fixed.PSEUDONYM_FORMAT, "user_number")
    ).drop("user_number")


def pseudonymize(
    df: DataFrame, user: str = "raw_user_id", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Replace raw ids by pseudonyms. Counts the users first (a job over one column)."""
    names = staged(pseudonyms(df.select(user), user))
    return join_lookup(df, names, user, "user_rows", broadcast_rows).drop(user)
