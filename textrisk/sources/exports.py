"""Chat exports: one JSON object per chat with an array of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.functions.text import flatten_rich_text

# --- fixed values: layout of an export ------------------------------------------------
MESSAGE_FIELDS = (
    "id bigint, type string, date string, date_unixtime string, from_id string, text variant"
)
EXPORT_SCHEMA = f"name string, messages array<struct<{MESSAGE_FIELDS}>>"
_FLAT = ("id", "type", "date", "date_unixtime", "from_id")


def read_chat_exports(
    spark: SparkSession, paths: str | Sequence[str], spread: int | None = None
) -> DataFrame:
    """Raw messages of all exports; a missing path or a broken document fails the read.

    One export is one JSON document and is parsed by one task, so many exports run in
    parallel but a single one does not. ``spread`` redistributes the messages afterwards.
    For exports too large for one task use one message per line (``read_message_lines``).
    A file without messages yields one row with ``present`` false, so it can be counted.
    """
    exports = spark.read.schema(EXPORT_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    exploded = exports.select(
        F.col("_metadata.file_name").alias("file"), F.explode_outer("messages").alias("m")
    )
    raw = exploded.select(
        "file",
        F.col("m").isNotNull().alias("present"),
        *[F.col(f"m.{name}").alias(name) for name in _FLAT],
        flatten_rich_text("m.text").alias("text"),
    )
    return raw if spread is None else raw.repartition(spread, "file", "id", "date")


def read_message_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw messages from files with one message object per line: splittable. A broken line
    fails the read."""
    lines = spark.read.schema(MESSAGE_FIELDS).option("mode", "FAILFAST").json(paths)
    return _flat_messages(lines)


def stream_message_lines(spark: SparkSession, path: str) -> DataFrame:
    """``read_message_lines`` as a stream over the files that arrive in a folder. A broken line
    fails the batch it is in."""
    lines = spark.readStream.schema(MESSAGE_FIELDS).option("mode", "FAILFAST")
    return _flat_messages(lines.json(path))


def _flat_messages(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_name").alias("file"),
        F.lit(True).alias("present"),
        *_FLAT,
        flatten_rich_text("text").alias("text"),
    )
