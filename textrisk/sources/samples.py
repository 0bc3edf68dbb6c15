"""Labelling samples (CSV) and run summaries (JSON)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.functions.risk import round_for_sink
from textrisk.operators.messages import counter_totals

_TYPES = {
    "label_id": "bigint", "date": "timestamp_ntz", "hour": "int", "risk_score": "double",
    "char_len": "int", "word_count": "int", "profanity_count": "int", "hostile_count": "int",
    "exclamation_count": "int", "question_count": "int", "caps_ratio": "double",
}
_ROUNDED = ("risk_score", "caps_ratio")
_CSV = {
    "header": True, "escape": '"', "encoding": "UTF-8",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def write_sample(sample: DataFrame, path: str, rounded: bool = False) -> None:
    """Write the sample's columns in their fixed order, then all others, sorted by label id.

    A file need not have all of the fixed columns. Spark writes UTF-8 without a byte order mark; ``read_sample`` accepts files with one.
    """
    known = [name for name in fixed.SAMPLE_COLUMNS if name in sample.columns]
    others = [name for name in sample.columns if name not in known]

    def cell(name: str) -> Column:
        column = F.col(f"`{name}`")
        return round_for_sink(column).alias(name) if rounded and name in _ROUNDED else column

    ordered = sample.orderBy("label_id") if "label_id" in known else sample
    ordered.select(*[cell(name) for name in [*known, *others]]).write.mode("overwrite").options(**_CSV).csv(path)


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """Read a sample or labelled file by its header, in whatever order the columns are.

    Known columns get their types; ``toxic`` and columns added by hand (scores) stay text.
    """
    text = spark.read.options(**_CSV, multiLine=True).csv(path)
    names = [name.lstrip("\ufeff") for name in text.columns]
    return text.toDF(*names).select(
        *[F.col(f"`{name}`").try_cast(_TYPES.get(name, "string")).alias(name) for name in names]
    )


def read_first_sample(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of the files that exists (the labelled one before the blank sample)."""
    for path in paths:
        found = _read_if_there(spark, path)
        if found is not None:
            return found
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_sample(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ensure_sample(
    spark: SparkSession, path: str, rows: int, build: Callable[[], DataFrame]
) -> DataFrame:
    """The sample at ``path`` if it has at least ``rows`` rows, else a new one written there."""
    existing = _read_if_there(spark, path)
    enough = existing is not None and existing.limit(rows).count() >= rows
    if not enough:
        write_sample(build(), path)
    return read_sample(spark, path)


def run_summary(counters: DataFrame, users: int, sample_rows: int, sample_path: str) -> DataFrame:
    """One row: totals over all files, users and the sample's size and place."""
    totals = counter_totals(counters)
    return totals.select("total_raw_messages", "total_kept_messages").withColumns(
        {
            "anonymous_users": F.lit(users).cast("bigint"),
            "labeling_sample_size": F.lit(sample_rows).cast("bigint"),
            "labeling_sample_path": F.lit(sample_path),
        }
    )


def write_summary(
    counters: DataFrame, users: int, sample_rows: int, sample_path: str, path: str
) -> None:
    """The summary, and beside it (``<path>_files``) the counters, one line per file."""
    run_summary(counters, users, sample_rows, sample_path).write.mode("overwrite").json(path)
    counters.write.mode("overwrite").json(f"{path.rstrip('/')}_files")
