"""Checks before and after the work."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.functions.text import has_text


def require_columns(df: DataFrame, needed: Iterable[str]) -> None:
    """Fail with the sorted list of missing columns. Looks at the schema only."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def class_guard(df: DataFrame, label: str = "toxic", smallest: int = 5) -> DataFrame:
    """One row: number of classes, rows of the rarest class, and whether training may start."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    return counts.agg(
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.min("count"), F.lit(0)).alias("smallest_class"),
        (F.count(F.lit(1)) >= 2).alias("trainable"),
        (F.coalesce(F.min("count"), F.lit(0)) >= smallest).alias("stable"),
    )


def require_classes(df: DataFrame, label: str = "toxic", smallest: int = 5) -> int:
    """Raise when there is only one class, warn when one is tiny; rows of the rarest class."""
    found = class_guard(df, label, smallest).first()
    if not found["trainable"]:
        raise ValueError(f"'{label}' has fewer than two classes")
    if not found["stable"]:
        warnings.warn(f"a class of '{label}' has fewer than {smallest} rows", stacklevel=2)
    return found["smallest_class"]


def message_checks(messages: DataFrame) -> DataFrame:
    """One row of violation counts over pseudonymous messages; all zero is good."""
    raw_ids = 1 if "raw_user_id" in messages.columns else 0
    return messages.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~has_text("text")).alias("empty_text"),
        F.count_if(~F.coalesce(F.col("user").rlike(r"^user_\d{3,}$"), F.lit(False))).alias(
            "bad_pseudonym"
        ),
        F.lit(raw_ids).cast("bigint").alias("raw_id_columns"),
    )


def label_checks(labelled: DataFrame, label: str = "toxic") -> DataFrame:
    """One row: labelled rows and how many labels are neither 0 nor 1."""
    valid = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    return labelled.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~valid).alias("bad_label")
    )
