"""Frames whose columns may have any names, those of an operator's own columns among them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def numbered(df: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """``df`` with its columns named ``_0``, ``_1`` and so on, and the new name of a column.

    Names are compared as Spark does, without case. Give the old ones back by position
    (``toDF(*df.columns)``).
    """
    places = {name.lower(): f"_{i}" for i, name in reversed(list(enumerate(df.columns)))}
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]), lambda name: places[name.lower()]
