"""Running totals and row numbers over a global order, without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.session import staged

_PART = "_range_part"


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Add, per row, the sum of each ``totals`` column over all rows up to and with it.

    The rows are split into sorted ranges of about equal size and staged, so the ranges
    stay fixed. Each range is summed on its own and starts from the sum of the
    ranges before it: that table holds one row per range and is broadcast. ``order_by``
    must order the rows totally.
    """
    ranged = staged(df.repartitionByRange(*order_by).withColumn(_PART, F.spark_partition_id()))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    per_part = ranged.groupBy(_PART).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    starts = per_part.select(
        _PART,
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_start_{name}")
            for name in totals
        ],
    )
    upto = (
        Window.partitionBy(_PART)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(F.broadcast(starts), _PART).select(
        *df.columns,
        *[(F.sum(c).over(upto) + F.col(f"_start_{n}")).alias(n) for n, c in totals.items()],
    )


def number_rows(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Number the rows from 1 in a total order."""
    numbered = running_totals(df, order_by, {name: F.lit(1)})
    return numbered.withColumn(name, F.col(name).cast("bigint"))


def top_rows(df: DataFrame, order_by: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows of a report; for draws of many rows see ``selection``."""
    return df.orderBy(*order_by).limit(count)
