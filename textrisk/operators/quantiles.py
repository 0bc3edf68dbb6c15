"""Exact quantiles with linear interpolation, by narrowing down ranges of values.

Rows are counted per cell of the value range, and the counters tell which cell holds a wanted rank.
That cell, from its smallest to its largest value, is cut into slices and counted again, until the
range holds one value, or so few rows that a task may put them in order. Only counters are
shuffled, however many rows or values share a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.operators.lookups import BROADCAST_ROWS
from textrisk.session import staged

# Slices of a range in one pass, and rows of a range that are put in order, at most.
_SLICES = 4096
_FEW_ROWS = 100_000

# --- fixed values: width of a value cell (128 cells per doubling above one millionth) --
_CELLS_PER_DOUBLING = 128
_SMALLEST = 1e6


def value_cell(value: Column) -> Column:
    """Order-keeping cell number of a double; a few thousand cells cover real data."""
    size = F.floor(F.log2(F.abs(value) * F.lit(_SMALLEST) + 1) * _CELLS_PER_DOUBLING)
    return F.when(value < 0, -size).otherwise(size)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    few_groups: bool = False,
    few_rows: int = _FEW_ROWS,
) -> DataFrame:
    """One row per group and probability: ``quantile`` and the group's row count ``rows``.

    Nulls and NaN count as no rows. The values are staged, as several passes read them.
    ``few_groups`` promises a small number of groups, so that the list of wanted ranges (two
    per group and probability) may be broadcast; otherwise it is up to a counted size.
    """
    by = list(by)
    number = F.col(value).cast("double")
    values = staged(df.select(*by, number.alias("_value")))
    values = values.where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    counters = (
        F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    cells = values.groupBy(*by, value_cell(F.col("_value")).alias("_cell")).agg(*counters)
    whole, upto = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("_cell")
    spots = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    placed = cells.withColumns({"_rows": F.sum("_n").over(whole), "_upto": F.sum("_n").over(upto)})
    spot = (F.col("_rows") - 1) * F.col("probability")
    ends = F.explode(F.array(F.floor(spot), F.ceil(spot)))
    wanted = placed.select("*", spots).withColumn("_spot", spot).select("*", ends.alias("_rank")).distinct()
    open_ = staged(_holding(wanted).select(*by, "probability", "_spot", "_rows", "_rank", "_before", *_RANGE))
    found = _one_value(open_)
    while True:
        open_ = open_.where("_low < _high")
        largest = open_.agg(F.max("_n")).first()[0]
        if largest is None:
            break
        ranges = open_.select(*by, "_low", "_high").distinct()
        small = few_groups or not by or ranges.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        at = [F.col(name).alias(f"_at_{name}") for name in [*by, "_low", "_high"]]
        targets = ranges.select(*at)
        targets = F.broadcast(targets) if small else targets
        same = F.col("_value").between(F.col("_at__low"), F.col("_at__high"))
        for name in by:
            same = same & F.col(name).eqNullSafe(F.col(f"_at_{name}"))
        keys = [*by, "_at__low", "_at__high"]
        inside = values.join(targets, same)
        if largest <= few_rows:
            order = Window.partitionBy(*keys).orderBy("_value")
            slices = inside.select(
                *keys, F.lit(1).alias("_n"), F.col("_value").alias("_low"), F.col("_value").alias("_high"),
                F.row_number().over(order).alias("_upto"),
            )
        else:
            share = (F.col("_value") - F.col("_at__low")) / (F.col("_at__high") - F.col("_at__low"))
            piece = F.least(F.floor(share * _SLICES), F.lit(_SLICES - 1))
            slices = inside.groupBy(*keys, piece.alias("_piece")).agg(*counters)
            slices = slices.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_piece")))
        wider = open_.select(*at, "probability", "_spot", "_rows", "_rank", F.col("_before").alias("_start"))
        match = F.lit(True)
        for name in keys:
            match = match & slices[name].eqNullSafe(wider[name if name.startswith("_at_") else f"_at_{name}"])
        joined = slices.join(wider, match).select(
            *[slices[name] for name in [*by, "_n", "_low", "_high"]],
            (F.col("_upto") + F.col("_start")).alias("_upto"), "probability", "_spot", "_rows", "_rank",
        )
        open_ = staged(
            _holding(joined).select(*by, "probability", "_spot", "_rows", "_rank", "_before", *_RANGE)
        )
        found = found.unionByName(_one_value(open_))
    low = F.min(F.struct("_rank", "_low"))["_low"]
    high = F.max(F.struct("_rank", "_low"))["_low"]
    share = F.first("_spot") - F.floor(F.first("_spot"))
    return found.groupBy(*by, "probability").agg(
        (low + (high - low) * share).alias("quantile"), F.first("_rows").alias("rows")
    )


_RANGE = ("_n", "_low", "_high")


def _holding(ranges: DataFrame) -> DataFrame:
    """The ranges that hold their 0-based ``_rank``, and how many rows are ``_before`` them."""
    return ranges.withColumn("_before", F.col("_upto") - F.col("_n")).where(
        (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))
    )


def _one_value(ranges: DataFrame) -> DataFrame:
    return ranges.where("_low = _high").drop("_n", "_high", "_before")


def quantile(df: DataFrame, value: str, probability: float) -> DataFrame:
    """One row, one column ``quantile``; null when there are no values."""
    return exact_quantiles(df, value, [probability]).agg(F.max("quantile").alias("quantile"))
