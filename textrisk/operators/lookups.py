"""Joins against lookup tables when a few keys may own a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
# A key with more than 1/HOT_KEYS of all rows is hot, so there are fewer than HOT_KEYS of them.
HOT_KEYS = 1_000

_SLICES = "_slices"
_SLICE = "_slice"


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    key_rows: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with ``lookup`` (one row per ``key``).

    ``lookup[key_rows]`` is the number of rows of each key. A lookup of at most
    ``broadcast_rows`` rows is broadcast. A larger one is shuffled, and the rows of a hot
    key go to many slices: its lookup row is repeated once per slice. ``lookup`` is
    counted here, so pass a staged frame.
    """
    wanted = [c for c in lookup.columns if c != key_rows]
    if lookup.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(lookup.select(*wanted)), key)

    total = lookup.agg(F.sum(key_rows)).first()[0]
    slices = F.ceil(F.col(key_rows) * HOT_KEYS / F.lit(total)).cast("int")
    hot = lookup.where(F.col(key_rows) > total / HOT_KEYS).select(key, slices.alias(_SLICES))
    spread = F.pmod(F.xxhash64(*rows.columns), F.coalesce(_SLICES, F.lit(1))).cast("int")
    sliced_rows = (
        rows.join(F.broadcast(hot), key, "left").withColumn(_SLICE, spread).drop(_SLICES)
    )
    copies = F.when(F.col(key_rows) > total / HOT_KEYS, slices).otherwise(F.lit(1))
    sliced_lookup = lookup.select(
        *wanted, F.explode(F.sequence(F.lit(0), copies - 1)).alias(_SLICE)
    )
    return sliced_rows.join(sliced_lookup, [key, _SLICE]).drop(_SLICE)


def exclude_keys(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``chosen`` (all copies of a chosen key go)."""
    return rows.join(chosen.select(key).distinct(), key, "left_anti")
