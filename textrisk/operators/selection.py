"""Exact k-th smallest keys, found by counting: the base of all sampling operators.

A draw orders rows by a seeded hash key (``order_key``) and takes the first k. Sorting
100 TB for that, or sending k rows of every partition to one task, does not scale.
Instead the key range is narrowed down: count rows per slice of the range, keep the
slice that holds the k-th row, slice it again. Each pass moves a few thousand counters.
The result is one key per request, and the draw itself becomes a plain filter
``key <= cut`` inside the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes that a draw tells apart, at most; a pass brings back 4096 counters for each.
MOST_STRATA = 100
KEY_BITS = 60
_SLICE_BITS = 12
_SLICES = 1 << _SLICE_BITS


@dataclass(frozen=True)
class Cut:
    """The ``rank``-th smallest key. ``below`` rows are smaller, ``ties`` rows equal it."""

    rank: int
    key: int
    below: int
    ties: int

    @property
    def inside(self) -> int:
        return self.below + self.ties


@dataclass(frozen=True)
class StratumCuts:
    rows: int
    cuts: tuple[Cut, ...]


@dataclass
class _Search:
    """A request on its way down: ``left`` is the rank among the rows that match ``head``."""

    stratum: object
    rank: int
    left: int
    head: int = 0
    below: int = 0
    found: int = 0


def stratum_sizes(df: DataFrame, by: str) -> dict[object, int]:
    """Rows per stratum; fails when ``by`` has more than ``MOST_STRATA`` values."""
    sizes = df.groupBy(F.col(by).alias("stratum")).count().limit(MOST_STRATA + 1).collect()
    if len(sizes) > MOST_STRATA:
        raise ValueError(f"{by} has more than {MOST_STRATA} values: not a class column")
    return {row["stratum"]: row["count"] for row in sizes}


def find_cuts(
    df: DataFrame,
    key: str,
    ranks: Callable[[int], Sequence[int]] | Mapping[object, Sequence[int]],
    by: str | None = None,
) -> dict[object, StratumCuts]:
    """Cuts per stratum; ``ranks`` gives the ranks (from 1) by stratum, or from the stratum's
    row count.

    Runs a few counting jobs (two on small data, at most ``KEY_BITS / 12``) over the two
    columns used; stage the frame first if these are costly to compute. Ranks outside
    1..rows are skipped. Fails when there are more than ``MOST_STRATA`` strata.
    """
    if by is not None and not isinstance(ranks, Mapping):
        stratum_sizes(df, by)  # a mapping was made from counted classes
    stratum = F.lit(0) if by is None else F.col(by)
    keyed = df.select(stratum.alias("stratum"), F.col(key).alias("key"))
    shift = KEY_BITS - _SLICE_BITS
    counts = _slice_counts(keyed, shift, KEY_BITS, None)
    sizes: dict = {}
    for (s, _), per_slice in counts.items():
        sizes[s] = sum(per_slice.values())
    searches = [
        _Search(s, rank, rank)
        for s, rows in sizes.items()
        for rank in sorted(set(ranks.get(s, ()) if isinstance(ranks, Mapping) else ranks(rows)))
        if 1 <= rank <= rows
    ]
    while searches:
        for search in searches:
            _descend(search, counts[(search.stratum, search.head)])
        if shift == 0:
            break
        heads = {(x.stratum, x.head): x.found for x in searches}
        width, shift = shift, shift - _SLICE_BITS
        if max(heads.values()) <= _SLICES:  # few rows left per head: count single keys
            shift = 0
        counts = _slice_counts(keyed, shift, width, heads)
    return {
        s: StratumCuts(
            rows,
            tuple(Cut(x.rank, x.head, x.below, x.found) for x in searches if x.stratum == s),
        )
        for s, rows in sizes.items()
    }


def _slice_counts(keyed: DataFrame, shift: int, width: int, heads: dict | None) -> dict:
    """Rows per slice of ``2**shift`` keys, by stratum and head (``2**width`` keys).

    At most 4096 counters per head come back.
    """
    if heads is not None:
        wanted = F.lit(False)
        for stratum, head in sorted(heads, key=str):
            wanted = wanted | (
                F.col("stratum").eqNullSafe(F.lit(stratum))
                & F.col("key").between(head << width, ((head + 1) << width) - 1)
            )
        keyed = keyed.where(wanted)
    counted = keyed.groupBy("stratum", F.shiftright("key", shift).alias("slice")).count()
    result: dict = {}
    for row in counted.collect():
        head = row["slice"] >> (width - shift)
        result.setdefault((row["stratum"], head), {})[row["slice"]] = row["count"]
    return result


def _descend(search: _Search, per_slice: dict[int, int]) -> None:
    for piece in sorted(per_slice):
        count = per_slice[piece]
        if search.left <= count:
            search.head, search.found = piece, count
            return
        search.left -= count
        search.below += count


def keep_first(key: str, cut: Cut | None, rows_wanted: int, total_rows: int) -> Column | None:
    """Condition that holds for the first ``rows_wanted`` rows by key.

    None when the cut falls between rows of equal key, so that no condition can tell.
    """
    if rows_wanted >= total_rows:
        return F.lit(True)
    if rows_wanted <= 0 or cut is None:
        return F.lit(False)
    return F.col(key) <= cut.key if cut.inside == rows_wanted else None


def take_first(
    df: DataFrame, key: str, cut: Cut | None, rows_wanted: int, total_rows: int
) -> DataFrame:
    """Exactly the first ``rows_wanted`` rows by key, given the cut found for that rank.

    Rows that share the cut's key are copies of each other; when only some of them fit,
    ``limit`` takes that many.
    """
    condition = keep_first(key, cut, rows_wanted, total_rows)
    if condition is not None:
        return df.where(condition)
    return df.where(F.col(key) < cut.key).unionByName(
        df.where(F.col(key) == cut.key).limit(rows_wanted - cut.below)
    )


def position(key: str, strata: dict[object, StratumCuts], by: str | None = None) -> Column:
    """How many of its stratum's cuts lie below a row's key: 0 is the first piece."""

    def passed(cuts: Sequence[Cut]) -> Column:
        return sum((F.when(F.col(key) > c.key, 1).otherwise(0) for c in cuts), F.lit(0))

    if by is None:
        return passed(next(iter(strata.values())).cuts if strata else ())
    result = F.lit(None).cast("int")
    for stratum, found in strata.items():
        result = F.when(F.col(by).eqNullSafe(F.lit(stratum)), passed(found.cuts)).otherwise(result)
    return result
