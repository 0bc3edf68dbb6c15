"""Row caps, labelling samples, splits and folds.

All of them draw by ``order_key``: the same rows come out under any partitioning, and
what is drawn is decided by a filter on the key, not by a sort of the data. The cut of
that filter is found by a few counting passes over the key, so stage a costly frame
(``session.staged``) before drawing from it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.functions.text import order_key
from textrisk.operators.selection import (
    StratumCuts,
    find_cuts,
    keep_first,
    position,
    stratum_sizes,
    take_first,
)

_KEY = "_order_key"


def cap_rows(
    df: DataFrame, rows: int | None, id_columns: Sequence[str], seed: int = fixed.DEFAULT_SEED
) -> DataFrame:
    """A uniform draw of exactly ``rows`` rows; everything when there are no more."""
    if rows is None:
        return df
    keyed = df.withColumn(_KEY, order_key(seed, *id_columns))
    found = find_cuts(keyed, _KEY, lambda n: [rows]).get(0, StratumCuts(0, ()))
    cut = found.cuts[0] if found.cuts else None
    return take_first(keyed, _KEY, cut, rows, found.rows).drop(_KEY)


def labeling_sample(
    df: DataFrame,
    size: int = fixed.DEFAULT_SAMPLE_SIZE,
    seed: int = fixed.DEFAULT_SEED,
    candidate: Column | None = None,
    key: str = "message_hash",
) -> DataFrame:
    """Up to ``size`` rows, at most half of them risk candidates, the rest at random.

    ``candidate`` defaults to ``risk_score > 0``. The random part is drawn from all rows
    but the chosen candidates, unchosen candidates included. Copies of one key share
    their place in the order, so all copies of a chosen key leave the pool.
    """
    candidate = F.col("risk_score") > 0 if candidate is None else candidate
    risky = F.coalesce(candidate, F.lit(False))
    keyed = df.withColumns(
        {
            "_risky": risky,
            "_risky_key": order_key(f"{seed}:risky", key),
            "_random_key": order_key(f"{seed}:random", key),
        }
    )
    quota = size // 2
    risky_found = find_cuts(keyed.where("_risky"), "_risky_key", lambda n: [quota])
    risky_rows = risky_found.get(0, StratumCuts(0, ()))
    risky_cut = risky_rows.cuts[0] if risky_rows.cuts else None
    if quota >= risky_rows.rows:
        chosen = F.col("_risky")
    elif risky_cut is None:
        chosen = F.lit(False)
    else:
        chosen = F.col("_risky") & (F.col("_risky_key") <= risky_cut.key)
    room = size - min(quota, risky_rows.rows)
    pool = find_cuts(keyed.where(~chosen), "_random_key", lambda n: [room])
    pool_rows = pool.get(0, StratumCuts(0, ()))
    pool_cut = pool_rows.cuts[0] if pool_rows.cuts else None
    drawn = _draw_both(
        keyed.withColumn("_chosen", chosen),
        (risky_cut, quota, risky_rows.rows),
        (pool_cut, room, pool_rows.rows),
    ).drop("_risky", "_risky_key", "_random_key", "_chosen")
    return number_shuffled(drawn, seed, [key, "selection_reason"]).withColumns(
        {"toxic": F.lit(None).cast("string"), "notes": F.lit(None).cast("string")}
    )


def _draw_both(keyed: DataFrame, risky: tuple, pool: tuple) -> DataFrame:
    """Both parts of the sample: one filter over one scan, unless a cut falls between copies."""
    reason = "selection_reason"
    in_risky, in_pool = keep_first("_risky_key", *risky), keep_first("_random_key", *pool)
    if in_risky is not None and in_pool is not None:
        tagged = keyed.withColumn(
            reason,
            F.when(F.col("_risky") & in_risky, fixed.RISKY_REASON).when(
                ~F.col("_chosen") & in_pool, fixed.RANDOM_REASON
            ),
        )
        return tagged.where(F.col(reason).isNotNull())
    risky_part = take_first(keyed.where("_risky"), "_risky_key", *risky)
    random_part = take_first(keyed.where(~F.col("_chosen")), "_random_key", *pool)
    return risky_part.withColumn(reason, F.lit(fixed.RISKY_REASON)).unionByName(
        random_part.withColumn(reason, F.lit(fixed.RANDOM_REASON))
    )


def number_shuffled(
    df: DataFrame, seed: int, id_columns: Sequence[str], name: str = "label_id"
) -> DataFrame:
    """Number the rows of a drawn sample from 1 in seeded random order.

    The keys are spread evenly, so their leading bits cut the order into even slices:
    rows are numbered inside a slice and start after the rows of the slices before it.
    """
    keyed = df.withColumn(_KEY, order_key(f"{seed}:shuffle", *id_columns)).withColumn(
        "_slice", F.shiftright(_KEY, 48)
    )
    per_slice = keyed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_slice").orderBy(_KEY, *id_columns)
    return (
        keyed.join(F.broadcast(starts), "_slice")  # at most 4096 slices
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop("_slice", "_start", _KEY)
    )


def _rounded(value: float) -> int:
    return math.floor(value + 0.5)


def class_quotas(sizes: Mapping[object, int], wanted: int) -> dict[object, int]:
    """``wanted`` rows dealt to the classes by their shares, exactly: each gets the whole part
    of its share, the rows left over go to the largest remainders (equal ones: smaller label)."""
    total = sum(sizes.values())
    quotas = {label: wanted * rows // total for label, rows in sizes.items()}
    rest = sorted(
        sizes, key=lambda label: (-(wanted * sizes[label] % total), label is not None, label)
    )
    for label in rest[: wanted - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def _mark_first(
    df: DataFrame, label: str, id_columns: Sequence[str], quotas: Mapping, seed: str, name: str
) -> DataFrame:
    """Mark the first rows of each class in seeded order, as many as its quota."""
    keyed = df.withColumn(_KEY, order_key(seed, *id_columns))
    cuts = find_cuts(keyed, _KEY, {stratum: [rows] for stratum, rows in quotas.items()}, label)
    marked = F.lit(False)
    for stratum, found in cuts.items():
        if found.cuts:
            marked = marked | (
                F.col(label).eqNullSafe(F.lit(stratum)) & (F.col(_KEY) <= found.cuts[0].key)
            )
    return keyed.withColumn(name, marked).drop(_KEY)


def holdout_split(
    df: DataFrame,
    label: str,
    id_columns: Sequence[str],
    share: float = 0.2,
    seed: int = fixed.DEFAULT_SEED,
    name: str = "is_test",
) -> DataFrame:
    """Mark ``round(share * n)`` rows as test rows, with the class shares kept."""
    sizes = stratum_sizes(df, label)
    quotas = class_quotas(sizes, _rounded(share * sum(sizes.values()))) if sizes else {}
    return _mark_first(df, label, id_columns, quotas, f"{seed}:holdout", name)


def stratified_subsample(
    df: DataFrame,
    label: str,
    id_columns: Sequence[str],
    size: int,
    seed: int = fixed.DEFAULT_SEED,
) -> DataFrame:
    """``size`` rows with the class shares kept; everything when there are no more."""
    sizes = stratum_sizes(df, label)
    if size >= sum(sizes.values()):
        return df
    quotas = class_quotas(sizes, size)
    drawn = _mark_first(df, label, id_columns, quotas, f"{seed}:subsample", "_drawn")
    return drawn.where("_drawn").drop("_drawn")


def assign_folds(
    df: DataFrame,
    label: str,
    id_columns: Sequence[str],
    folds: int = 5,
    seed: int = fixed.DEFAULT_SEED,
    name: str = "fold",
) -> DataFrame:
    """Stratified folds 0..folds-1: the shuffled rows of a class, cut into even pieces."""
    keyed = df.withColumn(_KEY, order_key(f"{seed}:folds", *id_columns))

    def piece_ends(rows: int) -> list[int]:
        small, extra = divmod(rows, folds)
        return [small * i + min(i, extra) for i in range(1, folds)]

    cuts = find_cuts(keyed, _KEY, piece_ends, label)
    return keyed.withColumn(name, position(_KEY, cuts, label)).drop(_KEY)


def learning_prefixes(
    df: DataFrame,
    label: str,
    id_columns: Sequence[str],
    fractions: Sequence[float],
    seed: int = fixed.DEFAULT_SEED,
    name: str = "prefix",
) -> DataFrame:
    """Number (from 1) of the smallest fraction each row belongs to.

    Prefixes are nested: the training rows of the k-th fraction are ``prefix <= k``. Rows
    beyond the last fraction get ``len(fractions) + 1``.
    """
    keyed = df.withColumn(_KEY, order_key(f"{seed}:prefix", *id_columns))
    ordered = sorted(fractions)
    cuts = find_cuts(
        keyed, _KEY, lambda n: [max(1, _rounded(f * n)) for f in ordered], label
    )
    return keyed.withColumn(name, position(_KEY, cuts, label) + 1).drop(_KEY)
