"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all alike)
and 1 (as they are), made to sum to 1. The exponent is found by bisection on a fixed grid: the
largest that reaches a target entropy, then raised, if need be, until no source is repeated
more often than allowed. Weights times the token budget give each source's budget. A source is
given out in whole passes, then in a permutation of its documents up to the rest of its
budget. The permutation goes by blocks: documents are dealt into blocks by a seeded hash; whole
blocks are taken as long as their sums fit, and the block that the budget ends in is cut into
blocks again, until the cut is a single key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.llm.columns import numbered
from textrisk.session import staged

#: Steps of the exponent's grid from 0 to 1, and cuts of an interval in one pass.
GRID = 4096
_CUTS = 16
#: Hexadecimal digits of a permutation key that name its block: 4,096 blocks per source.
_BLOCK_DIGITS = 3


def token_count(text: str = "text") -> Column:
    """Words between white space; null has none."""
    words = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class MixTarget:
    """``entropy_share``: least entropy of the weights, as a share of that of equal weights.
    ``repetitions``: most passes over a source. ``budget_share``: tokens to give out, as a
    share of those there are."""

    entropy_share: float = 0.97
    repetitions: float = 4.0
    budget_share: float = 1.0
    seed: int = 42


def _measures(sources: DataFrame, steps: list[int], budget_share: float) -> dict:
    """Entropy and most repetitions of the weights at some steps of the grid."""
    exponent = F.col("step") / F.lit(float(GRID))
    raised = sources.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps])))
    raised = raised.withColumn("power", F.pow("share", exponent))
    sums = raised.groupBy("step").agg(
        F.sum("power").alias("total"),
        F.sum(F.col("power") * F.log2("power")).alias("logs"),
        F.max(F.col("power") / F.col("share")).alias("most"),
    )
    return {
        row.step: (
            _log2(row.total) - row.logs / row.total,
            row.most / row.total * budget_share,
        )
        for row in sums.collect()
    }


def _log2(value: float) -> float:
    import math

    return math.log2(value)


def _bisect(sources: DataFrame, low: int, high: int, budget_share: float, holds) -> int:
    """The largest step from ``low`` on for which ``holds``; it does at ``low``, and beyond
    some step no more."""
    while high - low > 1:
        width = high - low
        steps = sorted({low + width * i // _CUTS for i in range(1, _CUTS)} - {low, high})
        measured = _measures(sources, steps, budget_share)
        for step in steps:
            if holds(*measured[step]):
                low = step
            else:
                high = step
                break
    return low


def source_plan(tokens: DataFrame, target: MixTarget) -> tuple[DataFrame, int]:
    """Per source with tokens its ``tokens``, ``weight``, ``budget``, whole ``passes`` and the
    ``rest`` of the budget; and the step of the grid. ``tokens`` has ``source``, ``tokens``."""
    sums = staged(tokens.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    total, count = sums.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    sources = sums.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    if count < 2:
        step = GRID
    else:
        wanted = target.entropy_share * _log2(count) - 1e-9
        ends = _measures(sources, [0, GRID], target.budget_share)
        step = GRID
        if ends[GRID][0] < wanted:
            step = _bisect(
                sources, 0, GRID, target.budget_share, lambda entropy, _: entropy >= wanted
            )
        # Fewer repetitions as the exponent grows; at 1 there are as many as the budget asks for.
        most = max(target.repetitions, target.budget_share) + 1e-9
        if _measures(sources, [step], target.budget_share)[step][1] > most:
            step = 1 + _bisect(
                sources, step, GRID, target.budget_share, lambda _, repeated: repeated > most
            )
    power = F.pow("share", F.lit(step / GRID))
    plan = sources.withColumn("power", power)
    norm = plan.agg(F.sum("power")).first()[0] or 1.0
    exact = F.col("power") / F.lit(norm) * F.lit(float(total or 0) * target.budget_share)
    # A budget that is a whole number up to rounding is that number.
    budget = F.floor(exact + exact * F.lit(1e-12) + F.lit(1e-9))
    plan = plan.select(
        "source", "tokens", (F.col("power") / F.lit(norm)).alias("weight"), budget.alias("budget")
    )
    passes = F.floor(F.col("budget") / F.col("tokens"))
    return staged(
        plan.withColumn("passes", passes).withColumn(
            "rest", F.col("budget") - F.col("passes") * F.col("tokens")
        )
    ), step


def mix_sources(documents: DataFrame, target: MixTarget = MixTarget()) -> DataFrame:
    """The rows given out, once per pass, with the columns of ``documents`` and ``mix_epoch``
    (0 for the first pass), ``mix_block`` (place in the permutation) and ``mix_tokens``.

    Needs ``doc_id``, ``source``, ``text``; a column of ``documents`` with one of the three new
    names is replaced. Null is a source of its own. A source without tokens gets no weight and
    none of its rows. Rows of one ``doc_id`` in a source stay together in the permutation.
    """
    added = ("mix_epoch", "mix_block", "mix_tokens")
    rows = documents.drop(*added)
    own, place = numbered(rows)
    doc_id, source = place("doc_id"), place("source")
    own = own.withColumn("mix_tokens", token_count(place("text")))
    narrow = staged(own.select(doc_id, source, "mix_tokens"))
    plan, _ = source_plan(narrow.select(F.col(source).alias("source"), F.col("mix_tokens").alias("tokens")), target)
    plan = plan.select(F.col("source").alias("planned"), "passes", "rest")

    def keyed(df: DataFrame) -> DataFrame:
        """With the plan of its source, the permutation key of the last pass and its block."""
        joined = df.join(plan, df[source].eqNullSafe(plan["planned"])).drop("planned")
        name = F.concat_ws(
            ":", F.lit(target.seed), "passes", F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
        )
        keyed_ = joined.withColumn("key", F.md5(name.cast("binary")))
        return keyed_.withColumn("block", F.substring("key", 1, _BLOCK_DIGITS))

    keys = keyed(narrow).select(F.col(source).alias("source"), "rest", "key", "mix_tokens")
    cuts = _cuts(staged(keys)).withColumnRenamed("source", "planned")
    dealt = keyed(own)
    dealt = dealt.join(cuts, dealt[source].eqNullSafe(cuts["planned"]), "left").drop("planned")
    dealt = dealt.withColumn("mix_block", F.conv("block", 16, 10).cast("int"))
    # Keys are hexadecimal and compare like text; a cut is the first key that is not taken.
    last = F.when(F.col("cut").isNull() | (F.col("key") < F.col("cut")), F.array(F.col("passes"))).otherwise(
        F.array().cast("array<bigint>")
    )
    before = F.when(
        F.col("passes") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1)
    ).otherwise(F.array().cast("array<bigint>"))
    taken = dealt.withColumn("mix_epoch", F.explode(F.concat(before, last)))
    columns = [f"_{i}" for i in range(len(rows.columns))]
    return taken.select(*columns, *added).toDF(*rows.columns, *added)


def _cuts(keys: DataFrame) -> DataFrame:
    """Per ``source`` the first ``key`` of the permutation that no more fits into its ``rest``;
    none if all do. ``keys`` has them with ``mix_tokens``, without texts.

    The keys are cut into blocks by their first digits, and the block in which the budget ends
    again by the next ones, until a block is one key: sums of one block per source move, and
    no source or block has to be put in order.
    """
    digits, length = _BLOCK_DIGITS, 32  # of an md5
    taken = F.lit(0).cast("bigint").alias("taken")
    open_ = keys.select("source", "rest", "key", F.col("mix_tokens").alias("tokens"), taken)
    found = None
    while True:
        head = F.substring("key", 1, digits)
        sums = open_.groupBy("source", head.alias("head")).agg(
            F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"), F.first("taken").alias("taken"),
            F.min("key").alias("first"), (F.min("key") == F.max("key")).alias("single"),
        )
        # A few thousand blocks per source.
        upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("head"))
        over = sums.withColumn("upto", upto + F.col("taken")).where("upto > rest")
        end = F.struct("head", "first", "single", (F.col("upto") - F.col("tokens")).alias("before"))
        ends = staged(over.groupBy("source").agg(F.min(end).alias("end")))
        single = ends.where("end.single").select("source", F.col("end.first").alias("cut"))
        found = single if found is None else found.unionByName(single)
        wide = ends.where("not end.single").select(F.col("source").alias("ended"), "end.head", "end.before")
        if digits >= length or wide.isEmpty():
            return found
        inside = open_.join(wide, open_["source"].eqNullSafe(wide["ended"]) & (head == F.col("head")))
        open_ = staged(inside.select("source", "rest", "key", "tokens", F.col("before").alias("taken")))
        digits = min(digits + _BLOCK_DIGITS, length)
