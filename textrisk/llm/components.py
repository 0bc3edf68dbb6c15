"""Connected components of a link table, by rounds of random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrisk.session import staged


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """One row per linked ``id`` with the ``label`` of its component (one of its ids).

    In each round every id hops to the neighbour that comes first in an order drawn anew,
    or stays; links are then drawn between the ids hopped to. A round leaves a share of
    the ids of each component, so the rounds grow with the logarithm of the input. Links
    shrink from round to round, and each round is staged.
    """
    edges = staged(
        links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    )
    labels = None
    turn = 0
    while not edges.isEmpty():
        turn += 1

        def rank(column: str):
            return F.xxhash64(F.lit(turn), F.col(column))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min_by("b", rank("b")).alias("b"))
        hops = staged(
            nearest.select(
                F.col("a").alias("id"),
                F.when(rank("b") < rank("a"), F.col("b")).otherwise(F.col("a")).alias("hop"),
            )
        )
        if labels is None:
            labels = hops.withColumnRenamed("hop", "label")
        else:
            moved = hops.select(F.col("id").alias("label"), "hop")
            labels = staged(
                labels.join(moved, "label", "left").select(
                    "id", F.coalesce("hop", "label").alias("label")
                )
            )
        left_hops = hops.select(F.col("id").alias("a"), F.col("hop").alias("x"))
        right_hops = hops.select(F.col("id").alias("b"), F.col("hop").alias("y"))
        edges = staged(
            edges.join(left_hops, "a")
            .join(right_hops, "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .where("a <> b")
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labels
