"""Sums of arrays over all rows of a key."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def array_sums(partial: DataFrame, key: str, column: str, most_keys: int) -> dict:
    """Element-wise sum of an array column per key, on the driver.

    The elements are added up by Spark, so what arrives is one array per key. More than
    ``most_keys`` keys raise an error: the column is then not one of a few classes.
    """
    cells = partial.select(key, F.posexplode(column).alias("place", "value"))
    summed = cells.groupBy(key, "place").agg(F.sum("value").alias("value"))
    keys = summed.select(key).distinct().limit(most_keys + 1).count()
    if keys > most_keys:
        raise ValueError(f"{key} has more than {most_keys} values")
    found: dict = {}
    for row in summed.collect():
        found.setdefault(row[key], {})[row["place"]] = row["value"]
    return {
        name: np.array([cells[i] for i in range(len(cells))]) for name, cells in sorted(found.items())
    }
