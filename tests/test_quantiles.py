"""Exact quantiles against NumPy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textrisk.operators.quantiles import exact_quantiles, quantile

SHARES = [0.0, 0.05, 0.25, 0.5, 0.8, 0.99, 1.0]


def case(seed):
    rng = random.Random(seed)
    groups = {
        "ties": [rng.choice([0.0, -0.0, 1.0, 7.5]) for _ in range(400)],
        "narrow": [1.0 + rng.random() * 1e-9 for _ in range(900)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-250, 250) for _ in range(300)],
        "tiny": [2.0**-k for k in range(40, 250, 3)],
        "one": [3.25],
        "two": [-5.0, 6.0],
        None: [rng.gauss(0, 100) for _ in range(250)],
    }
    rows = [(name, value) for name, values in groups.items() for value in values]
    return groups, rows + [("ties", None), ("one", float("nan")), ("nothing", None), ("nothing", float("nan"))]


@pytest.mark.parametrize("few_rows, few_groups", [(100_000, False), (5, True), (1, False)])
def test_quantiles_equal_sorting(spark, few_rows, few_groups):
    groups, rows = case(few_rows)
    frame = spark.createDataFrame(rows, "name string, value double").repartition(5)
    found = exact_quantiles(frame, "value", SHARES, ["name"], few_groups, few_rows).collect()
    assert len(found) == len(groups) * len(SHARES)
    for row in found:
        values = groups[row.name]
        assert row.rows == len(values)
        assert row.quantile == pytest.approx(float(np.quantile(values, row.probability)), rel=1e-9, abs=1e-300)


def test_no_window_and_no_shuffle_over_values(spark):
    """Rows of a range are counted, not moved, while there are more than a task may order."""
    frame = spark.range(200_000).select((F.lit(5.0) + F.rand(3) * 1e-7).alias("value"))
    expected = np.quantile([r[0] for r in frame.collect()], 0.3)
    assert quantile(frame, "value", 0.3).first()[0] == pytest.approx(expected, rel=1e-12)
    found = exact_quantiles(frame, "value", [0.3], few_rows=0).first()
    assert found.quantile == pytest.approx(expected, rel=1e-12) and found.rows == 200_000


def test_empty(spark):
    nothing = spark.createDataFrame([], "value double")
    assert quantile(nothing, "value", 0.5).first()[0] is None
    assert exact_quantiles(nothing, "value", [0.5]).count() == 0
