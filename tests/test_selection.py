"""Draws, splits, orders and quantiles against brute force, also on hot and repeated keys."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textrisk.functions.text import order_key
from textrisk.operators import sampling
from textrisk.operators.lookups import exclude_keys, join_lookup
from textrisk.operators.messages import pseudonymize, pseudonyms
from textrisk.operators.ordering import number_rows, running_totals
from textrisk.operators.quantiles import exact_quantiles, quantile
from textrisk.operators.selection import find_cuts, position, take_first


def key_of(seed, *parts):
    return int(hashlib.md5("|".join([str(seed), *map(str, parts)]).encode()).hexdigest()[:15], 16)


def test_order_key_is_a_prefix_of_md5(spark):
    frame = spark.range(20).select("id", order_key(7, "id").alias("k"))
    assert all(r.k == key_of(7, r.id) and 0 <= r.k < 2**60 for r in frame.collect())


def test_find_cuts_by_stratum(spark):
    source = random.Random(5)
    rows = [(source.choice("ab"), source.randrange(2**60)) for _ in range(5000)]
    rows += [("c", 9)] * 40 + [("c", 2**59)]
    frame = spark.createDataFrame(rows, "s string, k bigint").repartition(5)
    found = find_cuts(frame, "k", lambda n: [1, n // 3, n, n + 1, 0], "s")
    for stratum in "abc":
        keys = sorted(k for s, k in rows if s == stratum)
        cuts = found[stratum].cuts
        assert found[stratum].rows == len(keys)
        assert [c.rank for c in cuts] == sorted({1, len(keys) // 3, len(keys)})
        for cut in cuts:
            assert cut.key == keys[cut.rank - 1]
            assert cut.below == sum(k < cut.key for k in keys)
            assert cut.ties == keys.count(cut.key)
    assert find_cuts(frame.where("false"), "k", lambda n: [1]) == {}


def test_take_first_between_copies(spark):
    frame = spark.createDataFrame([(1,)] * 3 + [(5,)] * 10 + [(9,)] * 4, "k bigint").repartition(4)
    found = find_cuts(frame, "k", lambda n: [7])[0]
    taken = take_first(frame, "k", found.cuts[0], 7, found.rows)
    assert sorted(r.k for r in taken.collect()) == [1] * 3 + [5] * 4


def test_cap_rows_same_rows_under_any_partitioning(spark):
    frame = spark.range(3000)
    expected = sorted(range(3000), key=lambda i: key_of(42, i))[:100]
    for parts in (1, 4, 16):
        got = sampling.cap_rows(frame.repartition(parts), 100, ["id"], 42)
        assert sorted(r.id for r in got.collect()) == sorted(expected)
    assert sampling.cap_rows(frame, None, ["id"]).count() == 3000
    assert sampling.cap_rows(frame, 5000, ["id"]).count() == 3000


def message_rows(count, risky):
    return [(f"h{i}", 1.0 if i < risky else 0.0) for i in range(count)]


@pytest.mark.parametrize(
    "count, risky, size, expected",
    [(1000, 400, 100, (50, 50)), (1000, 10, 100, (10, 90)), (60, 50, 100, (50, 10)),
     (1000, 1000, 101, (50, 51)), (10, 0, 6, (0, 6)), (5, 5, 1, (0, 1))],
)
def test_labeling_sample_quotas(spark, count, risky, size, expected):
    frame = spark.createDataFrame(message_rows(count, risky), "message_hash string, risk_score double")
    sample = sampling.labeling_sample(frame.repartition(3), size, 42).collect()
    reasons = Counter(r.selection_reason for r in sample)
    assert (reasons["risk_candidate"], reasons["random"]) == expected
    assert sorted(r.label_id for r in sample) == list(range(1, len(sample) + 1))
    assert len({r.message_hash for r in sample}) == len(sample)
    assert all(r.toxic is None and r.notes is None for r in sample)


def test_labeling_sample_with_copies(spark):
    rows = [("same", 1.0)] * 300 + message_rows(600, 0)
    frame = spark.createDataFrame(rows, "message_hash string, risk_score double").repartition(6)
    sample = sampling.labeling_sample(frame, 100, 42).collect()
    reasons = Counter(r.selection_reason for r in sample)
    assert reasons == {"risk_candidate": 50, "random": 50}
    # copies of a chosen hash leave the pool
    assert all(r.message_hash != "same" for r in sample if r.selection_reason == "random")


def test_splits_folds_and_prefixes(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(500)]
    sizes = Counter(y for _, y in rows)
    frame = spark.createDataFrame(rows, "id int, y int")
    split = sampling.holdout_split(frame, "y", ["id"], 0.2).collect()
    for y, n in sizes.items():
        assert sum(r.is_test for r in split if r.y == y) == math.floor(0.2 * n + 0.5)
    outcome = {}
    for parts in (1, 16):
        folded = sampling.assign_folds(frame.repartition(parts), "y", ["id"], 5).collect()
        outcome[parts] = {r.id: r.fold for r in folded}
    assert outcome[1] == outcome[16]
    for y, n in sizes.items():
        per_fold = Counter(outcome[1][i] for i, label in rows if label == y)
        assert sorted(per_fold) == [0, 1, 2, 3, 4]
        assert max(per_fold.values()) - min(per_fold.values()) <= 1
    prefixed = sampling.learning_prefixes(frame, "y", ["id"], [0.5, 0.1, 1.0]).collect()
    for y, n in sizes.items():
        upto = Counter(r.prefix for r in prefixed if r.y == y)
        assert upto[1] == math.floor(0.1 * n + 0.5)
        assert upto[1] + upto[2] == math.floor(0.5 * n + 0.5) and sum(upto.values()) == n
    drawn = sampling.stratified_subsample(frame, "y", ["id"], 100).collect()
    assert len(drawn) == 100
    assert sampling.stratified_subsample(frame, "y", ["id"], 500).count() == 500


@pytest.mark.parametrize("size, ones, wanted", [(100, 25, 10), (10, 5, 5), (9, 3, 4), (7, 1, 0)])
def test_subsample_and_holdout_are_exact(spark, size, ones, wanted):
    frame = spark.createDataFrame([(i, int(i < ones)) for i in range(size)], "id int, y int")
    drawn = Counter(r.y for r in sampling.stratified_subsample(frame, "y", ["id"], wanted).collect())
    assert sum(drawn.values()) == wanted
    assert abs(drawn[1] - wanted * ones / size) < 1
    split = sampling.holdout_split(frame, "y", ["id"], 0.5)
    assert split.where("is_test").count() == (size + 1) // 2


def test_class_quotas():
    assert sampling.class_quotas({0: 75, 1: 25}, 10) == {0: 8, 1: 2}  # 7.5 and 2.5
    assert sampling.class_quotas({1: 50, 0: 50}, 5) == {0: 3, 1: 2}
    assert sampling.class_quotas({None: 1, "a": 1, "b": 1}, 1) == {None: 1, "a": 0, "b": 0}


def test_too_many_classes_fail(spark):
    frame = spark.range(500).withColumn("y", F.col("id"))
    with pytest.raises(ValueError, match="not a class column"):
        sampling.assign_folds(frame, "y", ["id"])


def test_position_without_strata(spark):
    frame = spark.createDataFrame([(i,) for i in range(100)], "k bigint")
    found = find_cuts(frame, "k", lambda n: [10, 60])
    pieces = Counter(r[0] for r in frame.select(position("k", found)).collect())
    assert pieces == {0: 10, 1: 50, 2: 40}


def test_running_totals_and_numbers(spark):
    source = random.Random(3)
    rows = [(i, source.randrange(100)) for i in source.sample(range(10**6), 2000)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(7)
    got = running_totals(frame, [F.desc("k")], {"upto": F.col("v")}).collect()
    total, expected = 0, {}
    for k, v in sorted(rows, reverse=True):
        total += v
        expected[k] = total
    assert {r.k: r.upto for r in got} == expected
    numbered = number_rows(frame, [F.col("k")], "n").collect()
    assert [r.k for r in sorted(numbered, key=lambda r: r.n)] == sorted(k for k, _ in rows)
    assert sorted(r.n for r in numbered) == list(range(1, 2001))


def test_exact_quantiles_equal_numpy(spark):
    source = np.random.default_rng(4)
    groups = {
        "mostly zero": np.where(source.random(3000) < 0.7, 0.0, source.exponential(1, 3000)),
        "signed": source.normal(0, 1e6, 501),
        "one": np.array([3.5]),
        "two": np.array([-1.0, 2.0]),
        "close": 1 + source.random(400) * 1e-9,
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("one", None), ("signed", float("nan"))]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(6)
    levels = [0.0, 0.01, 0.25, 0.5, 0.8, 0.999, 1.0]
    got = exact_quantiles(frame, "v", levels, ["g"]).collect()
    assert len(got) == len(groups) * len(levels)
    for row in got:
        assert row["rows"] == len(groups[row.g])
        assert row["quantile"] == pytest.approx(np.quantile(groups[row.g], row.probability), rel=1e-12)
    assert quantile(frame.where("false"), "v", 0.5).first()[0] is None


def skewed_rows(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"u{i:04}", i) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "raw_user_id string, n int").repartition(8)


def test_pseudonyms_sorted_and_complete(spark):
    rows, frame = skewed_rows(spark)
    expected = {u: f"user_{i:03d}" for i, u in enumerate(sorted({u for u, _ in rows}), 1)}
    names = pseudonyms(frame).collect()
    assert {r.raw_user_id: r.user for r in names} == expected
    assert {r.raw_user_id: r.user_rows for r in names} == Counter(u for u, _ in rows)
    for limit in (100_000, 10):  # broadcast, then the sliced join
        got = pseudonymize(frame, broadcast_rows=limit).collect()
        assert Counter((r.user, r.n) for r in got) == Counter((expected[u], n) for u, n in rows)


def test_sliced_join_spreads_a_hot_key(spark):
    _, frame = skewed_rows(spark)
    names = pseudonyms(frame)
    joined = join_lookup(frame, names, "raw_user_id", "user_rows", broadcast_rows=10)
    plan = joined._jdf.queryExecution().toString()
    assert "_slice" in plan
    assert joined.count() == 7000


def test_exclude_keys_removes_all_copies(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    chosen = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [tuple(r) for r in exclude_keys(frame, chosen, "k").collect()] == [("b", 3)]
