"""Similarity components against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from textrisk.llm.components import connected
from textrisk.llm.ngram_join import (
    PrefixTree,
    Threshold,
    postings,
    set_hash,
    similar_components,
    tree_links,
)

SCHEMA = "doc_id bigint, text string, postings string, set_id string"


def word_sets(text, grams):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return set()
    if len(words) < grams:
        return {tuple(words)}
    return {tuple(words[i : i + grams]) for i in range(len(words) - grams + 1)}


def brute_components(rows, grams, share, whole=100):
    """Component per row, in order of the rows."""
    sets = [word_sets(text, grams) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and whole * common >= share * len(sets[a] | sets[b]):
            if rows[a][0] is not None and rows[b][0] is not None:
                parent[find(a)] = find(b)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        out.append(None if doc_id is None else min(members))
    return list(zip([r[0] for r in rows], [len(s) for s in sets], out))


def varied_rows(seed, count=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for doc_id in range(count):
        kind = rng.random()
        if rows and kind < 0.5:
            source = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 3)):
                source[rng.randrange(len(source))] = rng.choice(words)
            if rng.random() < 0.3:
                source += rng.choices(words, k=rng.randint(1, 4))
            rows.append((doc_id, " ".join(source)))
        else:
            rows.append((doc_id, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 12, 40, 150])))))
    return rows


@pytest.mark.parametrize("seed, grams, share", [(1, 3, 90), (2, 5, 80), (3, 1, 60)])
@pytest.mark.parametrize("block", [500_000, 200])
def test_components_equal_brute_force(spark, seed, grams, share, block):
    rows = varied_rows(seed)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = similar_components(frame, grams, Threshold(share, 100), block_grams=block)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == sorted(brute_components(rows, grams, share))


def test_nulls_empty_repeated_and_extra_columns(spark):
    long = " ".join(f"x{i}" for i in range(20_000))
    rows = [
        (1, None, "p", "s"), (2, "", "p", "s"), (3, " \t\n", "p", "s"), (4, "a B", None, None),
        (5, "A b", None, None), (5, "A b", None, None), (6, "a b c", "p", "s"), (None, "a b c", "p", "s"),
        (8, long, "p", "s"), (7, long + " y", "p", "s"), (9, "a b c", "p", "s"),
        (10, "first text of this id", "p", "s"), (10, "another text of it", "p", "s"),
        (11, "ANOTHER text of it", "p", "s"),
    ]
    found = similar_components(spark.createDataFrame(rows, SCHEMA))
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str
    )
    assert got == sorted(brute_components([r[:2] for r in rows], 3, 90), key=str)


@pytest.mark.parametrize("turned", [False, True])
def test_texts_of_one_id_link_each_for_itself(spark, turned):
    one, other = (" ".join(f"{c}{i}" for i in range(200)) for c in "xy")
    rows = [(10, one, "p", "s"), (10, other, "p", "s"), (11, one + " end", "p", "s"), (12, other + " end", "p", "s"),
            (9, "apart from all of these", "p", "s")]
    rows = rows[::-1] if turned else rows
    found = similar_components(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == sorted(brute_components([r[:2] for r in rows], 3, 90))
    assert [(doc_id, component) for doc_id, _, component in got] == [(9, 9), (10, 10), (10, 10), (11, 10), (12, 10)]


def test_empty_table(spark):
    found = similar_components(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["doc_id", "n_shingles", "set_id", "component_id"] and found.count() == 0


@pytest.mark.parametrize("share", [60, 80, 90])
def test_similar_sets_share_a_posting(share):
    rng = np.random.default_rng(share)
    threshold = Threshold(share, 100)
    firsts = threshold.size_classes(5000)
    for size in [*range(1, 60), 200, 1500]:
        one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        for _ in range(10):
            kept = one[rng.random(len(one)) < rng.uniform(share / 100, 1)]
            added = rng.integers(0, 1 << 63, rng.integers(0, size // 5 + 2), dtype=np.uint64)
            other = np.unique(np.concatenate([kept, added]))
            if not len(other):
                continue
            common = len(np.intersect1d(one, other))
            if threshold.similar(common, len(one), len(other)):
                shares = [np.zeros(0, np.uint64), one[:: 3], one[: len(one) // 2], one, np.union1d(one, other)]
                for common in shares:
                    left = postings(one, firsts, threshold, common)
                    right = postings(other, firsts, threshold, common)
                    assert np.intersect1d(left, right).size


@pytest.mark.parametrize("bucket", [1, 4, 512])
def test_tree_links_connect_like_brute_force(monkeypatch, bucket):
    monkeypatch.setattr(PrefixTree, "BUCKET", bucket)
    rng = random.Random(bucket)
    base = [rng.sample(range(300), 40) for _ in range(6)]
    sets = []
    for _ in range(80):
        own = set(rng.choice(base))
        own -= set(rng.sample(sorted(own), rng.randint(0, 4)))
        own |= set(rng.sample(range(300), rng.randint(0, 3)))
        sets.append(np.array(sorted(own), np.uint64))
    sets = list({set_hash(one): one for one in sets}.values())
    threshold = Threshold(80, 100)
    links = tree_links(sets, threshold)
    alike = [
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if threshold.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
    ]
    assert {tuple(sorted(link)) for link in links} <= set(alike)

    def groups(pairs):
        of = list(range(len(sets)))
        for a, b in pairs:
            of = [of[a] if x == of[b] else x for x in of]
        return {frozenset(i for i in range(len(sets)) if of[i] == g) for g in of}

    assert groups(links) == groups(alike)


def test_connected_long_chain(spark):
    links = spark.createDataFrame(
        [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (5, 4)], "a bigint, b bigint"
    )
    labels = {r.id: r.label for r in connected(links, "a", "b").collect()}
    assert len({labels[i] for i in range(61)}) == 1 and labels[100] == labels[101] != labels[0]
    assert len(labels) == 63
