"""Spelling variants and their index against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import queries
from textrisk.llm import spelling
from textrisk.llm.fm_index import VocabularyIndex

FOLDER = "/root/testdata/sf0.001"
TEXTS = "doc_id bigint, text string, word string, n int, half string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def edits(word, letters):
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]


def plain_words(rows, least_length=7, least_count=2, one_in=31):
    found = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                found[run] += 1
    return {word: n for word, n in found.items() if n >= least_count}


def plain_variants(words, ratio=10):
    letters = {c for word in words for c in word}
    near = {w: {v for v in edits(w, letters) if v in words and v != w} for w in words}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= ratio * n else None
    rows = set()
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return rows


def result(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(row) for row in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("seed", range(12))
def test_index_finds_one_edit(seed):
    rng = random.Random(seed)
    letters = ["ab", "abcé", "aÿ", "abcdefghij"][seed % 4]
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(120)})
    asked = words + ["".join(rng.choices(letters + "z", k=rng.randint(1, 9))) for _ in range(30)]
    exact = np.array([rng.randint(0, len(word)) for word in asked])
    who, near = VocabularyIndex(words).near(asked, exact)
    found = list(zip(who.tolist(), near.tolist()))
    expected = set()
    for i, (word, tail) in enumerate(zip(asked, exact.tolist())):
        for j, other in enumerate(words):
            ends = len(other) >= tail and word[len(word) - tail :] == other[len(other) - tail :]
            if ends and one_edit(word[: len(word) - tail], other[: len(other) - tail]):
                expected.add((i, j))
    assert len(found) == len(set(found)) and set(found) == expected


def test_index_of_long_and_single_words():
    long = "xy" * 3000
    words = sorted([long, long + "x", long[:2999] + "z" + long[3000:], "a"])
    who, near = VocabularyIndex(words).near([long, "a", "ab", ""], np.array([3000, 0, 0, 0]))
    assert {(w, words[n]) for w, n in zip(who.tolist(), near.tolist())} == {
        (0, long[:2999] + "z" + long[3000:]), (2, "a"), (3, "a"),
    }


def vocabulary(seed, shortest=7):
    rng = random.Random(seed)
    words = {}
    for _ in range(40):
        word = "".join(rng.choices("abé" if seed % 2 else "abcdefgh", k=rng.randint(shortest, shortest + 5)))
        words[word] = rng.choice([2, 5, 50, 400, 5000])
        for other in rng.sample(sorted(edits(word, "abé")), 12):
            if len(other) >= shortest:
                words[other] = rng.choice([2, 3, 20, 200])
    return words


@pytest.mark.parametrize("seed, bucket_words, most_words", [(1, 20, 6), (2, 16384, 65536), (3, 5, 1), (4, 64, 8)])
def test_variants_equal_all_pairs(spark, seed, bucket_words, most_words):
    words = vocabulary(seed, 1 if seed == 4 else 7)
    rows = [(word, n, "extra") for word, n in words.items()] + [(None, 3, "extra")]
    frame = spark.createDataFrame(rows, "word string, n int, best string").repartition(4)
    found = spelling.group_variants(frame, 10, bucket_words, most_words)
    assert result(found) == plain_variants(words)


def test_words_of_texts(spark):
    rows = [
        (1, "Maximal maximal; ÉCOLESÀ école×trees 12abcdefg_hijklmn", "w", 1, "h"),
        (None, "maximal ﬁnalist Straßenbahn İstanbul", None, None, None),
        (2, None, None, None, None),
        (3, "", None, None, None),
        (4, "lengthy " * 30_000 + "q" * 200_000, None, None, None),
        (4, "q" * 200_000, None, None, None),
    ]
    rows += [(i, "repeated rowsrows", None, None, None) for i in range(200)] + [(7, "repeated rowsrows", "", 0, "")]
    frame = spark.createDataFrame(rows, TEXTS).repartition(3)
    found = {row.word: row.n for row in spelling.word_counts(frame).collect()}
    assert found == plain_words(rows)
    everything = spelling.word_counts(frame, 1, 1, None)
    assert {row.word: row.n for row in everything.collect()} == plain_words(rows, 1, 1, 1 << 40)


def test_nothing_to_group(spark):
    nothing = spark.createDataFrame([], TEXTS)
    assert spelling.group_variants(spelling.word_counts(nothing)).count() == 0
    alone = spark.createDataFrame([("lonely", 5)], "word string, n bigint")
    assert result(spelling.group_variants(alone)) == {("lonely", None, "lonely", 5, 0, None)}
    with pytest.raises(ValueError):
        spelling.group_variants(alone, 1)


def test_query_equals_all_pairs(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([tuple(row) for row in documents])
    assert len(words) > 1000
    assert result(queries()["op13_spelling"](spark, FOLDER)) == plain_variants(words)
