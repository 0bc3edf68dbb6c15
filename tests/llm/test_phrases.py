"""Phrase collocations against counting in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from textrisk.llm import phrases

TEXTS = "doc_id bigint, text string, lang string, phrase string, n int, score int"


def plain_pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain_counts(rows, most):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for words in plain_pieces(text):
            n[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    return f, n


def plain_collocations(rows, least, most, best, covered):
    f, n = plain_counts(rows, most)
    frequent = {key: a for key, a in f.items() if a >= least}
    inside = {}
    for (lang, words), a in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for (lang, words), a in frequent.items():
        if len(words) < 2 or 100 * inside.get((lang, words), 0) >= covered * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks, ranked = Counter(), []
    for row in out:
        ranks[row[0]] += 1
        if ranks[row[0]] <= best:
            ranked.append((row[0], ranks[row[0]], *row[1:]))
    return ranked


def case(seed, documents=200):
    rng = random.Random(seed)
    words = ["Ab", "ab", "é", "Éa", "x-y", "\x00", "cc", "漢", "d'e", "z z"]
    rows = []
    for doc_id in range(documents):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if doc_id % 3 == 0:
            parts += "Once upon a time there was".split() * rng.randint(1, 2)
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r", "\x0b", "\xa0"]) for p in parts)
        rows.append((doc_id, text, rng.choice(["en", "en", "fr", None, "und", "e n", ""]), "p", 1, 2))
    rows += [(None, None, "en", None, None, None), (1, "", None, None, None, None), rows[0], rows[0]]
    rows.append((99, "ab ab " * 300 + "Once upon a time there was. " * 20, "de", "p", 1, 1))
    return rows


@pytest.mark.parametrize(
    "seed, covered, settings",
    [(1, 100, {}), (2, 60, {"chunk_bytes": 50}), (3, 100, {"bits": 9, "chunk_bytes": 700}), (4, 100, {"most_bits": 64})],
)
def test_collocations_equal_counting(spark, seed, covered, settings):
    rows = case(seed)
    frame = spark.createDataFrame(rows, TEXTS).repartition(3)
    found = phrases.collocations(frame, 4, 5, 30, covered, **settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(row) for row in found.collect()]
    expected = plain_collocations(rows, 4, 5, 30, covered)
    assert len(expected) > 50
    assert sorted(got) == sorted(expected)


def test_counts_are_whole(spark):
    rows = case(5)
    found = phrases.phrase_counts(spark.createDataFrame(rows, TEXTS), 3, 3).collect()
    f, n = plain_counts(rows, 3)
    expected = {(lang, len(w), " ".join(w)): a for (lang, w), a in f.items() if a >= 3}
    expected |= {(lang, 0, ""): a for lang, a in n.items() if a}
    assert {(r.lang, r.size, r.phrase): r.n for r in found} == expected


def test_nothing_to_count(spark):
    empty = spark.createDataFrame([], TEXTS)
    assert phrases.collocations(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, "", 0, 0), (2, " .\t\n", "en", "", 0, 0)], TEXTS)
    assert phrases.collocations(blank, 1).count() == 0


@pytest.mark.parametrize("size", [1, 5, 64, 10_000])
def test_chunks_hold_whole_pieces(size):
    rng = random.Random(size)
    texts = ["".join(rng.choices("ab .\n", k=rng.choice([0, 3, 200]))).encode() for _ in range(30)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    seen = {i: b"" for i in range(len(texts))}
    for part, cuts, owners in phrases.chunks(data, bounds, size):
        for begin, end, owner in zip(cuts, cuts[1:], owners):
            before = seen[int(owner)]
            if before and end > begin:  # cut behind a break only
                assert before[-1:] in b".,;:!?\n\x0b\x0c\r"
            seen[int(owner)] += part[begin:end].tobytes()
    assert [seen[i] for i in range(len(texts))] == texts
