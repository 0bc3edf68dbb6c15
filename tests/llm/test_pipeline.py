"""The pipeline's stages one by one, and the whole on the smallest tables."""

import re

import pytest

import corpus_pipeline
from textrisk.llm.mixing import MixTarget
from textrisk.llm.suffix_match import remove_overlapping

from .test_exact import brute_mix, brute_overlaps
from .test_ngram_join import brute_components
from .test_text_rules import plain_entities

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage is given and returns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER))
        if stage is not corpus_pipeline.mix:
            assert docs.columns == columns
        out.append(docs.collect())
    return out


def test_language_stage_keeps_all_with_letters(stages):
    before, after = stages[0], stages[1]
    kept = [r for r in before if any(map(str.isalpha, r.text or ""))]
    assert sorted(map(tuple, kept), key=str) == sorted(map(tuple, after), key=str)


def test_near_copies_stage(stages):
    before, after = stages[1], stages[2]
    rows = [(r.doc_id, r.text) for r in before]
    kept = {doc_id for doc_id, _, component in brute_components(rows, 5, 80) if doc_id == component}
    assert sorted(r.doc_id for r in after) == sorted(kept)


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages[2] if not brute_overlaps(r.text, items)[1]}
    assert {r.doc_id for r in stages[3]} == kept and len(kept) < len(stages[2])


def test_personal_data_stage(stages):
    before = {r.doc_id: r for r in stages[3]}
    assert {r.doc_id for r in stages[4]} == set(before)
    for row in stages[4]:
        old = before[row.doc_id]
        assert (row.lang, row.source) == (old.lang, old.source)
        found = plain_entities(old.text)
        if not found:
            assert row.text == old.text and row.n_chars == old.n_chars
        else:
            assert row.n_chars == len(row.text) and not plain_entities(row.text)
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", row.text)


def test_mixing_stage(stages):
    rows = [(r.doc_id, r.source, r.text) for r in stages[4]]
    got = [(r.doc_id, r.source, r.mix_epoch, r.mix_block, r.mix_tokens) for r in stages[5]]
    assert sorted(got, key=str) == sorted(brute_mix(rows, MixTarget()), key=str)


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, stages[5]), key=str)


def test_stages_on_odd_documents(spark):
    long = "word " * 40_000
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "one a@b.cc two", "en", "s", 14),
            (3, "one a@b.cc two", "en", "s", 14), (None, "no id here", "en", None, 10), (4, long, "en", "s", len(long)),
            (5, long, "en", "s", len(long)), (6, "twice this id", "en", "s", 13), (6, "other text of it", "en", "s", 16)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER))
        if name == "near_copies":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["3", "4", "6", "6", "None"]
    empty = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.staged(stage(spark, empty, FOLDER))
    assert empty.count() == 0


def test_near_copies_of_an_id_with_several_texts(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(200)) for c in "xyz")
    rows = [(1, one), (10, one + " end"), (10, other), (11, other + " end"), (12, third), (12, third + " end"), (12, third)]
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], DOCUMENTS)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()]
    assert sorted(doc_id for doc_id, _ in kept) == [1, 10, 12]
    assert (1, one) in kept and (10, other) in kept


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_without_a_known_language(spark, lang):
    rows = [(1, "some words", lang, "s", 10), (2, "12 !", lang, "s", 4), (3, None, lang, "s", 0), (4, "é", lang, "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = corpus_pipeline.identify_language(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4]


def test_benchmark_items_without_id_are_searched(spark):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"a {words} b", "en", "s", 1), (2, "other", "en", "s", 1)], DOCUMENTS)
    items = spark.createDataFrame([(None, words), (1, None), (None, None)], "item_id bigint, text string")
    assert [r.doc_id for r in remove_overlapping(docs, items).collect()] == [2]


CLASHES = (
    "rest passes key _key block planned cut taken before _before tokens _source _text _row_key _spans spans row_key "
    "plain base terms _copy copy _repeated repeated _text_key text_key stands a.b _0 _1 _2 mix_tokens_"
).split()


def clashing(spark, rows, ids="doc_id bigint, source string, text string"):
    """Rows with a column of every name that the stages use or have used."""
    names = [name.strip().split(" ")[0] for name in ids.split(",")]
    frame = spark.createDataFrame([(*row, *[f"{name} of {row[0]}" for name in CLASHES]) for row in rows], (
        ids + "".join(f", `{name}` string" for name in CLASHES)
    ))
    return frame, [*names, *CLASHES]


@pytest.mark.parametrize("stage", ["near_copies", "personal_data", "mixing"])
def test_columns_of_any_name_keep_their_values(spark, stage):
    said = "write to jane.doe@example.org or call +1 555 010 9999 today please"
    rows = [(i, "ab"[i % 2], f"{said} {'x' * (i // 2)} number {i}") for i in range(12)]
    rows += [(20 + i, "a", rows[0][2]) for i in range(3)]
    frame, names = clashing(spark, rows)
    out = dict(corpus_pipeline.STAGES)[stage](spark, frame, FOLDER)
    assert out.columns[: len(names)] == names
    found = out.collect()
    assert found
    for row in found:
        assert tuple(row[3 : len(names)]) == tuple(f"{name} of {row[0]}" for name in CLASHES)
        if stage == "personal_data":
            assert not any("jane.doe@" in str(value) for value in row)
    if stage == "near_copies":
        groups = brute_components([(row[0], row[2]) for row in rows], 5, 80)
        assert sorted(row[0] for row in found) == sorted(d for d, _, component in groups if d == component)


def test_a_source_with_one_hot_block(spark, monkeypatch):
    """Keys that share their first digits, as in a source of many billion documents."""
    from textrisk.llm import mixing

    from .test_exact import brute_mix

    rows = [(i, "ab"[i % 3 == 0], "w " * (1 + i % 5)) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    monkeypatch.setattr(mixing, "_BLOCK_DIGITS", 1)  # sixteen blocks, cut up again and again
    found = mixing.mix_sources(frame, MixTarget(0.9, 4.0, 0.7)).collect()
    expected = {(d, e) for d, _, e, *_ in brute_mix(rows, MixTarget(0.9, 4.0, 0.7))}
    assert {(r.doc_id, r.mix_epoch) for r in found} == expected and len(found) == len(expected)
