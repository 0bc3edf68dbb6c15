"""Language profiles and the quality classifier: held-out accuracy, exact parts, odd input."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textrisk.llm import language, quality
from textrisk.llm.queries import QUERIES
from textrisk.llm.sums import array_sums

FOLDER = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id bigint, text string, lang string, score double, statistics string"


def naive_vector(text, dimensions):
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    padded = " " + " ".join(letters.split()) + " "
    total = np.zeros(dimensions)
    code = lambda c: 0 if c == " " else ord(c)
    for i in range(1, len(padded) - 1):
        if padded[i] != " ":
            a, b, c = (language._letter(code(padded[i + d]), dimensions) for d in (-1, 0, 1))
            total += np.roll(a, 2) * np.roll(b, 1) * c
    return total


def test_document_vectors_equal_the_plain_form(monkeypatch):
    rng = random.Random(3)
    texts = ["", None, "a", "Ab, ab!", "x\0y", "İstanbul ß", "日本語 テスト", "…", "  word  "]
    texts += ["".join(rng.choices("abcde éÀ,.\n", k=rng.randint(1, 200))) for _ in range(30)]
    plain = np.array([naive_vector(text, 256) for text in texts])
    assert (language.document_vectors(texts, 256) == plain).all()
    monkeypatch.setattr(language, "_TRIGRAM_BLOCK", 7)
    monkeypatch.setattr(language, "_MATRIX_CELLS", 16)
    assert (language.document_vectors(texts, 256) == plain).all()
    wide = ["".join(map(chr, rng.sample(range(0x4E00, 0x9000), 400))) for _ in range(3)]
    plain = np.array([naive_vector(text, 64) for text in wide])
    assert (language.document_vectors(wide, 64) == plain).all()


def test_language_query_on_held_out_rows(spark):
    found = QUERIES["op6_language"](spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(known, "doc_id").collect()
    assert len(rows) == known.count()
    held = [r for r in rows if r.held_out and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rows = [
        (1, "the cat and the dog", "en", 1.0, "x"), (2, "der hund und die katze", "de", 1.0, "x"),
        (None, None, "en", None, None), (4, "", "de", None, None), (5, "12 34 !?", None, None, None),
        (6, "the dog", None, None, None), (6, "the dog", None, None, None), (7, "der " * 50_000, None, 0.0, ""),
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    found = language.predict_language(frame, language.fit_profiles(frame), [F.col("doc_id")])
    got = sorted(((r.doc_id, r.lang_pred) for r in found.collect()), key=str)
    assert got == sorted(
        [(1, "en"), (2, "de"), (None, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (7, "de")],
        key=str,
    )
    empty = frame.where("false")
    nothing = language.fit_profiles(empty)
    assert language.predict_language(empty, nothing, [F.col("doc_id")]).count() == 0
    unknown = language.predict_language(frame, nothing, [F.col("doc_id")]).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_very_long_texts_teach_their_language(spark):
    rows = [(1, "der hund und die katze " * 120_000, "de", 1.0, "x"), (2, "the cat and the dog", "en", 1.0, "x")]
    assert sum(map(str.isalpha, rows[0][1])) > 2_000_000
    frame = spark.createDataFrame(rows, DOCUMENTS)
    profiles = language.fit_profiles(frame, 1024)
    assert profiles.languages == ("de", "en")
    assert np.linalg.norm(profiles.prototypes, axis=1) == pytest.approx([1, 1])
    asked = spark.createDataFrame([(3, "die katze", None, None, None), (4, "the dog", None, None, None)], DOCUMENTS)
    found = language.predict_language(asked, profiles, [F.col("doc_id")]).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {3: "de", 4: "en"}
    # A long and a short text count the same.
    mixed = spark.createDataFrame([(1, "abc " * 200_000, "x", 1.0, "x"), (2, "xyz", "x", 1.0, "x")], DOCUMENTS)
    one = language.fit_profiles(mixed, 1024).prototypes[0]
    vectors = language.document_vectors(["abc", "xyz"], 1024)
    equal = vectors.sum(axis=0) / np.linalg.norm(vectors.sum(axis=0))
    assert one == pytest.approx(equal, abs=1e-3)


def test_profiles_do_not_depend_on_partitions(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = language.fit_profiles(frame.coalesce(1), 128)
    many = language.fit_profiles(frame.repartition(7), 128)
    assert one.languages == many.languages and (one.prototypes == many.prototypes).all()


def test_quality_query_on_held_out_rows(spark):
    found = QUERIES["op2_quality"](spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found.count() == documents.count()
    rows = found.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.quality == r.predicted for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_statistics_of_simple_texts():
    names = list(quality.STATISTICS)
    rows = quality.statistics(pa.array(["a a a\nb É!", None, "", "AB CD"]))
    assert rows.shape == (4, len(names)) and np.isfinite(rows).all()
    assert (rows[1] == rows[2]).all() and not rows[1].any()
    share = lambda part, whole: np.arcsin(np.sqrt(part / whole))
    first = dict(zip(names, rows[0]))
    assert first["log_chars"] == pytest.approx(np.log1p(10)) and first["log_words"] == pytest.approx(np.log1p(5))
    assert first["distinct_words"] == pytest.approx(share(3, 5)) and first["top_word"] == pytest.approx(share(3, 5))
    assert first["repeated_next"] == pytest.approx(share(2, 5)) and first["exclaims"] == pytest.approx(share(1, 10))
    assert first["wide_uppers"] == pytest.approx(share(1, 10)) and first["spaces"] == pytest.approx(share(4, 10))
    assert rows[3][names.index("upper_words")] == pytest.approx(np.pi / 2)


def labelled_frame(spark, rows):
    return spark.createDataFrame(rows, "label int, statistics array<double>")


def test_discriminant_equals_direct_formula(spark):
    size = len(quality.STATISTICS)
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, (80, size)), rng.normal(0.7, 2, (150, size))])
    labels = [0] * 80 + [1] * 150
    frame = labelled_frame(spark, [(label, row.tolist()) for label, row in zip(labels, values)])
    model = quality.fit_discriminant(frame.repartition(4), 0.3, 0.1)
    z = (values - values.mean(axis=0)) / values.std(axis=0)
    groups = [z[:80], z[80:]]
    covariances = [np.cov(g.T, bias=True) for g in groups]
    pooled = (80 * covariances[0] + 150 * covariances[1]) / 230
    density = []
    for group, covariance, share in zip(groups, covariances, (80 / 230, 150 / 230)):
        shrunk = 0.7 * covariance + 0.3 * pooled
        shrunk = 0.9 * shrunk + 0.1 * np.trace(shrunk) / size * np.eye(size)
        off = z - group.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", off, np.linalg.inv(shrunk), off)
        density.append(np.log(share) - 0.5 * np.linalg.slogdet(shrunk)[1] - 0.5 * distance)
    assert np.allclose(model.log_odds(values), density[1] - density[0])


def test_discriminant_without_rows_or_class(spark):
    frame = labelled_frame(spark, [])
    model = quality.fit_discriminant(frame)
    assert (model.score(np.ones((2, len(quality.STATISTICS)))) == 0.5).all()
    one = labelled_frame(spark, [(1, [float(i) for i in range(len(quality.STATISTICS))])] * 3)
    assert np.allclose(quality.fit_discriminant(one).score(np.ones((2, len(quality.STATISTICS)))), 0.5)


def test_quality_of_odd_rows(spark):
    rows = [(1, "good text here", "en", 1.0, "x"), (None, None, None, None, None),
            (2, "", "en", 0.0, ""), (2, "", "en", 0.0, ""), (3, "long " * 100_000, None, None, None)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    stats = quality.with_statistics(frame, ["doc_id"])
    assert stats.columns == ["doc_id", "statistics"] and stats.count() == 5
    model = quality.fit_discriminant(labelled_frame(spark, []))
    scored = quality.score_quality(stats, model).collect()
    assert sorted(str(r.doc_id) for r in scored) == ["1", "2", "2", "3", "None"]
    assert quality.with_statistics(frame.where("false"), ["doc_id"]).count() == 0


def test_array_sums_refuses_many_keys(spark):
    frame = spark.range(20).select(F.col("id").alias("k"), F.array(F.lit(1), F.col("id")).alias("v"))
    sums = array_sums(frame.withColumn("k", F.col("k") % 2), "k", "v", 2)
    assert sums[0].tolist() == [10, 90] and sums[1].tolist() == [10, 100]
    with pytest.raises(ValueError):
        array_sums(frame, "k", "v", 10)


def test_pages_are_drawn_by_their_number(spark):
    """So many different pages teach, however many copies or pages there are."""
    from pyspark.sql import functions as F

    from textrisk.llm import html_text

    page = "<html><body><nav>menu {0}</nav><article><p>{1} words of a long article {0}</p></article></body></html>"
    rows = [(page.format(i, "many " * 20),) for i in range(40)] + [(page.format(0, "many " * 20),)] * 200
    frame = spark.createDataFrame(rows, "html string").withColumn("page_id", F.lit(1))
    assert html_text.fit_node_trees(frame, 10, 2, 2) is not None
    assert html_text.fit_node_trees(frame, 1, 2, 2) is not None  # one page of any number of them
    assert html_text.fit_node_trees(frame.where("false"), 10, 2, 2) is None
