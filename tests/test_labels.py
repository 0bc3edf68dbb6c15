"""Label resolution, evaluation and trend tables on small frames, against plain Python."""

import random
from datetime import date, datetime

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from textrisk.operators import checks, evaluation, labels, summary, trends


def marked(spark, marks, **extra):
    rows = [(i, m, float(i), 0, 0) for i, m in enumerate(marks)]
    frame = spark.createDataFrame(
        rows, "id int, toxic string, risk_score double, profanity_count int, hostile_count int"
    )
    for name, value in extra.items():
        frame = frame.withColumn(name, value)
    return frame


def test_manual_labels_win(spark):
    got = labels.resolve_labels(marked(spark, ["1", "0", "2", "x", None, " 1 ", "1.0"])).collect()
    assert [(r.id, r.toxic, r.label_source) for r in got] == [
        (0, 1, "manual_binary"), (1, 0, "manual_binary"), (5, 1, "manual_binary"), (6, 1, "manual_binary")
    ]
    kept = labels.manual_labels(marked(spark, ["1"], label_source=F.lit("auto"))).first()
    assert kept.label_source == "auto"
    dropped = labels.manual_labels(marked(spark, ["1"], label_source=F.lit("auto")), keep_source=False)
    assert dropped.first().label_source == "manual_binary"


@pytest.mark.parametrize("top, cut, shown", [(1.0, 0.5, "0.5"), (8.0, 5.0, "5"), (90.0, 50.0, "50")])
def test_scores_are_cut_by_their_scale(spark, top, cut, shown):
    frame = marked(spark, [None, "x", ""]).withColumn(
        "Toxic-Score", F.expr(f"array('{top}', 'bad', '{cut}')[id]")
    )
    got = {r.id: r for r in labels.resolve_labels(frame).collect()}
    assert sorted(got) == [0, 2]
    assert got[0].toxic == got[2].toxic == 1 and got[2].toxicity_score_label == cut
    assert got[0].label_source == f"Toxic-Score >= {shown}"
    explicit = labels.score_labels(frame, "Toxic-Score", threshold=top + 1).collect()
    assert [r.toxic for r in explicit] == [0, 0]
    assert explicit[0].label_source == f"Toxic-Score >= {top + 1:g}"


def test_score_column_names():
    assert labels.find_score_column(["id", " Toxicity-Score "]) == " Toxicity-Score "
    assert labels.find_score_column(["score", "toxic_score"]) == "toxic_score"
    assert labels.find_score_column(["Токсичность"]) == "Токсичность"
    assert labels.find_score_column(["id"]) is None
    # Runs of blanks, dashes and underscores are one separator; the last of equal names wins.
    assert labels.find_score_column(["toxic_score", "note", "Toxic -Score"]) == "Toxic -Score"
    assert labels.find_score_column(["_score_", "SCORE-toxicity"]) == "SCORE-toxicity"
    assert labels.find_score_column(["toxicscore"]) is None


def test_weak_labels_and_notes(spark):
    rows = [(i, float(i), int(i == 1), 0, None if i % 2 else "seen") for i in range(10)]
    frame = spark.createDataFrame(
        rows, "id int, risk_score double, profanity_count int, hostile_count int, notes string"
    )
    got = {r.id: r for r in labels.weak_labels(frame).collect()}
    # the 0.8 quantile of 0..9 is 7.2
    assert [i for i in range(10) if got[i].toxic] == [1, 8, 9]
    assert got[1].notes == "auto: bad word / hostile word"
    assert got[9].notes == "auto: risk_score >= 7.200"
    assert got[2].notes == "seen" and got[3].notes == ""
    assert got[0].label_source == "auto_rules: bad_words or risk_score >= 7.200"
    assert labels.weak_labels(frame.drop("notes")).where("id = 0").first().notes == ""
    with pytest.raises(ValueError, match=r"\['hostile_count', 'risk_score'\]"):
        labels.weak_labels(frame.drop("risk_score", "hostile_count"))


def test_resolution_order(spark):
    blank = marked(spark, [None, "", "x"])
    assert labels.resolve_labels(blank).first().label_source.startswith("auto_rules")
    with pytest.raises(ValueError, match="no labels"):
        labels.resolve_labels(blank, allow_weak=False)
    with pytest.raises(ValueError, match="no rows"):
        labels.resolve_labels(blank.limit(0), allow_weak=False)


def test_training_rows(spark):
    frame = marked(spark, ["1", "0", "1"]).withColumn("text", F.expr("array('a', ' ', null)[id]"))
    for name in ("char_len", "word_count", "exclamation_count", "question_count", "caps_ratio"):
        frame = frame.withColumn(name, F.lit("1"))
    got = labels.training_rows(frame).collect()
    assert [(r.id, r.char_len) for r in got] == [(0, 1.0)]


def test_class_checks(spark):
    one = spark.createDataFrame([(1,)] * 3, "toxic int")
    with pytest.raises(ValueError):
        checks.require_classes(one)
    two = spark.createDataFrame([(1,)] * 3 + [(0,)] * 9, "toxic int")
    with pytest.warns(UserWarning):
        assert checks.require_classes(two) == 3
    weights = {r.toxic: r for r in summary.class_weights(two).collect()}
    assert weights[1].balanced_weight == 2.0 and weights[0].pos_weight == 3.0
    balance = {r.toxic: r.share for r in summary.class_balance(two).collect()}
    assert balance == {0: 0.75, 1: 0.25}


def test_message_checks_find_violations(spark):
    frame = spark.createDataFrame(
        [("a", "user_001"), (" ", "user_1000"), ("b", "bob"), (None, None)], "text string, user string"
    )
    row = checks.message_checks(frame).first()
    assert (row["rows"], row.empty_text, row.bad_pseudonym, row.raw_id_columns) == (4, 2, 2, 0)


def rated(spark, count=400, levels=25, seed=1):
    source = random.Random(seed)
    rows = []
    for _ in range(count):
        label = int(source.random() < 0.3)
        score = min(0.999, max(0.0, round(source.gauss(0.4 + 0.2 * label, 0.2) * levels) / levels))
        rows.append((label, score, int(score > 0.5)))
    return rows, spark.createDataFrame(rows, "label int, score double, prediction int").repartition(5)


def test_confusion_metrics_and_report(spark):
    rows, frame = rated(spark)
    cells = {(y, p): sum(r[0] == y and r[2] == p for r in rows) for y in (0, 1) for p in (0, 1)}
    got = evaluation.confusion_matrix(frame).collect()
    assert {(r.label, r.prediction): r["rows"] for r in got} == cells
    metrics = evaluation.binary_metrics(frame).first()
    precision = cells[1, 1] / (cells[1, 1] + cells[0, 1])
    recall = cells[1, 1] / (cells[1, 1] + cells[1, 0])
    assert metrics.precision == pytest.approx(precision) and metrics.recall == pytest.approx(recall)
    assert metrics.f1 == pytest.approx(2 * precision * recall / (precision + recall))
    report = {r["class"]: r for r in evaluation.class_report(frame).collect()}
    assert report["1"].support == cells[1, 0] + cells[1, 1]
    assert report["macro avg"].recall == pytest.approx((report["0"].recall + report["1"].recall) / 2)
    assert len(evaluation.error_slices(frame).collect()) == cells[0, 1] + cells[1, 0]


def test_metrics_without_positives_are_zero(spark):
    frame = spark.createDataFrame([(0, 0.2, 0)] * 4, "label int, score double, prediction int")
    row = evaluation.binary_metrics(frame).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
    assert evaluation.roc_auc(evaluation.score_points(frame)).first()[0] is None


def test_curves_against_brute_force(spark):
    rows, frame = rated(spark)
    points = evaluation.score_points(frame)
    positives = [r[1] for r in rows if r[0]]
    negatives = [r[1] for r in rows if not r[0]]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    area = evaluation.roc_auc(points).first()[0]
    assert area == pytest.approx(wins / len(positives) / len(negatives), rel=1e-12)
    library = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert area == pytest.approx(library.evaluate(frame), abs=1e-9)

    thresholds = sorted({r[1] for r in rows}, reverse=True)
    curve = {r.threshold: r for r in evaluation.pr_points(points).collect()}
    roc = {r.threshold: r for r in evaluation.roc_points(points).collect()}
    assert set(curve) == set(roc) == {*thresholds, None}
    expected, before, best = 0.0, 0.0, (0.0, 0.0)
    for cut in thresholds:
        hits, wrong = sum(p >= cut for p in positives), sum(n >= cut for n in negatives)
        precision, recall = hits / (hits + wrong), hits / len(positives)
        assert curve[cut].precision == pytest.approx(precision)
        assert curve[cut].recall == pytest.approx(recall) == roc[cut].tpr
        assert roc[cut].fpr == pytest.approx(wrong / len(negatives))
        expected += (recall - before) * precision
        before = recall
        f1 = 2 * precision * recall / (precision + recall) if hits else 0.0
        best = max(best, (round(f1, 12), cut))
    assert evaluation.average_precision(points).first()[0] == pytest.approx(expected)
    chosen = evaluation.best_threshold(points).first()
    assert (chosen.f1, chosen.threshold) == (pytest.approx(best[0]), best[1])
    bins = evaluation.calibration_bins(frame).collect()
    assert sum(b["rows"] for b in bins) == len(rows) and all(0 <= b.bin <= 9 for b in bins)


def scored(spark):
    rows = [
        ("a", datetime(2024, 1, 31, 23, 59), 0.5), ("a", datetime(2024, 1, 1, 0, 0), 0.1),
        ("b", datetime(2024, 4, 30, 18, 0), 0.9), ("b", None, 0.3), ("a", datetime(2024, 4, 1, 17, 0), 0.7),
    ]
    frame = spark.createDataFrame(rows, "user string, date timestamp_ntz, toxicity_score double")
    return frame.withColumn("hour", F.hour("date"))


def test_trends(spark):
    frame = scored(spark)
    hourly = {r.hour: (r.mean_toxicity, r.messages) for r in trends.hourly_trend(frame).collect()}
    assert hourly == {23: (0.5, 1), 0: (0.1, 1), 18: (0.9, 1), 17: (0.7, 1)}
    parts = [(r.time_period, r.messages) for r in trends.day_part_trend(frame).collect()]
    assert parts == [("evening_18_23", 2), ("other_time", 2)]
    monthly = sorted(trends.monthly_trend(frame).collect(), key=lambda r: r.month_end)
    assert [(r.month_end, r.messages) for r in monthly] == [
        (date(2024, 1, 31), 2), (date(2024, 2, 29), 0), (date(2024, 3, 31), 0), (date(2024, 4, 30), 2)
    ]
    assert monthly[1].mean_toxicity is None and monthly[3].mean_toxicity == pytest.approx(0.8)
    best = trends.top_users(frame, min_messages=3).collect()
    assert [(r.user, r.messages) for r in best] == [("a", 3)]
    assert trends.monthly_trend(frame.limit(0)).count() == 0


def test_dataset_summary(spark):
    frame = scored(spark).withColumn("chat", F.col("user"))
    got = {r.metric: r.value for r in summary.dataset_summary(frame, 9).collect()}
    assert got == {
        "messages_used_in_notebook": "5", "messages_after_filtering_full": "9", "anonymous_users": "2",
        "date_min": "2024-01-01 00:00:00", "date_max": "2024-04-30 18:00:00", "chats": "2",
    }
    many = spark.range(1500).select(
        F.col("id").cast("string").alias("chat"), F.col("id").alias("user"),
        F.lit(None).cast("timestamp_ntz").alias("date"),
    )
    assert {r.metric: r.value for r in summary.dataset_summary(many).collect()}["chats"] == "1500"
