"""Exports, samples and summaries as files; the plans end to end; the stream."""

import csv
import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.operators import models
from textrisk.operators.labels import resolve_labels
from textrisk.operators.messages import clean_messages, file_counters, pseudonymize
from textrisk.operators.textvec import FeatureSpec
from textrisk.plans import labeling, training
from textrisk.sources.exports import read_chat_exports, read_message_lines, stream_message_lines
from textrisk.sources.samples import ensure_sample, read_first_sample, read_sample, write_sample
from textrisk.sources.tables import from_table
from textrisk.streaming.scoring import featured_stream, hourly_stream


def message(i, text, **fields):
    return {"id": i, "type": "message", "date": f"2024-01-02T{i % 24:02}:00:00", "from_id": f"user{i % 5}",
            "text": text, **fields}


@pytest.fixture()
def exports(tmp_path):
    first = {"name": "A", "messages": [
        message(1, "Пиши на x@y.zz"), message(2, ["a", {"type": "bold", "text": "b"}, "c"]),
        message(3, " "), message(4, 5), {"id": 5, "type": "service"}, {"id": 6, "text": "no type"},
        message(7, '["abc"]', from_id=None), message(8, "bad date", date="2024-1-2", from_id=""),
        {"type": "message", "text": "no id", "extra": {"k": [1]}},
    ]}
    (tmp_path / "one.json").write_text(json.dumps(first, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "two.v2.json").write_text(json.dumps({"messages": [message(1, "сука, \"да\",\nнет")]}), encoding="utf-8")
    (tmp_path / "none.json").write_text(json.dumps({"name": "C"}), encoding="utf-8")
    return [str(tmp_path / n) for n in ("one.json", "two.v2.json", "none.json")]


def test_read_exports(spark, exports):
    raw = read_chat_exports(spark, exports)
    rows = {(r.chat, r.text): r for r in clean_messages(raw).collect()}
    assert sorted(rows) == sorted([
        ("one", "Пиши на <EMAIL>"), ("one", "abc"), ("one", '["abc"]'), ("one", "bad date"),
        ("one", "no id"), ("two.v2", 'сука, "да", нет'),
    ])
    assert rows["one", '["abc"]'].raw_user_id == rows["one", "bad date"].raw_user_id == "unknown"
    assert rows["one", "bad date"].date is None and rows["one", "bad date"].hour is None
    first = rows["one", "abc"]
    assert (first.date, first.hour, first.month) == (datetime(2024, 1, 2, 2), 2, "2024-01")
    counters = {r.file: tuple(r)[1:] for r in file_counters(raw).collect()}
    assert counters == {"one.json": (9, 5, 2, 2), "two.v2.json": (1, 1, 0, 0), "none.json": (0, 0, 0, 0)}
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_chat_exports(spark, exports + ["/no/such.json"]).count()


def test_message_lines_equal_the_export(spark, exports, tmp_path):
    content = json.loads(open(exports[0], encoding="utf-8").read())["messages"]
    lines = tmp_path / "lines" / "one.json"
    lines.parent.mkdir()
    lines.write_text("\n".join(json.dumps(m) for m in content), encoding="utf-8")
    left = clean_messages(read_message_lines(spark, str(lines)))
    right = clean_messages(read_chat_exports(spark, exports[0], spread=4))
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_from_table_defaults(spark):
    frame = spark.createDataFrame([(1, "a")], "k int, t string")
    row = from_table(frame, {"id": "k", "text": "t", "file": F.lit("f.json")}).first()
    assert (row.type, row.id, row.from_id) == ("message", 1, None)
    with pytest.raises(ValueError, match="nope"):
        from_table(frame, {"nope": "k"})


def test_prepare_and_label_sample(spark, exports, tmp_path):
    sample_path, summary_path = str(tmp_path / "sample"), str(tmp_path / "summary")
    sample = labeling.prepare_sample(spark, exports, sample_path, summary_path, size=4)
    assert sample.columns == list(fixed.SAMPLE_COLUMNS)
    rows = sample.collect()
    assert sorted(r.label_id for r in rows) == [1, 2, 3, 4]
    assert all(r.user.startswith("user_") for r in rows)
    summary = json.loads(spark.read.text(summary_path).first()[0])
    files = {r.file: r.asDict() for r in spark.read.json(f"{summary_path}_files").collect()}
    assert "files" not in summary and files["one.json"] == {
        "file": "one.json", "raw_messages": 9, "kept_messages": 5, "service_or_non_message": 2,
        "empty_text": 2,
    }
    assert (summary["total_raw_messages"], summary["total_kept_messages"]) == (10, 6)
    assert summary["anonymous_users"] == 3 and summary["labeling_sample_size"] == 4
    labelled = labeling.label_sample(spark, sample_path, str(tmp_path / "labelled"))
    back = read_first_sample(spark, str(tmp_path / "labelled"), sample_path)
    assert back.count() == labelled.count() == 4
    assert {r.toxic for r in back.collect()} == {"0", "1"}
    assert back.first().label_source.startswith("auto_rules")


def test_label_a_file_of_few_columns_keeps_added_ones(spark, tmp_path):
    path, out = str(tmp_path / "few"), str(tmp_path / "labelled")
    rows = [("a сука", 1, 0, 0.9, "ann", "7"), ("b", 0, 0, 0.1, "bob", "1"), ("c", 0, 0, 0.2, "cy", None)]
    names = "text string, profanity_count int, hostile_count int, risk_score double, reviewer string, `Toxic-Score` string"
    write_sample(spark.createDataFrame(rows, names), path)
    labeling.label_sample(spark, path, out)
    back = read_sample(spark, out)
    assert {"text", "toxic", "label_source", "reviewer", "Toxic-Score"} <= set(back.columns)
    assert {(r.text, r.reviewer, r.toxic) for r in back.collect()} >= {("a сука", "ann", "1"), ("b", "bob", "0")}


@pytest.mark.parametrize("read, text", [
    (read_chat_exports, '{"name": "a", "messages": [{"id": 1, "type": "mess'),
    (read_message_lines, '{"id": 1, "type": "message", "text": "a"}\n{"id": 2, "type": \n{"id": 3, "text": "c"}'),
])
def test_broken_json_fails(spark, tmp_path, read, text):
    path = tmp_path / "broken.json"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, str(path)).collect()


def sample_frame(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts, 1)), "label_id bigint, text string")
    types = dict(c.split(" ") for c in "date timestamp_ntz,hour int,risk_score double,caps_ratio double".split(","))
    for name in fixed.SAMPLE_COLUMNS:
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit(None).cast(types.get(name, "string")))
    return frame.withColumn("risk_score", F.lit(0.03125)).withColumn(
        "date", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    )


def test_sample_round_trip(spark, tmp_path):
    texts = ['quote " and, comma', "two\nlines", 'back\\slash "x"', "ёж"]
    path = str(tmp_path / "s")
    write_sample(sample_frame(spark, texts), path, rounded=True)
    rows = sorted(read_sample(spark, path).collect(), key=lambda r: r.label_id)
    assert [r.text for r in rows] == texts
    assert rows[0].risk_score == 0.0312 and rows[0].date == datetime(2024, 1, 2, 3, 4, 5)


def test_read_sample_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "bom.csv"
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.DictWriter(file, fixed.SAMPLE_COLUMNS)
        writer.writeheader()
        writer.writerow({"label_id": 1, "text": 'a "b",\nc', "date": "2024-01-02 03:04:05", "toxic": "1"})
    row = read_sample(spark, str(path)).first()
    assert (row.label_id, row.text, row.toxic) == (1, 'a "b",\nc', "1")
    assert row.date == datetime(2024, 1, 2, 3, 4, 5)


def test_columns_added_by_hand(spark, tmp_path):
    path = tmp_path / "scored.csv"
    path.write_text("toxic,Toxic-Score,text,risk_score\n,7,a,0.5\n,2,b,x\n,,c,1\n", encoding="utf-8-sig")
    frame = read_first_sample(spark, str(tmp_path / "missing"), str(path))
    assert frame.columns == ["toxic", "Toxic-Score", "text", "risk_score"]
    assert [r.risk_score for r in frame.collect()] == [0.5, None, 1.0]
    got = {r.text: (r.toxic, r.label_source) for r in resolve_labels(frame).collect()}
    assert got == {"a": (1, "Toxic-Score >= 5"), "b": (0, "Toxic-Score >= 5")}
    with pytest.raises(FileNotFoundError):
        read_first_sample(spark, str(tmp_path / "missing"))


def test_ensure_sample(spark, tmp_path):
    path, built = str(tmp_path / "s"), []

    def build(count):
        def make():
            built.append(count)
            return sample_frame(spark, [f"t{i}" for i in range(count)])
        return make

    assert ensure_sample(spark, path, 3, build(3)).count() == 3
    assert ensure_sample(spark, path, 3, build(5)).count() == 3
    assert ensure_sample(spark, path, 4, build(5)).count() == 5
    assert built == [3, 5]


def chat(spark, count=160):
    words = ["tea", "milk", "rain", "road", "bird"]
    rows = []
    for i in range(count):
        text = " ".join(words[(i * k + k) % 5] for k in range(1, 5 + i % 3))
        rows.append((f"chat{i % 2}.json", i, f"2024-0{1 + i % 3}-05T{i % 24:02}:00:00", f"u{i % 3}",
                     text + (" сука" if i % 4 == 0 else ""), str(int(i % 4 == 0))))
    frame = spark.createDataFrame(rows, "f string, i int, d string, u string, t string, toxic string")
    raw = from_table(frame, {"file": "f", "id": "i", "date": "d", "from_id": "u", "text": "t"})
    messages = pseudonymize(labeling.message_table(raw))
    marks = frame.select(F.col("t").alias("text"), "toxic").distinct()
    return messages, messages.join(marks, "text")


def test_train_and_report(spark):
    messages, labelled = chat(spark)
    text = FeatureSpec(max_features=30)
    specs = {"logistic": models.LogisticSpec(text, max_iter=10), "forest": models.ForestSpec(text, trees=5, depth=4)}
    report = training.train_and_report(labelled, messages, specs, min_messages=10)
    tables = report.tables
    assert report.best in specs and tables["leaderboard"].count() == 2
    assert tables["scored"].count() == messages.count() == 160
    assert set(tables["scored"].columns) == {"message_hash", "chat", "date", "hour", "month", "user", "toxicity_score"}
    assert tables["monthly"].count() == 3 and tables["hourly"].count() == 24
    assert tables["top_users"].count() == 3
    assert sum(r["rows"] for r in tables["confusion_matrix"].collect()) == 32


def test_boosted_study(spark):
    _, labelled = chat(spark)
    small = models.BoostedSpec(models.replace(models.BoostedSpec().features, max_features=20), rounds=2)
    report = training.boosted_study(
        labelled, small, small, sizes=(), settings=[{"rounds": 2}], fractions=(1.0,), max_folds=2
    )
    metrics = report.tables["metrics"].first()
    assert metrics.f1 > 0.8 and metrics.roc_auc > 0.8
    assert report.tables["feature_importance"].count() <= 30
    assert report.tables["search"].count() == 1


def test_stream_equals_batch(spark, exports, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    rows = [message(i, f"сука {i}!") for i in range(50)]
    for part in range(2):
        (folder / f"{part}.json").write_text("\n".join(json.dumps(m) for m in rows[part::2]), encoding="utf-8")
    stream = hourly_stream(featured_stream(stream_message_lines(spark, str(folder))))
    running = (
        stream.writeStream.outputMode("complete").format("memory").queryName("hours")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    )
    running.awaitTermination(120)
    got = {r.hour_start.hour: r.messages for r in spark.table("hours").collect()}
    batch = clean_messages(read_message_lines(spark, str(folder))).groupBy("hour").count().collect()
    assert got == {r.hour: r["count"] for r in batch} and sum(got.values()) == 50
