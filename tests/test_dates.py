"""ISO dates against Python's own reader, and broken lines of a stream."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from textrisk.functions import dates
from textrisk.sources.exports import stream_message_lines


def read(text):
    try:
        return datetime.fromisoformat(text).replace(tzinfo=None)
    except ValueError:
        return None


def test_week_dates_equal_python(spark):
    texts = ["2024-W01-1", "2024W011", "2024-W01", "2024W01", "2024-W01-1T05:06:07", "2020-W53-7", "2021-W53-1",
             "2024-W00-1", "2024-W54-1", "2024-W01-0", "2024-W01-8", "2024W01T08", "2024-W1-1", "2024-W01-1T25:00",
             "1999-W52-7T23:59:59.5", "2024-W011", "2024W01-1", "W01", "2024-W01-1T10:00+02:00", "2024-01-02", "20240102"]
    for year in range(1995, 2035):
        first = date(year, 12, 28)
        for day in (first + timedelta(days=i) for i in range(0, 8)):
            iso = day.isocalendar()
            texts += [f"{iso[0]}-W{iso[1]:02d}-{iso[2]}", f"{iso[0]}W{iso[1]:02d}{iso[2]}T01:02"]
        texts.append(f"{year}-W53-4")
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.d for r in frame.select("t", dates.parse_iso("t").alias("d")).collect()}
    assert found == {text: read(text) for text in texts}
    parts = frame.where("t = '2020-W53-7'").select(dates.parse_iso("t").alias("d")).select(
        dates.month_of("d").alias("m"), F.col("d")
    ).first()
    assert parts.m == "2021-01" and parts.d == datetime(2021, 1, 3)


def test_a_broken_line_fails_the_stream(spark, tmp_path):
    line = json.dumps({"id": 1, "type": "message", "date": "2024-01-02T03:04:05", "from_id": "u", "text": "hello"})
    for name, lines, broken in (("good", [line], False), ("bad", [line, '{"id": 2, "type'], True)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.json").write_text("\n".join(lines))
        stream = stream_message_lines(spark, str(folder)).writeStream.format("memory").queryName(f"lines_{name}")
        query = stream.trigger(availableNow=True).start()
        if broken:
            with pytest.raises(StreamingQueryException):
                query.awaitTermination()
        else:
            query.awaitTermination()
            assert spark.table(f"lines_{name}").count() == 1
