"""Times are wall-clock times: the session's time zone must not move them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from textrisk.operators.messages import clean_messages
from textrisk.sources.tables import from_table


@pytest.fixture()
def elsewhere(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_in_a_clock_change(elsewhere):
    # 02:30 does not exist in New York on this day
    frame = elsewhere.createDataFrame([("2024-03-10T02:30:00",), ("2024-03-31T23:59:59",)], "d string")
    raw = from_table(frame, {"date": "d", "text": F.lit("x"), "file": F.lit("f.json")})
    rows = sorted((r.date, r.hour, r.month) for r in clean_messages(raw).collect())
    assert rows == [
        (datetime(2024, 3, 10, 2, 30), 2, "2024-03"), (datetime(2024, 3, 31, 23, 59, 59), 23, "2024-03")
    ]
