import datetime

import pytest
from pyspark.sql import functions as F

from msgloom.functions import time as clock


def test_parse(spark):
    cases = {
        "2024-01-02 03:04:05": "2024-01-02 03:04:05",
        "2024-01-02": "2024-01-02 00:00:00",
        "2024-01-02T03:04": "2024-01-02 03:04:00",
        "2024/1/2 3:04": "2024-01-02 03:04:00",
        "20240102": "2024-01-02 00:00:00",
        "1/2/2024": "2024-01-02 00:00:00",
        "2024年1月2日": "2024-01-02 00:00:00",
        "2 Jan 2024": "2024-01-02 00:00:00",
        "yesterday": None,
        "": None,
        "12": None,
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    parsed = rows.orderBy("i").select(F.date_format(clock.parse_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("p"))
    assert [r["p"] for r in parsed.collect()] == list(cases.values())


def test_strict_parse_fails_on_bad_text_only(spark):
    good = spark.createDataFrame([("2024-01-02",), (None,)], "t string")
    assert [r["p"] is None for r in good.select(clock.parse_time_strict(F.col("t")).alias("p")).collect()] == [False, True]
    bad = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception):
        bad.select(clock.parse_time_strict(F.col("t"))).collect()


@pytest.mark.parametrize(
    "when, expected",
    [
        ("2024-01-06 22:00:00", (22, 5, 1, 0, 1)),
        ("2024-01-01 17:59:00", (17, 0, 0, 1, 0)),
        ("2024-01-07 06:00:00", (6, 6, 1, 0, 0)),
        ("2024-01-03 05:59:59", (5, 2, 0, 0, 1)),
        ("2024-01-03 09:00:00", (9, 2, 0, 1, 0)),
        (None, (None, None, 0, 0, 0)),
    ],
)
def test_calendar(spark, when, expected):
    ts = F.lit(when).cast("timestamp")
    row = spark.range(1).select(clock.hour(ts), clock.day_of_week(ts), clock.is_weekend(ts), clock.is_work_time(ts), clock.is_night(ts))
    assert tuple(row.first()) == expected


def test_days_between(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(start, start), (start, start + datetime.timedelta(hours=12)), (start, None)], "a timestamp, b timestamp")
    assert [r["d"] for r in rows.select(clock.days_between(F.col("a"), F.col("b")).alias("d")).collect()] == [1 / 24, 0.5, None]
