import datetime

import pytest
from pyspark.sql import functions as F

from msgloom.operators import statistics

T0 = datetime.datetime(2024, 1, 1, 10)
SCHEMA = "id string, message string, sign string, ts timestamp"
KEYWORDS = {"loan": ["a"], "risk": ["b"], "promo": ["c"]}


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_single_message_user(spark):
    df = spark.createDataFrame([("13800000001", "hello", "s", T0)], SCHEMA)
    row = statistics.all_statistics(df, KEYWORDS, as_of=F.lit("2024-01-01 10:00:00").cast("timestamp")).first()
    assert row["hour_std"] == row["message_length_std"] == 0
    assert row["message_frequency"] == 24 and row["days_since_last_message"] == 1 / 24
    assert len(row) == 40
    assert len(statistics.all_statistics(df, KEYWORDS, "en").columns) == 38


def test_signatures(spark):
    rows = [("u", "m", s, T0) for s in ("x", "x", None, "y")] + [("none", "m", None, T0)] * 2
    found = by_id(statistics.sign_features(spark.createDataFrame(rows, SCHEMA)))
    assert tuple(found["u"])[1:] == (2, 3, 2 / 3, 0.5)
    assert tuple(found["none"])[1:] == (0, 0, 0, 0)


def test_null_messages_ids_and_times(spark):
    rows = [
        ("u", None, "x", T0),
        ("u", "a/b://", "x", T0 + datetime.timedelta(days=2)),
        ("u", "late", "y", None),
        (None, "m", "x", T0),
        ("undated", "m", "x", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = by_id(statistics.all_statistics(df, KEYWORDS, as_of=F.lit("2024-01-04 10:00:00").cast("timestamp")))
    assert set(found) == {"u"}
    u = found["u"]
    assert (u["message_count"], u["sign_unique_count"], u["total_messages"]) == (1, 1, 2)
    assert (u["slash_count"], u["url_count"], u["message_length_mean"]) == (3, 1, 6)
    assert (u["message_frequency"], u["days_since_last_message"]) == (0.5, 1)
    assert (u["loan_keyword_count_sum"], u["loan_keyword_count_mean"]) == (1, 1)
    assert (u["carrier_user_count"], u["carrier_message_count"]) == (1, 1)


def test_against_pandas_for_any_partitioning(spark):
    import random

    rng = random.Random(3)
    rows = [
        (
            f"13{rng.randrange(3)}{rng.randrange(9):08d}",
            "x" * rng.randrange(5) + " 1元",
            rng.choice(["s1", "s2", None]),
            T0 + datetime.timedelta(minutes=rng.randrange(20000)),
        )
        for _ in range(400)
    ]
    pdf = __import__("pandas").DataFrame(rows, columns=["id", "message", "sign", "ts"])
    hours, lengths = pdf.ts.dt.hour, pdf.message.str.len()
    expected_std = hours.groupby(pdf.id).std().fillna(0)
    expected_len = lengths.groupby(pdf.id).std().fillna(0)
    results = []
    for partitions in (1, 7):
        found = by_id(statistics.all_statistics(spark.createDataFrame(rows, SCHEMA).repartition(partitions), KEYWORDS, as_of=F.lit("2025-01-01").cast("timestamp")))
        results.append(found)
        for user, row in found.items():
            assert row["hour_std"] == pytest.approx(expected_std[user], abs=1e-9)
            assert row["message_length_std"] == pytest.approx(expected_len[user], abs=1e-9)
            assert row["hour_nunique"] == hours[pdf.id == user].nunique()
            assert 0 <= row["dominant_sign_ratio"] <= 1
    assert results[0] == results[1]


def test_families_equal_the_merged_pass(spark, staging):
    rows = [("13800000001", "a b", "x", T0), ("13800000001", "c", None, T0), ("13900000002", "d", "y", T0)]
    df = spark.createDataFrame(rows, SCHEMA)
    as_of = F.lit("2024-02-01").cast("timestamp")
    merged = by_id(statistics.all_statistics(df, KEYWORDS, "cn", as_of, staging))
    parts = [
        statistics.time_features(df), statistics.content_features(df, KEYWORDS), statistics.sign_features(df),
        statistics.area_features(df, staging), statistics.distribution_features(df, as_of),
    ]
    for part in map(by_id, parts):
        for user, row in part.items():
            assert row.asDict() == {k: merged[user][k] for k in row.asDict()}
