import datetime
import random

import pytest
from pyspark.sql import functions as F

from msgloom.operators import filters, statistics
from msgloom.operators.incremental import DistinctRows, IncrementalStatistics

T0 = datetime.datetime(2024, 1, 1, 10)
SCHEMA = "id string, message string, sign string, ts timestamp"
KEYWORDS = {"loan": ["a"], "risk": ["b"], "promo": ["c"]}


def as_of():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def batches(seed, n=4, rows=120):
    r = random.Random(seed)
    users = [None] + [f"1{r.randrange(10**10):010d}" for _ in range(40)]
    row = lambda: (
        r.choice(users),
        r.choice([None, "abc 5元 http://x", "word, word", "", "b/b 3.5万"]),
        r.choice([None, "s", "t", "u"]),
        r.choice([None] + [T0 + datetime.timedelta(hours=r.randrange(900)) for _ in range(9)]),
    )
    return [[row() for _ in range(rows)] for _ in range(n)]


def figures(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_batches_give_what_one_run_gives(spark, staging, tmp_path):
    parts = batches(1)
    store = IncrementalStatistics(spark, f"{tmp_path}/store", KEYWORDS, buckets=5)
    for i, rows in enumerate(parts):
        assert store.commit(f"b{i}", spark.createDataFrame(rows, SCHEMA), staging)
        whole = spark.createDataFrame(sum(parts[: i + 1], []), SCHEMA)
        expected = statistics.all_statistics(whole, KEYWORDS, as_of=as_of(), staging=staging)
        found = store.statistics(staging, as_of())
        assert found.columns == expected.columns and figures(found) == figures(expected)
    again = IncrementalStatistics(spark, f"{tmp_path}/store", KEYWORDS)
    assert not again.commit("b2", spark.createDataFrame(parts[2], SCHEMA).repartition(3), staging)
    assert again.table.buckets == 5 and figures(again.statistics(staging, as_of())) == figures(expected)
    with pytest.raises(ValueError, match="other rows"):
        again.commit("b2", spark.createDataFrame(parts[1], SCHEMA), staging)
    assert again.table.vacuum() > 0
    assert figures(again.statistics(staging, as_of())) == figures(expected)


def test_a_commit_that_is_cut_off_leaves_the_old_state(spark, staging, tmp_path, monkeypatch):
    first, second = (spark.createDataFrame(rows, SCHEMA) for rows in batches(2, 2))
    store = IncrementalStatistics(spark, f"{tmp_path}/store", KEYWORDS, buckets=3)
    store.commit("first", first, staging)
    before = figures(store.parts())
    with monkeypatch.context() as patch:
        patch.setattr(store.table, "_publish", lambda manifest: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.commit("second", second, staging)
    assert figures(store.parts()) == before
    assert store.commit("second", second, staging) and figures(store.parts()) != before
    both = IncrementalStatistics(spark, f"{tmp_path}/other", KEYWORDS)
    both.commit("all", first.unionAll(second), staging)
    assert figures(both.parts()) == figures(store.parts())


def test_a_batch_touches_the_buckets_of_its_users_only(spark, staging, tmp_path):
    store = IncrementalStatistics(spark, f"{tmp_path}/store", KEYWORDS, buckets=16)
    store.commit("many", spark.createDataFrame(batches(3, 1, 400)[0], SCHEMA), staging)
    before = store.table.manifest()["folders"]
    store.commit("one", spark.createDataFrame([("13800000001", "abc", "s", T0)], SCHEMA), staging)
    after = store.table.manifest()["folders"]
    assert sum(after[b] != before.get(b) for b in after) == 1
    assert store.commit("none", spark.createDataFrame([], SCHEMA), staging)
    assert store.table.manifest()["folders"] == after and "none" in store.table.manifest()["batches"]
    with pytest.raises(RuntimeError, match="came first"):
        store.table._publish({"version": 3})


def test_distinct_rows_over_batches(spark, staging, tmp_path):
    r = random.Random(4)
    schema = "a string, b string, row_no long"
    rows = [(r.choice([None, "x", "y", "z"]), r.choice([None, "x", str(r.randrange(40))]), i) for i in range(600)]
    parts = [rows[i : i + 150] for i in range(0, 600, 150)]
    index = DistinctRows(spark, f"{tmp_path}/index", buckets=7)
    taken = [sorted(map(tuple, index.take(str(i), spark.createDataFrame(p, schema), staging).collect()), key=str) for i, p in enumerate(parts)]
    expected = filters.drop_duplicate_rows(spark.createDataFrame(rows, schema)).select("a", "b", "row_no").collect()
    assert sorted(sum(taken, []), key=str) == sorted(map(tuple, expected), key=str)
    assert taken[3] and len(taken[3]) < len(set((a, b) for a, b, _ in parts[3]))
    # again, also after others: the same rows, and nothing is added
    version = index.table.manifest()["version"]
    for i in (3, 1):
        assert sorted(map(tuple, index.take(str(i), spark.createDataFrame(parts[i], schema), staging).collect()), key=str) == taken[i]
    assert index.table.manifest()["version"] == version
    assert index.take("empty", spark.createDataFrame([], schema), staging).count() == 0


def test_filters_rule_out_what_is_new(spark, staging, tmp_path):
    index = DistinctRows(spark, f"{tmp_path}/index", buckets=32)
    schema = "a string, row_no long"
    index.take("old", spark.createDataFrame([(f"old {i}", i) for i in range(3000)], schema), staging)
    hashes = lambda rows: index._hashed(spark.createDataFrame(rows, schema), ["a"]).select("bucket", "_h", "_g")
    assert index._may_know(hashes([(f"old {i}", i) for i in range(0, 3000, 7)])).count() == 429
    assert index._may_know(hashes([(f"new {i}", i) for i in range(1000)])).count() < 30
