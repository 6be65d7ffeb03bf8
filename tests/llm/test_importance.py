import hashlib
import math
import random
import re
import zlib

import pytest

from msgloom.llm import importance
from tests.oracle_check import connect, differences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, target, percent=10, min_words=20, runs=1, buckets=10_000):
    """The same by the definition, in one process: rows (doc_id, n_features, weight, score) in the order of ``docs``, and the drawn ids."""

    def features(text):
        words = WORD.findall(lower(text))
        grams = [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]

    of_docs = [features(text) for _, text in docs]
    of_target = [features(text)[1] for text in target]
    s, t = [0] * buckets, [0] * buckets
    for _, found in of_docs:
        for b in found:
            s[b] += 1
    for found in of_target:
        for b in found:
            t[b] += 1
    gains = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows, eligible = [], []
    for (doc_id, text), (words, found) in zip(docs, of_docs):
        weight = sum(gains[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score))
        if words >= min_words:
            eligible.append((-score, doc_id is None, doc_id or 0))
    return rows, sorted(eligible)[: percent * len(eligible) // 100]


def texts(n, seed):
    r = random.Random(seed)
    vocabulary = ["Wort", "word", "слово", "x1", "汉字", "Ärger"] + [f"w{i}" for i in range(200)]
    return [(i, " ".join(r.choices(vocabulary, k=r.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("runs", [1, 3])
def test_equals_the_definition(spark, staging, documents, runs):
    docs = texts(300, 1) + [(301, None), (302, ""), (303, ", . !"), (None, "a b " * 20), (304, "long " * 100_000)]
    aim = ["w1 w2 w3 word word", None, "x1 w7"]
    target = spark.createDataFrame([(t,) for t in aim], "text string")
    found = importance.resample(documents(docs), target, staging, runs=runs).collect()
    rows, drawn = plain(docs, aim, runs=runs)
    assert sorted((r.row.doc_id is None, r.row.doc_id or 0, r.n_features, r.weight, r.score) for r in found) == sorted((i is None, i or 0, *rest) for i, *rest in rows)
    ranked = sorted((r for r in found if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r.score, r.row.doc_id is None, r.row.doc_id or 0) for r in ranked] == drawn
    assert found[0].row.score == "x"  # clashing names stay in the row


def test_repeated_rows_and_null_ids(staging, documents, spark):
    same = "a b c d e f g h i j k l m n o p q r s t u"
    docs = [(5, same)] * 40 + [(None, same)] * 40 + [(i, same) for i in range(100, 120)]
    target = spark.createDataFrame([("a a",)], "text string")
    found = importance.resample(documents(docs), target, staging, percent=50).collect()
    _, drawn = plain(docs, ["a a"], percent=50)
    ranked = sorted((r for r in found if r.rank), key=lambda r: r.rank)
    assert len(found) == 100 and [r.rank for r in ranked] == list(range(1, 51))
    assert [(-r.score, r.row.doc_id is None, r.row.doc_id or 0) for r in ranked] == drawn


def test_empty_tables(spark, staging, documents):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(documents([]), none, staging).count() == 0
    found = importance.resample(documents(texts(30, 2)), none, staging).collect()
    assert len(found) == 30 and sum(r.rank is not None for r in found) == len(plain(texts(30, 2), [])[1])


@pytest.mark.parametrize("pivots", [1, 2, 31])
def test_kth_key_is_exact(spark, pivots):
    r = random.Random(pivots)
    keys = [(r.randrange(5), i) for i in range(60 if pivots == 1 else 700)]
    table = spark.createDataFrame(keys, "a long, row_no long").repartition(3)
    for k in (1, len(keys) // 3, len(keys)):
        assert importance.kth_key(table, k, ["a", "row_no"], "row_no", pivots) == sorted(keys)[k - 1]
    assert importance.kth_key(table, len(keys) + 1, ["a", "row_no"], "row_no", pivots) is None


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert not differences(spark, connect(sf), sf, "op12", importance.op12_importance_resampling, importance.SQL)
