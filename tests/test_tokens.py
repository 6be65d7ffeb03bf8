import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from msgloom.functions import tokens as tk
from msgloom.functions import vectors
from msgloom.operators import tfidf, wordvec
from msgloom.operators.ordering import running_total_before, tokens_before
from msgloom.operators.tokenize import remove_stopwords, tokenize, user_text


def test_segments(spark):
    row = spark.range(1).select(tk.segment(F.lit("Hello, 3.5 World 你好 a.b\u3000x² 12.")).alias("t")).first()
    assert row["t"] == ["Hello", ",", "3.5", "World", "你", "好", "a", ".", "b", "x²", "12", "."]


@pytest.mark.parametrize("token", ["", "12", "1.2.3", ".5", ".", "，。", "!?", "…—", " ", "\t", "\u3000", "５"])
def test_noise(spark, token):
    assert spark.range(1).select(tk.is_noise(F.lit(token))).first()[0] is True


@pytest.mark.parametrize("token", ["a", "1,2", "a1", "贷", "“", "é", "1a"])
def test_not_noise(spark, token):
    assert spark.range(1).select(tk.is_noise(F.lit(token))).first()[0] is False


def test_stopwords_as_list_and_as_table(spark):
    df = spark.createDataFrame([("u", 0, "the cat The . dog"), ("u", 1, "the the"), ("u", 2, None)], "id string, ord long, message string")
    listed = tokenize(df, ["the"])
    assert {r["ord"]: r["tokens"] for r in listed.collect()} == {0: ["cat", "The", "dog"], 1: []}
    table = spark.createDataFrame([("the",)], "word string")
    assert sorted(map(tuple, tokenize(df, table).collect())) == sorted(map(tuple, listed.collect()))
    assert remove_stopwords(listed, table).count() == 2


def test_custom_segmenter(spark):
    df = spark.createDataFrame([("u", 0, "a-b"), ("u", 1, "c")], "id string, ord long, message string")
    split = tk.custom_segmenter(lambda t: t.split("-"))
    assert sorted(r["tokens"] for r in tokenize(df, segmenter=split).collect()) == [["a", "b"], ["c"]]


def random_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(8)}"
        rows.append((user, i * 7, [rng.choice("abcde") for _ in range(rng.choice([0, 0, 1, 1, 2, 5]))]))
    return rows


@pytest.mark.parametrize("k, bits", [(1, 16), (1, 4), (2, 5), (3, 3), (2, 0)])
def test_tokens_before(spark, k, bits):
    rows = [r for r in random_rows() if r[2]]
    df = spark.createDataFrame(rows, "id string, ord long, tokens array<string>").repartition(5)
    ends = df.select("id", "ord", tk.last_tokens(F.col("tokens"), k).alias("tail"))
    found = {(r["id"], r["ord"]): r["before"] for r in tokens_before(ends, "id", "ord", "tail", k, "before", bits).collect()}
    expected, so_far = {}, {}
    for user, order, tokens in rows:
        expected[(user, order)] = so_far.get(user, [])[-k:]
        so_far[user] = so_far.get(user, []) + tokens
    assert found == expected


@pytest.mark.parametrize("ngram_range", [(1, 1), (1, 2), (2, 3), (1, 4)])
def test_user_terms(spark, ngram_range):
    rows = random_rows(2)
    df = spark.createDataFrame(rows, "id string, ord long, tokens array<string>").repartition(3)
    joined = {}
    for user, _, tokens in rows:
        joined.setdefault(user, []).extend(tokens)
    expected = Counter(
        (user, " ".join(t[i : i + n])) for user, t in joined.items() for n in range(ngram_range[0], ngram_range[1] + 1) for i in range(len(t) - n + 1)
    )
    assert Counter((r["id"], r["term"]) for r in tfidf.user_terms(df, ngram_range).collect()) == expected


@pytest.mark.parametrize("bits", [2, 6, 16])
def test_running_total(spark, bits):
    rows = random_rows(4)
    df = spark.createDataFrame(rows, "id string, ord long, tokens array<string>").repartition(3)
    found = {(r["id"], r["ord"]): r["t"] for r in running_total_before(df, "id", "ord", F.size("tokens"), "t", bits).collect()}
    so_far = Counter()
    for user, order, tokens in rows:
        assert found[(user, order)] == so_far[user]
        so_far[user] += len(tokens)


def test_user_text_pieces(spark):
    df = spark.createDataFrame([("u", 3, "d"), ("u", 1, "bb"), ("u", 0, "a"), ("u", 2, ""), ("v", 4, "x"), (None, 5, "y"), ("v", 6, None)], "id string, ord long, message string")
    pieces = sorted(map(tuple, user_text(df).collect()))
    assert pieces == [("u", 0, 0, "a"), ("u", 1, 2, "bb"), ("u", 2, 5, ""), ("u", 3, 6, "d"), ("v", 4, 0, "x")]
    whole = " ".join(p[3] for p in pieces if p[0] == "u")
    assert all(whole[start : start + len(m)] == m for user, _, start, m in pieces if user == "u")


def test_long_runs_of_tokens_neither_recurse_nor_stall(spark):
    for parts in (3_000, 10_000, 100_000):
        row = spark.range(1).select(tk.segment(F.lit("1" + ".1" * parts)).alias("t")).first()
        assert [len(t) for t in row["t"]] == [2 * parts + 1]
    assert spark.range(1).select(tk.is_noise(F.lit("1" + ".1" * 100_000))).first()[0] is True
    assert len(spark.range(1).select(tk.segment(F.lit("ab. " * 50_000)).alias("t")).first()["t"]) == 100_000


def test_tfidf_against_the_formula(spark, staging):
    docs = {"u1": ["a", "b", "a"], "u2": ["b", "c"], "u3": ["b", "a"], "u4": ["zz"], "u5": []}
    df = spark.createDataFrame([(u, 0, t) for u, t in docs.items()], "id string, ord long, tokens array<string>")
    model = tfidf.fit_tfidf(df, staging, max_features=10, ngram_range=(1, 1), min_df=2, max_df=0.5)
    terms = [r["term"] for r in model.vocabulary.orderBy("idx").collect()]
    assert terms == ["a"]  # b is in 3 of 5 users
    model = tfidf.fit_tfidf(df, staging, max_features=2, ngram_range=(1, 1), min_df=1, max_df=1.0)
    assert [r["term"] for r in model.vocabulary.orderBy("idx").collect()] == ["a", "b"]
    model.save(f"{staging.path}/m")
    model = tfidf.TfIdfModel.load(spark, f"{staging.path}/m")
    found = {r["id"]: r["static_vec"] for r in tfidf.tfidf_vectors(df, model).collect()}
    assert found["u4"] == found["u5"] == [0.0, 0.0]
    a, b = (1 + math.log(2)) * (math.log(6 / 3) + 1), math.log(6 / 4) + 1
    assert found["u1"] == pytest.approx([a / math.hypot(a, b), b / math.hypot(a, b)])
    unlimited = tfidf.fit_tfidf(df, staging, max_features=None, ngram_range=[1, 2], min_df=1, max_df=1.0)
    terms = [r["term"] for r in unlimited.vocabulary.orderBy("idx").collect()]
    assert terms == sorted(terms) and unlimited.size == len(terms) == 7


def test_word_vector_mean(spark):
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, x array<double>")
    table = wordvec.WordVectors(words.select("word", vectors.as_vector(F.col("x")).alias("v")), 2)
    rows = [("u", 0, ["a", "a"]), ("u", 1, ["b", "zzz"]), ("v", 2, ["zzz"]), ("w", 3, [])]
    df = spark.createDataFrame(rows, "id string, ord long, tokens array<string>")
    found = {r["id"]: r["static_vec"] for r in wordvec.user_word_vectors(df, table).collect()}
    assert found["u"] == pytest.approx([2 / 3, 1 / 3]) and found["v"] == found["w"] == [0.0, 0.0]


def test_dense_and_flat_vectors(spark):
    entries = F.array(F.struct(F.lit(3).alias("idx"), F.lit(0.5).alias("w")), F.struct(F.lit(0).alias("idx"), F.lit(1.5).alias("w")))
    row = spark.range(1).select(vectors.dense_from_entries(entries, 5).alias("v"), F.array(F.lit(1), F.lit(2)).alias("s"))
    assert row.first()["v"] == [1.5, 0.0, 0.0, 0.5, 0.0]
    flat = vectors.flatten_arrays(row, {"v": 5, "s": 2})
    assert flat.columns == ["v_0", "v_1", "v_2", "v_3", "v_4", "s_0", "s_1"]
    assert vectors.gather_arrays(flat, {"v": "double", "s": "int"}).first() == row.first()


def test_user_text_shows_what_is_made_of_the_text(spark):
    rows = spark.createDataFrame([("u", 1, "ab"), ("u", 2, None), ("u", 3, "c"), ("v", 1, ""), (None, 1, "x")], "id string, ord long, message string")
    found = user_text(rows, F.upper("message").alias("loud"))
    assert found.columns == ["id", "ord", "start", "loud"]
    assert sorted(map(tuple, found.collect())) == [("u", 1, 0, "AB"), ("u", 3, 3, "C"), ("v", 1, 0, "")]
    assert user_text(rows).columns == ["id", "ord", "start", "message"]
