import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgloom.llm import langid, quality

SMALL = "/root/testdata/sf0.01"


def kneser_ney(counts, gram):
    """Probability of the last symbol by the textbook recursion, on counts {4-tuple: n}."""
    def level(n):
        if n == 4:
            return counts
        lower = {}
        for g in level(n + 1):
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        return lower

    def probability(g):
        if not g:
            return 1 / 65536
        table = level(len(g))
        ones, twos = (sum(v == k for v in table.values()) for k in (1, 2))
        discount = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        total = sum(v for k, v in table.items() if k[:-1] == g[:-1])
        types = sum(k[:-1] == g[:-1] for k in table)
        if not total:
            return probability(g[1:])
        return max(table.get(g, 0) - discount, 0) / total + discount * types / total * probability(g[1:])

    return probability(gram)


def packed(gram):
    return sum(ord(c) << 16 * (3 - i) for i, c in enumerate(gram))


def test_model_against_the_textbook():
    rng = random.Random(3)
    counts = {}
    for _ in range(400):
        gram = tuple(rng.choice("aab c") for _ in range(4))
        counts[gram] = counts.get(gram, 0) + 1
    model = langid.KneserNey(np.array([packed(g) for g in counts], np.uint64), np.array(list(counts.values())))
    asked = [tuple(rng.choice("abcd ") for _ in range(4)) for _ in range(300)]
    found = model.probabilities(np.array([packed(g) for g in asked], np.uint64))
    assert found == pytest.approx([kneser_ney(counts, g) for g in asked])
    everything = model.probabilities(np.arange(65536, dtype=np.uint64) + np.uint64(packed(("a", "b", "a", "\0"))))
    assert everything.sum() == pytest.approx(1)


def test_symbols():
    read = lambda t: "".join(chr(s) if s else " " for s in langid.symbols(t).tolist())
    assert read("Ab,  9c\nÉ") == " ab c é "
    assert read("") == read("12 !") == ""
    assert langid.four_grams(langid.symbols("ab")).tolist() == [packed("\0\0\0a"), packed("\0\0ab"), packed("\0ab\0")]


def test_slices_do_not_change_the_sums(monkeypatch):
    texts = ["Ab c" * 200, "", None, "x", "long text " * 90]
    whole = {}
    for size in (1 << 20, 64, 7):
        monkeypatch.setattr(langid, "SLICE", size)
        found = {}
        for rows, grams in langid._slices(enumerate(texts)):
            for r, g in zip(rows.tolist(), grams.tolist()):
                found.setdefault(r, []).append(g)
        whole = whole or found
        assert found == whole


LANGUAGES = {"xa": "kamo lati suro neki ", "xb": "brint stolch grumpf schnad ", "xc": "ouille eauté aîné façon "}


def sentences(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(n))


def identified(spark, staging, docs):
    found = langid.identify(spark, docs, langid.trained_on(docs), staging)
    return found.select("row.doc_id", "row.text", "lang_pred", "score", "accepted").collect()


def test_identify_on_odd_rows(spark, staging, documents):
    rng = random.Random(4)
    rows = [(i, sentences(rng, lang, 3 + i % 40), lang) for i in range(3000) for lang in [["xa", "xb", "xc"][i % 3]]]
    odd = [(7000, None, "xa"), (7001, "", "xb"), (7002, "123 --", "xa"), (7003, "kamo " * 400_000, None), (None, "brint stolch", None),
           (7004, "Привет, как дела, это русский текст о погоде " * 3, None), (5, rows[5][1], "xc"), (7005, "Kamo, LATI suro!", None)]
    found = identified(spark, staging, documents(rows + odd))
    assert len(found) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in found}
    held_out = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 3000 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == ["xa", "xb", "xc"][r["doc_id"] % 3] for r in held_out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert all(r["accepted"] for r in held_out)
    for i in (7000, 7001, 7002):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["accepted"]) == ("und", 0.0, False)
    assert by_id[7003]["lang_pred"] == by_id[7005]["lang_pred"] == "xa"
    assert by_id[7004]["accepted"] is False and by_id[7004]["lang_pred"] in LANGUAGES
    assert by_id[None]["lang_pred"] == "xb"


def test_every_gram_is_in_the_model(spark, staging):
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(3000)] + [chr(0xAC00 + i) for i in range(3000)]
    texts = {"xa": ["".join(rng.choices(letters, k=700)) for _ in range(100)], "xb": [sentences(rng, "xb", 50) for _ in range(20)]}
    docs = spark.createDataFrame([(lang, t) for lang, own in texts.items() for t in own], "lang string, text string")
    models = dict(langid.fit(docs, staging).models())
    assert list(models) == ["xa", "xb"]
    for lang, own in texts.items():
        grams, counts = np.unique(np.concatenate([langid.four_grams(langid.symbols(t)) for t in own]), return_counts=True)
        whole = langid.KneserNey(grams, counts)
        if lang == "xa":
            assert len(grams) > 50_000
        for (keys, full, contexts, left), want in zip(models[lang].levels, whole.levels):
            assert (keys == want[0]).all() and (contexts == want[2]).all()
            assert full == pytest.approx(want[1]) and left == pytest.approx(want[3])
        asked = np.concatenate([grams[:2000], grams[:2000] ^ np.uint64(1), rng.choices(range(1 << 60), k=50)]).astype(np.uint64)
        assert models[lang].probabilities(asked) == pytest.approx(whole.probabilities(asked))


def test_identify_without_anything_to_learn(spark, staging, documents):
    assert identified(spark, staging, documents([])) == []
    found = identified(spark, staging, documents([(1, "abc"), (2, None)]))
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in found} == {("und", 0.0, False)}


def test_language_query_on_held_out_documents(spark):
    found = langid.op4_language_id(spark, SMALL)
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    held = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert held[0] > 0.97 and held[1] > 0.97
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == truth.count()


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    good = labels == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_query_on_held_out_documents(spark):
    found = quality.op5_quality(spark, SMALL)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.9
    assert ((rows["score"] >= 0.5).astype(int) == rows["predicted"]).all() and rows["score"].between(0, 1).all()


def labelled(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, label int")


def test_quality_on_odd_rows(spark, staging, documents):
    rng = random.Random(6)
    rows = [(i, sentences(rng, "xa", 60) if i % 2 else "!!! %% " * 40 + str(i)) for i in range(400)]
    odd = [(1000, None), (1001, ""), (1002, "x" * 3_000_000), (None, "kamo"), (7, "%%% !!!")]
    docs = documents(rows + odd).select("doc_id", "text")
    labels = labelled(spark, *((i, i % 2) for i in range(400)), (1000, 1), (5000, 0), (None, 1), (3, None), (4, 9))
    model = quality.fit(docs, labels, staging)
    scored = {(r["doc_id"], r["text"]): r["s"] for r in docs.withColumn("s", quality.score(F.col("text"), model)).collect()}
    assert len(scored) == len(rows) + len(odd)
    assert all(0 <= s <= 1 for s in scored.values())
    assert scored[1000, None] == scored[1001, ""] == pytest.approx(1 / (1 + math.exp(-model.intercept)))
    assert np.mean([(s >= 0.5) == bool(i % 2) for (i, t), s in scored.items() if i is not None and i < 400 and i != 7]) > 0.95


def test_quality_with_one_label_or_none(spark, staging, documents):
    docs = documents([(i, f"text {i}") for i in range(10)]).select("doc_id", "text")
    share = lambda labels: docs.select(quality.score(F.col("text"), quality.fit(docs, labels, staging)).alias("s")).distinct().collect()
    assert [r["s"] for r in share(labelled(spark))] == pytest.approx([0.5])
    assert [r["s"] for r in share(labelled(spark, *((i, 1) for i in range(5))))] == pytest.approx([1.0], abs=1e-5)
    assert quality.fit(documents([]).select("doc_id", "text"), labelled(spark, (1, 1), (2, 0)), staging).slope == 0.0
