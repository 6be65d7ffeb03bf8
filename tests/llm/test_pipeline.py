"""Every stage on its own input against brute force, then the run as a whole."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_bpe import reference  # noqa: F401
from tests.llm.test_near import brute_jaccard
from tests.llm.test_text_operators import brute_lines, brute_targets

SMALLEST = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """(input rows, output rows) of each stage, written and read back in between."""
    folder, found = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SMALLEST).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = before.collect(), docs.collect(), docs.columns
    return found


def test_stages_and_columns(outputs):
    assert list(outputs) == ["language_id", "line_dedup", "jaccard_join", "source_mix", "bpe"]
    for name in list(outputs)[:-1]:
        assert outputs[name][2] == COLUMNS


def test_language_keeps_rows_as_they_are(outputs):
    before, after, _ = outputs["language_id"]
    assert not Counter(after) - Counter(before)
    assert len(after) >= 0.97 * len(before)


def test_language_rejects_on_little_text_and_in_rare_languages(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet").select(*COLUMNS)
    junk = ["Привет, как дела, это русский текст о погоде " * 3, "Καλημέρα σας, αυτό είναι ένα κείμενο για τον καιρό " * 3, "qxzj wvkq zzxq jjqk xwvz " * 8]
    rare = [(2_000_000 + i, " ".join(("mirë dita shtëpi fjalë gjuhë njerëz " * 3).split()[i % 5 :]), "sq", "rare", 90) for i in range(8)]
    odd = spark.createDataFrame([(1_000_000 + i, t, None, "junk", len(t)) for i, t in enumerate(junk)] + rare, docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.unionAll(odd), SMALLEST).collect()}
    assert not kept & set(range(1_000_000, 1_000_003))
    assert {r[0] for r in rare} <= kept
    assert len(kept) >= 0.97 * docs.count()


def test_lines(outputs):
    before, after, _ = outputs["line_dedup"]
    want = brute_lines([(r["doc_id"], r["text"]) for r in before], 40, 5)
    of = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    assert all(r["text"] == want[r["doc_id"], of[r["doc_id"]]] and r["n_chars"] == len(r["text"]) for r in after)


def test_one_of_each_group(outputs):
    before, after, _ = outputs["jaccard_join"]
    root = brute_jaccard([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert Counter(after) == Counter(r for r in before if root[r["doc_id"]] == r["doc_id"])
    assert len(after) < len(before)


def test_mix(outputs):
    before, after, _ = outputs["source_mix"]
    words = {r["doc_id"]: len(r["text"].split()) for r in before}
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += words[r["doc_id"]]
    target, copies = brute_targets(sizes), Counter(r["doc_id"] for r in after)
    for r in before:
        rate = target[r["source"]] / sizes[r["source"]]
        chance = int(hashlib.md5(f"mix-1:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert copies[r["doc_id"]] == int(rate) + (chance < rate - int(rate))


def test_tokens(outputs, reference):  # noqa: F811
    before, after, columns = outputs["bpe"]
    assert columns == [*COLUMNS, "token_ids", "n_tokens", "round_trip"] and len(after) == len(before)
    for r in after:
        ids = np.frombuffer(r["token_ids"], "<u4").tolist()
        assert ids == reference.encode_ordinary(r["text"]) and r["n_tokens"] == len(ids) and r["round_trip"]


def test_run_gives_the_last_stage(spark, outputs):
    found = corpus_pipeline.run(spark, SMALLEST)
    digest = lambda rows: Counter((r["doc_id"], r["n_tokens"]) for r in rows)
    assert digest(found.collect()) == digest(outputs["bpe"][1])


def test_odd_rows_and_the_empty_table(spark, documents):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "12 34", None, None), (None, "The same words", "en", "a"), (5, "The same words", None, None), (5, "The same words", None, None)]
    docs = documents(rows)
    for frame in (docs, documents([]), docs.where(F.col("doc_id") > 99)):
        out = frame
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, "unused")
        kept = {r["text"] for r in out.collect()}
        assert kept <= {"The same words"}
        assert set(docs.columns) <= set(out.columns)


def test_columns_called_like_results_do_no_harm(spark):
    docs = spark.createDataFrame([(1, "some words", "x", "y", "z")], "doc_id long, text string, token_ids string, n_tokens string, decoded string")
    found = corpus_pipeline.tokens(spark, docs, SMALLEST)
    assert found.columns == ["doc_id", "text", "decoded", "token_ids", "n_tokens", "round_trip"]
    row = found.first()
    assert row.decoded == "z" and row.round_trip and row.n_tokens * 4 == len(row.token_ids)
