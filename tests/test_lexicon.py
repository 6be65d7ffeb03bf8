import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from msgloom.functions import tokens as tk
from msgloom.operators import lexicon

WORDS = ["还款", "逾期", "优惠", "活动", "人民币", "的", "和", "请", "到账", "信用卡", "𠀀𠀁"]


def corpus(seed, n):
    r = random.Random(seed)
    return ["".join(r.choices(WORDS, k=r.randrange(1, 8))) + r.choice(["，", " abc ", "。"]) + "".join(r.choices(WORDS, k=3)) for _ in range(n)]


def messages(spark, texts):
    return spark.createDataFrame([(str(i % 3), i, t) for i, t in enumerate(texts)], "id string, ord long, message string")


def runs(texts):
    han = lambda c: c in "".join(WORDS)
    return ["".join(g) for t in texts for inside, g in itertools.groupby(t, han) if inside]


def plain_scores(texts, longest=4):
    counts, before, after = Counter(), {}, {}
    for run in runs(texts):
        for n in range(1, longest + 1):
            for i in range(len(run) - n + 1):
                gram = run[i : i + n]
                counts[gram] += 1
                before.setdefault(gram, Counter())[run[i - 1] if i else ""] += 1
                after.setdefault(gram, Counter())[run[i + n] if i + n < len(run) else ""] += 1
    total = sum(n for g, n in counts.items() if len(g) == 1)
    entropy = lambda c: -sum(x / sum(c.values()) * math.log(x / sum(c.values())) for x in c.values())
    out = {}
    for g, n in counts.items():
        cohesion = min((math.log(n * total / (counts[g[:i]] * counts[g[i:]])) for i in range(1, len(g))), default=0.0)
        out[g] = n, cohesion, min(entropy(before[g]), entropy(after[g])), math.log(n / total)
    return out


def best(run, logp, longest=4, unknown=-20.0):
    """All ways to cut a run, scored; ties as in the decoder are left to the caller."""
    if not run:
        return 0.0
    options = []
    for n in range(1, min(longest, len(run)) + 1):
        score = logp.get(run[-n:], unknown if n == 1 else None)
        if score is not None:
            options.append(best(run[:-n], logp, longest, unknown) + score)
    return max(options)


def test_scores_equal_the_definition(spark, staging):
    texts = corpus(1, 120) + ["", "no han at all", "单"]
    texts = [t for t in texts if "单" not in t]
    counts = staging.write(lexicon.substring_counts(messages(spark, texts)), "counts")
    found = {r.gram: (r.n, r.cohesion, r.entropy, r.logp) for r in lexicon.substring_scores(counts).collect()}
    expected = plain_scores(texts)
    assert found.keys() == expected.keys()
    for gram, row in expected.items():
        assert found[gram] == pytest.approx(row, abs=1e-9)


def test_planted_words_are_learned_and_found_again(spark, staging):
    texts = corpus(2, 600)
    words = lexicon.fit_lexicon(messages(spark, texts), staging)
    learned = {r.word for r in words.collect() if len(r.word) > 1}
    assert {"还款", "逾期", "优惠", "活动", "人民币", "到账", "信用卡", "𠀀𠀁"} <= learned
    assert not {"款逾", "民币", "用卡", "的和"} & learned
    found = lexicon.segment_messages(messages(spark, ["请还款信用卡，pay 3.5 now优惠活动"]), words, staging).first()
    assert found.tokens == ["请", "还款", "信用卡", "，", "pay", "3.5", "now", "优惠", "活动"]


def test_decoding_finds_a_best_path(spark, staging):
    r = random.Random(3)
    logp = {"".join(w): -r.random() * 5 * len(w) ** 0.5 for n in (1, 2, 3, 4) for w in itertools.product("天地人", repeat=n) if n == 1 or r.random() < 0.3}
    del logp["人"]
    texts = ["".join(r.choices("天地人", k=n)) for n in range(1, 13) for _ in range(4)]
    table = spark.createDataFrame(list(logp.items()), "word string, logp double")
    decoded = lexicon.segment_runs(spark.createDataFrame([(t,) for t in sorted(set(texts))], "run string"), table).collect()
    assert {row.run for row in decoded} == set(texts)
    for row in decoded:
        assert "".join(row.words) == row.run
        assert sum(logp.get(w, -20.0) for w in row.words) == pytest.approx(best(row.run, logp))


def test_messages_without_the_script_and_without_a_lexicon(spark, staging):
    texts = ["plain words, 3.5 only", "", None, "汉字", "a汉b字"]
    rows = messages(spark, texts)
    none = spark.createDataFrame([], "word string, logp double")
    found = {r.ord: r.tokens for r in lexicon.segment_messages(rows, none, staging).collect()}
    plain = {r.ord: r.tokens for r in rows.where("message is not null").select("ord", tk.segment(F.col("message")).alias("tokens")).collect()}
    assert found == plain  # characters by themselves
    assert lexicon.fit_lexicon(messages(spark, ["none here"]), staging).count() == 0


def test_only_runs_of_the_script_are_written_as_rows(spark, staging):
    """The other pieces stay in the text; messages that share id and ord are put together by place, as a group."""
    rows = messages(spark, ["one 汉字, two three 天 4.5 four", "五 five six", "no run here"])
    lexicon_of = spark.createDataFrame([("汉字", -1.0)], "word string, logp double")
    found = lexicon.segment_messages(rows, lexicon_of, staging)
    assert sorted(r.tokens for r in found.collect()) == [["no", "run", "here"], ["one", "汉字", ",", "two", "three", "天", "4.5", "four"], ["五", "five", "six"]]
    written = spark.read.parquet(f"{staging.path}/pieces-*")
    assert sorted(r.piece for r in written.collect()) == ["五", "天", "汉字"]
    twice = rows.withColumn("ord", F.lit(7)).withColumn("id", F.lit("u")).where(F.col("message").rlike("[汉五]"))
    assert [r.tokens for r in lexicon.segment_messages(twice, lexicon_of, staging).collect()] == [
        ["one", "五", "five", "汉字", ",", "six", "two", "three", "天", "4.5", "four"]
    ]
