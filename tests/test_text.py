import random

import pytest
from pyspark.sql import functions as F

from msgloom.functions import identity, text


def values(spark, expression, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, m string")
    return [r["x"] for r in rows.select("i", expression(F.col("m")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "expression, cases",
    [
        (text.message_length, {"": 0, "你好a": 3, "😀b": 2}),
        (text.word_count, {"a b  c": 3, "": 0, "  ": 0, "你好\u3000吗": 2, "a\x1cb": 2}),
        (text.digit_count, {"a1b22": 3, "５５": 2, "": 0}),
        (text.punctuation_count, {'"a"': 2, "'a'": 0, "a,b.": 0, "，。": 2, "“a”": 0}),
        (
            text.amount_count,
            {"pay 5元 and 3.5万": 2, "code 1234": 1, "code 1234\n": 1, "1234 x": 0, "10 USD 10 usd": 1, "５元": 1, "10$": 0, "7千": 1},
        ),
        (lambda m: text.amount_count(m, escaped_dollar=True), {"10$": 1, "code 1234": 0}),
        (lambda m: text.keyword_count(m, ["a1", "b1"]), {"a1 a1": 1, "a1b1": 2, "A1": 0}),
        (text.slash_count, {"http://a/b": 3, "": 0}),
        (text.url_count, {"http://a https://b": 2, ":/": 0}),
    ],
)
def test_counts(spark, expression, cases):
    assert values(spark, expression, list(cases)) == list(cases.values())
    assert values(spark, expression, [None]) == [None]


def test_matching_ignores_case_beyond_ascii_and_null_is_false(spark):
    found = values(spark, lambda m: text.matches_any(m, ["É.é", "", None]), ["xéaÉ", "ea", None])
    assert found == [True, False, False]
    assert values(spark, lambda m: text.matches_any(m, []), ["a", None]) == [False, False]
    assert values(spark, text.is_verification, ["您的验证码1", "Verification CODE", "code", None]) == [True, True, False, False]


def test_decrypt(spark):
    rows = spark.createDataFrame([("n9/4pszOf3liR0cPbcZU/g==",)], "enc_id string")
    key, iv = b"0123456789abcdef", b"fedcba9876543210"
    plain = identity.decrypt_id(rows, "enc_id", key, iv)
    assert plain.columns == ["id"] and plain.first()["id"] == "13800001234"
    with pytest.raises(ValueError):
        identity.decrypt_id(rows, "other", key, iv)
    bad = spark.createDataFrame([("AAAA",), ("n9/4pszOf3liR0cPbcZU/g==",)], "enc_id string")
    assert [r["id"] for r in identity.decrypt_id(bad, "enc_id", key, iv, strict=False).collect()] == [None, "13800001234"]
    with pytest.raises(Exception):
        identity.decrypt_id(bad, "enc_id", key, iv).collect()


def test_phone_parts(spark):
    assert values(spark, identity.area_code, ["13812345678"]) == ["1234"]
    assert values(spark, identity.carrier_code, ["13812345678"]) == ["138"]


def test_amounts_in_linear_time_and_as_the_plain_pattern(spark):
    import re
    import time

    start = time.time()
    junk = ["1" * 20_000 + "x", "1 " * 20_000, ("9" * 400 + "a") * 50, "1." * 20_000]
    assert values(spark, text.amount_count, junk)[:2] == [0, 1]
    assert time.time() - start < 5
    rng = random.Random(3)
    some = ["".join(rng.choice(["1", "23", ".", "元", "万", "千", " ", "usd", "rmb", "$", "x", "\n", "５", "￥"]) for _ in range(rng.randrange(14))) for _ in range(3000)]
    assert values(spark, text.amount_count, some) == [len(re.findall(text.AMOUNT_PATTERN, t)) for t in some]
    literal = values(spark, lambda m: text.amount_count(m, escaped_dollar=True), some)
    assert literal == [len(re.findall(text.AMOUNT_PATTERN_LITERAL_DOLLAR, t)) for t in some]


def test_keywords_pass_over_places_where_none_begins(spark):
    """One test per place that no keyword begins at; what equals a letter without regard to case counts as before."""
    assert text.folding_case(["Kis", "9a", "逾期"]).startswith("(?=[9Kk\u212a逾])")
    for open_ended in (["a?b"], ["x", ".b"], ["a|b"], ["a{0}b"], ["\\w"], ["ab", "(c"]):
        assert text.folding_case(open_ended) == "(?iu)" + "|".join(open_ended)
    texts = ["KIS", "\u212ai\u017f", "k\u0130S", "K\u0131s", "xx 9A", "逾期", "ki", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", text.matches_any(F.col("t"), ["Kis", "9a", "逾期"]).alias("new"), F.coalesce(F.col("t").rlike("(?iu)Kis|9a|逾期"), F.lit(False)).alias("plain"))
    assert all(r.new == r.plain for r in found.collect())
