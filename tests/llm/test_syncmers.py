import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from msgloom.llm import syncmers
from tests.oracle_check import connect, differences


def plain_print(text, k=5, s=2):
    text = text or ""
    if not text:
        return ""
    symbols = re.findall(r"[0-9a-z]+|[^\x00-\x7F]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    h = []
    for i in range(len(symbols) - s + 1):
        number = zlib.crc32(symbols[i].encode())
        for j in range(1, s):
            number = (number * 31 + zlib.crc32(symbols[i + j].encode())) % 4294967291
        h.append(number)
    out, before = "", 0
    for i in range(len(symbols) - k + 1):
        window = h[i : i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            run = 0
            for d in sorted({*range(0, k - s, s), k - s}):
                run = run * 31 + window[d] % 65521
            out += f"{i - before:X}{run % 65521:04X}"
            before = i
    return out or "s" + hashlib.md5(text.encode()).hexdigest()[:16]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if "s" in a[:1] + b[:1] or not a or not b:
        return 0.0
    x, y = ({("----" + p)[i : i + 9] for i in range(0, len(p), 5)} for p in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def plain_rows(docs):
    """(doc_id, n_chars, edited, fingerprints, likenesses) of documents with distinct ids."""
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    for i, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(i + 1) % len(docs)][1] or ""
        tail = len(text) // 3
        edited = text[: len(text) - tail] + following[:tail]
        a, b, c = plain_print(text), plain_print(edited), plain_print(following)
        yield doc_id, len(text), edited, a, b, plain_likeness(a, b), plain_likeness(a, c)


def some_text(r, n):
    words = ["lorem", "Ipsum", "dolor\n", "sit", "汉字", "𝒳😀", "été", "x"]
    return " ".join(r.choices(words, k=n))


def answers(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=str)


def prints(spark, texts, **shape):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r.i: r.p for r in df.select("i", syncmers.fingerprint(F.col("t"), **shape).alias("p")).collect()}


def test_fingerprint_equals_the_definition(spark):
    r = random.Random(4)
    texts = [None, "", "a", "a" * 19, "a" * 20, "a" * 100, "😀" * 50, "ab" * 300, "\n" * 40] + [some_text(r, n) for n in (*range(2, 30), 100, 3000)]
    found = prints(spark, texts)
    assert found == {i: plain_print(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("k,s", [(8, 3), (12, 1), (17, 2), (20, 19)])
def test_other_shapes(spark, k, s):
    text = some_text(random.Random(3), 200)
    assert prints(spark, [text], k=k, s=s) == {0: plain_print(text, k, s)}


def test_shapes_that_one_digit_cannot_hold(spark):
    with pytest.raises(ValueError):
        prints(spark, ["x"], k=30, s=5)


@pytest.mark.parametrize("groups", [1, 3, 40])
def test_edited_equals_the_definition(spark, staging, documents, groups):
    r = random.Random(groups)
    docs = [(i * 3 - 20, some_text(r, r.randrange(120))) for i in range(60)] + [(500, None), (501, ""), (None, "null id " * 9), (-(2**63), "least"), (2**63 - 1, "most " * 30)]
    docs += [(i, "the same passage in a row of documents " * 5) for i in range(1000, 1010)] + [(2000, some_text(r, 40_000))]
    found = syncmers.edited_by_next(documents(docs).repartition(3), staging, groups=groups)
    assert answers(found) == sorted(plain_rows(docs), key=str)
    assert found.first().row.score == "x"  # clashing names stay in the row


def test_one_document_follows_itself_and_no_document_gives_nothing(documents, staging):
    one = [(7, "one document of more than five words and some more words")]
    assert answers(syncmers.edited_by_next(documents(one), staging)) == list(plain_rows(one))
    assert answers(syncmers.edited_by_next(documents([]), staging)) == []


def test_repeated_rows_follow_each_other(documents, staging):
    text = "a text that stands in many rows of the same table and is long enough"
    docs = [(1, text)] * 50 + [(None, text)] * 30 + [(0, "another text, in one row of the table only")]
    found = syncmers.edited_by_next(documents(docs).repartition(4), staging, groups=6).collect()
    assert len(found) == 81
    # each row of id 1 is followed by one like it, but for the last
    assert sorted(r.near_next for r in found if r.row.doc_id == 1) == [0.0] + [1.0] * 49
    assert sum(r.near_next == 1.0 for r in found if r.row.doc_id is None) == 30  # the last null id is followed by id 1


def test_likeness_follows_the_share_of_common_text(spark):
    r = random.Random(5)
    text = " ".join(f"w{r.randrange(10**6)}" for _ in range(600))
    moved = "something in front " + text[: len(text) // 2] + " and something else behind"
    other = " ".join(f"v{r.randrange(10**6)}" for _ in range(600))
    a, b, c = (F.lit(plain_print(t)) for t in (text, moved, other))
    half, none = spark.range(1).select(syncmers.likeness(a, b), syncmers.likeness(a, c)).first()
    assert 0.6 < half < 0.72 and none < 0.01  # half of one text is two thirds of both


def test_no_python_on_the_main_path(spark, staging, documents):
    plan = syncmers.edited_by_next(documents([(1, "a"), (2, "b")]), staging)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert not differences(spark, connect(sf), sf, "op13", syncmers.op13_fingerprints, syncmers.SQL)
