import base64
import hashlib
import random
import time

import numpy as np
import pytest
import tiktoken

from msgloom.llm import bpe

VOCABULARY = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def reference():
    with open(VOCABULARY.path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=ranks, special_tokens={})


CODEC = bpe.Codec(VOCABULARY)


def ids_of(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


ALPHABETS = ["ab", "aeithn ", "aA'sdl tre\n", "éàñß ü", "0123 abc.,;!", " \t\n\r\x0b\x1c\x85\xa0　 a", "😀日本語 the", "".join(map(chr, range(1, 300)))]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_texts(reference, alphabet):
    rng = random.Random(alphabet)
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert ids_of(text) == reference.encode_ordinary(text), repr(text)
        assert bpe.decode_ids(CODEC.encode(text), VOCABULARY) == text.encode()


def test_tokens_side_by_side(reference):
    rng = random.Random(2)
    tokens = bpe.token_bytes(VOCABULARY)
    for _ in range(5000):
        try:
            text = (rng.choice(tokens) + rng.choice(tokens) + rng.choice(tokens)).decode()
        except UnicodeDecodeError:
            continue
        assert ids_of(text) == reference.encode_ordinary(text), repr(text)


def test_white_space_and_letters_as_published(reference):
    for point in [*range(0x500), *range(0x1680, 0x1690), *range(0x2000, 0x2070), *range(0x3000, 0x3010), *range(0x10000, 0x10100)]:
        text = f"a{chr(point)}b 1{chr(point)} {chr(point)}"
        assert ids_of(text) == reference.encode_ordinary(text), hex(point)


def test_long_pieces_take_linear_time():
    for unit in ("a", "th", "ab1"):
        start = time.time()
        short = ids_of(unit * 50_000)
        long = ids_of(unit * 200_000)
        assert time.time() - start < 20
        assert len(long) == pytest.approx(4 * len(short), rel=0.01)


def test_remembered_pieces_do_not_change_ids(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 3)
    own = bpe.Codec(VOCABULARY)
    text = "Therethought inging, unhappily " * 20
    assert np.frombuffer(own.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_dataframe_round_trip(spark, documents, reference):
    texts = [f"many short texts {i}" for i in range(700)] + ["", None, "Hello world", " \n\n x", "é😀", "a b " * 20_000]
    docs = documents(list(enumerate(texts)) + [(2, "Hello world"), (None, "no id")])
    once = bpe.round_trip(docs, VOCABULARY)
    twice = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    assert once.columns == twice.columns == [*docs.columns, "token_ids", "decoded"]
    for frame in (once, twice):
        for r in frame.collect():
            assert np.frombuffer(r["token_ids"], "<u4").tolist() == reference.encode_ordinary(r["text"] or "")
            assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.round_trip(once.select("text", "token_ids"), VOCABULARY).columns == ["text", "token_ids", "decoded"]
    assert bpe.round_trip(documents([]), VOCABULARY).count() == 0


def test_query(spark, tables, documents, reference):
    folder = tables(documents=documents([(1, "Some words"), (2, None)], extra=False))
    found = {r["doc_id"]: r for r in bpe.op2_bpe(spark, folder).collect()}
    ids = reference.encode_ordinary("Some words")
    assert found[1]["n_tokens"] == len(ids)
    assert found[1]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert found[1]["decoded_sha256"] == hashlib.sha256(b"Some words").hexdigest()
    assert found[2]["n_tokens"] == 0 and found[2]["ids_sha256"] == found[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
