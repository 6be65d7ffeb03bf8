"""Byte-level BPE encoding and decoding.

A piece of text (one match of the pattern) is its UTF-8 bytes read as Latin-1. One pass of an
Aho-Corasick automaton over the piece gives the longest token that starts at each byte. The
encoder takes longest tokens from the left, checks that each neighbouring pair is one that the merges would
leave apart (the pair checks are memoised), and steps back to the next shorter token where it is not. Every
byte position is given up at most once, so time is linear in the piece. The ids are those of
merging by rank.

Ids travel packed, as little-endian unsigned 32-bit integers in a binary column.

Edge cases: a null text encodes as the empty text, which has no ids. Decoding null ids gives null.
Texts of any length are encoded whole; memory is that of one batch of texts. Extra columns pass through.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REMEMBERED_PIECES = 150_000
REMEMBERED_PAIRS = 150_000
LONGEST_REMEMBERED = 64
AT_ONCE = 256  # texts encoded before their ids are handed on


@dataclass(frozen=True)
class Vocabulary:
    """Where the ranks are (base64 token and rank per line) and how text is split before merging."""

    path: str
    pattern: str


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> Vocabulary:
    """A vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)


def splitters(pattern: str) -> tuple[re.Pattern, regex.Pattern]:
    r"""The pattern for pure ASCII texts and for all others.

    The standard library's matcher is several times faster but knows no \p{L}; for ASCII the classes can
    be written out. The other form spells \s as the White_Space property, as the published pattern means it.
    """
    ascii_form = general = pattern
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        wide = r"\p{White_Space}" if name == r"\s" else name
        members = "".join(re.escape(c) for c in map(chr, range(128)) if regex.match(wide, c))
        if name == r"\s":
            ascii_form = ascii_form.replace(r"\S", f"[^{members}]")
            general = general.replace(r"\S", r"\P{White_Space}")
        ascii_form = re.sub(r"(\[[^]]*)" + re.escape(name), lambda m: m[1] + members, ascii_form)  # in a class
        ascii_form = ascii_form.replace(name, f"[{members}]")
        general = general.replace(name, wide)
    return re.compile(ascii_form), regex.compile(general)


@lru_cache(maxsize=2)
def token_bytes(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of each token; all that decoding needs."""
    ranks = {}
    with open(vocabulary.path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))) or len({t for t in ranks.values() if len(t) == 1}) < 256:
        raise ValueError("ranks must run from 0 without gaps and cover all single bytes")
    return [ranks[i] for i in range(len(ranks))]


def decode_ids(packed: bytes, vocabulary: Vocabulary) -> bytes:
    return b"".join(map(token_bytes(vocabulary).__getitem__, np.frombuffer(packed, "<u4").tolist()))


class PairRules:
    """Which tokens may stand side by side, learned from the ranks alone."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        self.id_of = {token: i for i, token in enumerate(tokens)}
        self.length = [len(t) for t in tokens]
        self.shorter = [self._longest_proper_prefix(t) for t in tokens]
        self.halves: list[tuple[int, int]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[int, bool] = {}
        for i, token in enumerate(tokens):
            self.halves.append(self._last_merge(i, token))

    def _longest_proper_prefix(self, token: str) -> int:
        for end in range(len(token) - 1, 0, -1):
            found = self.id_of.get(token[:end])
            if found is not None:
                return found
        return -1

    def _last_merge(self, i: int, token: str) -> tuple[int, int]:
        """The two tokens whose merge makes token ``i``; ``i`` twice if it is never made by one."""
        left = self.shorter[i]
        while left >= 0:
            right = self.id_of.get(token[self.length[left] :])
            if right is not None and left < i and right < i and self._apart(left, right):
                self.merged[left, right] = i
                return left, right
            left = self.shorter[left]
        return i, i

    def _apart(self, left: int, right: int) -> bool:
        """True if merging the bytes of both by rank keeps the border between them.

        Undo the merges at the border, latest first; the border falls if some pair across it has a
        merge that comes before the next one to be undone.
        """
        earliest = len(self.tokens) + 1
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < earliest:
                return False
            if left > right and self.halves[left][1] != left:
                earliest, left = left, self.halves[left][1]
            elif self.halves[right][0] != right:
                # on a tie the left merge comes first, hence one more
                earliest, right = right + 1, self.halves[right][0]
            elif self.halves[left][1] != left:
                earliest, left = left, self.halves[left][1]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        answer = self.known.get(pair)
        if answer is None:
            if len(self.known) >= REMEMBERED_PAIRS:
                self.known.clear()
            answer = self.known[pair] = self._apart(left, right)
        return answer


class Codec(dict):
    """Maps a piece to its packed ids; pieces not seen before are encoded and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.rules = PairRules([t.decode("latin-1") for t in token_bytes(vocabulary)])
        self.automaton = ahocorasick.Automaton()
        for token, i in self.rules.id_of.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.split_ascii, self.split = (p.findall for p in splitters(vocabulary.pattern))

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def encode_piece(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        rules = self.rules
        whole = rules.id_of.get(text)
        if whole is not None:
            return [whole]
        length, shorter, compatible = rules.length, rules.shorter, rules.compatible
        longest_from = self.automaton.iter_long  # single bytes are tokens, so matches adjoin
        ids: list[int] = []
        position, token = 0, -1
        for end, token in longest_from(text):
            if ids and not compatible(ids[-1], token):
                break
            ids.append(token)
            position = end + 1
        else:
            return ids
        size = len(text)
        given_up = bytearray(size + 1)
        while True:
            end = position + length[token]
            if not given_up[end] and (not ids or compatible(ids[-1], token)):
                ids.append(token)
                if end == size:
                    return ids
                position, token = end, next(longest_from(text, end))[1]
                continue
            token = shorter[token]
            while token < 0:
                given_up[position] = 1
                last = ids.pop()
                position -= length[last]
                token = shorter[last]

    def encode(self, text: str) -> bytes:
        split = self.split_ascii if text.isascii() else self.split
        return b"".join(map(self.__getitem__, split(text)))


def _slices(texts: pd.Series) -> Iterator[list]:
    """A batch in short lists, so that results leave before the next ones are made."""
    for start in range(0, len(texts), AT_ONCE):
        yield texts.iloc[start : start + AT_ONCE].tolist()


def encoded(text: Column, vocabulary: Vocabulary) -> Column:
    """Packed ids of a text column."""

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Codec(vocabulary)  # lives as long as the task: workers are reused for other work
        for texts in batches:
            for some in _slices(texts):
                yield pd.Series([own.encode(t) if t is not None else b"" for t in some], dtype=object)

    return encode(text)


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """Bytes that packed ids stand for."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for packed in batches:
            for some in _slices(packed):
                yield pd.Series([decode_ids(p, vocabulary) if p is not None else None for p in some], dtype=object)

    return decode(ids)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with one more (or replaced) binary column of packed ids."""
    return docs.withColumn(ids_col, encoded(F.col(text_col), vocabulary))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with one more (or replaced) binary column of the bytes behind the ids."""
    return docs.withColumn(bytes_col, decoded(F.col(ids_col), vocabulary))


def round_trip(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "token_ids", bytes_col: str = "decoded"
) -> DataFrame:
    """Both columns at once: ids of the text, and the bytes that these ids decode to. One Python worker per core
    does both, where :func:`encode` and :func:`decode` in a row need two."""

    @F.pandas_udf("ids binary, bytes binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Codec(vocabulary)  # lives as long as the task: workers are reused for other work
        for texts in batches:
            for some in _slices(texts):
                ids = [own.encode(t) if t is not None else b"" for t in some]
                yield pd.DataFrame({"ids": ids, "bytes": [decode_ids(i, vocabulary) for i in ids]}, dtype=object)

    coded = docs.select(F.struct("*").alias("row"), both(F.col(text_col)).alias("coded"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in (ids_col, bytes_col)]
    return coded.select(*kept, F.col("coded.ids").alias(ids_col), F.col("coded.bytes").alias(bytes_col))


def op2_bpe(spark, sf_dir):
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    vocabulary = public_vocabulary()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, vocabulary).select(
        "doc_id",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
