"""Tokens and n-grams of a text."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of letters and digits (with decimals), or one Han character, or one other visible sign.
TOKEN_PATTERN = (
    # the ASCII part repeats what the inner class says, for speed; possessive, so that long runs do not recurse
    r"[a-zA-Z0-9[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]]++(?:\.\p{Nd}++)*+"
    r"|\p{IsHan}"
    r"|[^\p{L}\p{M}\p{N}\p{Z}\s]"
)

# --- fixed values ---------------------------------------------------------------------------
NOISE_CHARS = "，。！？；：（）【】《》、·…—" + string.punctuation
# --------------------------------------------------------------------------------------------
_NOISE_CLASS = "".join("\\" + c if c in string.punctuation else c for c in NOISE_CHARS)
NOISE_PATTERN = rf"(?U)^(?:[\s\x1c-\x1f]*|\.*+\p{{Nd}}[\p{{Nd}}.]*+|[{_NOISE_CLASS}]*+)$"


def segment(text: Column) -> Column:
    """Default segmenter: every token of the text, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def custom_segmenter(split: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """Wrap a Python word segmenter as an Arrow-batched column function."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(split(t)))

    return run


def is_noise(token: Column) -> Column:
    """Numbers, pure punctuation and blanks (the empty token included)."""
    # the first test is implied by the second, and settles most tokens quickly
    return ~token.rlike(r"^\p{L}") & token.rlike(NOISE_PATTERN)


def drop_noise(tokens: Column, stopwords: Iterable[str] = ()) -> Column:
    """Tokens without stopwords (exact match), numbers, punctuation and blanks."""
    words = sorted(set(stopwords))

    def keep(token: Column) -> Column:
        return ~is_noise(token) & ~token.isin(words) if words else ~is_noise(token)

    return F.filter(tokens, keep)


def last_tokens(tokens: Column, k: int) -> Column:
    return F.slice(tokens, F.greatest(F.size(tokens) - k + 1, F.lit(1)), k)


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring tokens, joined by a blank."""
    if n == 1:
        return tokens
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    grams = F.slice(tokens, 1, count)
    for shift in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, shift + 1, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def ngrams_in_range(tokens: Column, low: int, high: int) -> Column:
    return F.concat(*[ngrams(tokens, n) for n in range(low, high + 1)])


def border_ngrams(before: Column, after: Column, low: int, high: int) -> Column:
    """The n-grams that start in ``before`` and end in ``after``."""
    spans = [
        ngrams(F.concat(last_tokens(before, n - 1), F.slice(after, 1, n - 1)), n)
        for n in range(max(low, 2), high + 1)
    ]
    return F.concat(*spans)
