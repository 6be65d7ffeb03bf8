"""Row-level measures and predicates over message text. All of them are built-in expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------
VERIFICATION_PATTERN = "验证码|verification code"
PUNCTUATION_CHARS = '，。！？；："（）【】《》、·…—'
AMOUNT_PATTERN = r"\d+元|\d+\.?\d*万|\d+\.?\d*千|\d+\.?\d*\s?(?:yuan|dollar|usd|rmb|bucks|cny|￥|$)"
AMOUNT_PATTERN_LITERAL_DOLLAR = AMOUNT_PATTERN.replace("|$)", r"|\$)")
# --------------------------------------------------------------------------------------------

# The same pattern for counting in linear time: a run of digits is tried from its first digit only
# and never given back, as no shorter part of it could match where the whole run does not.
_LINEAR_AMOUNT = r"(?<!\d)\d++(?:元|\.?\d*+(?:万|千|\s?(?:yuan|dollar|usd|rmb|bucks|cny|￥|{dollar})))"

# Unicode classes (U) and case folding (iu); d: only \n ends a line, so that `$` means the end
# of the text or the place before a final line feed.
_UNICODE = "(?U)"
_FOLD_CASE = "(?iu)"
_UNICODE_UNIX_LINES = "(?dU)"
# What equals an ASCII letter besides its two cases, when case is folded.
_FOLDED = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def _first_characters(keyword: str) -> str | None:
    """Every character that a match of the regular expression can begin with; None if that is not plain to see."""
    first, second = keyword[0], keyword[1:2]
    if "|" in keyword or second in ("?", "*", "{"):
        return None
    if re.fullmatch("[A-Za-z]", first):
        return first.lower() + first.upper() + _FOLDED.get(first.lower(), "")
    return first if unicodedata.category(first) in ("Lo", "Nd") and first == first.lower() == first.upper() else None


def folding_case(keywords: list[str]) -> str:
    """A pattern that finds any of the regular expressions, ignoring case.

    Where each of them begins with a given character, places with other characters are passed over by one test.
    """
    pattern = _FOLD_CASE + "|".join(keywords)
    begins = [_first_characters(k) for k in keywords]
    if None in begins:
        return pattern
    return f"(?=[{''.join(sorted(set(''.join(begins))))}])(?:{pattern})"


def matches_any(message: Column, keywords: list[str] | None) -> Column:
    """True if any keyword (a regular expression) occurs, ignoring case; null text is false."""
    listed = [str(k) for k in keywords or [] if k]
    if not listed:
        return F.lit(False)
    return F.coalesce(message.rlike(folding_case(listed)), F.lit(False))


def is_verification(message: Column) -> Column:
    return F.coalesce(message.rlike(folding_case(VERIFICATION_PATTERN.split("|"))), F.lit(False))


def message_length(message: Column) -> Column:
    return F.length(message)


def word_count(message: Column) -> Column:
    """Runs of non-blank characters (the ASCII separators 1C-1F count as blank, too)."""
    # visible ASCII is in the class twice: listed, it is recognised much faster
    return F.regexp_count(message, F.lit(_UNICODE + r"[!-~[^\s\x1c-\x1f]]+"))


def digit_count(message: Column) -> Column:
    return F.length(F.regexp_replace(message, r"\P{Nd}+", ""))


def punctuation_count(message: Column) -> Column:
    # ASCII without the double quote goes first, as it is cheap to remove and often most of it
    rest = F.regexp_replace(message, r"[\x00-!#-\x7f]+", "")
    return F.length(rest) - F.length(F.translate(rest, PUNCTUATION_CHARS, ""))


def amount_count(message: Column, escaped_dollar: bool = False) -> Column:
    """Money amounts. As published, the dollar sign in the pattern is an end anchor.

    ``escaped_dollar=True`` counts amounts followed by a real dollar sign instead.
    """
    pattern = _LINEAR_AMOUNT.format(dollar=r"\$" if escaped_dollar else "$")
    return F.regexp_count(message, F.lit(_UNICODE_UNIX_LINES + pattern))


def keyword_count(message: Column, keywords: list[str]) -> Column:
    """How many entries of ``keywords`` occur in the text (each counted once, case-sensitive)."""
    hits = [F.contains(message, F.lit(k)).cast("int") for k in keywords]
    return reduce(lambda a, b: a + b, hits) if hits else F.when(message.isNotNull(), F.lit(0))


def substring_count(message: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a fixed string."""
    removed = F.length(message) - F.length(F.replace(message, F.lit(needle), F.lit("")))
    return (removed / len(needle)).cast("int")


def slash_count(message: Column) -> Column:
    return substring_count(message, "/")


def url_count(message: Column) -> Column:
    return substring_count(message, "://")
