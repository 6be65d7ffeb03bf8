"""Token columns and per-user text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions import tokens as tk
from msgloom.operators.ordering import running_total_before


def tokenize(
    messages: DataFrame,
    stopwords: Iterable[str] | DataFrame = (),
    segmenter: Callable[[Column], Column] = tk.segment,
    lower: bool = False,
    clean: bool = True,
) -> DataFrame:
    """``(id, ord, tokens)`` of every message with an id and a text.

    ``stopwords`` is a list of words, or a table ``(word)`` for lists too long to be part of the
    plan; the table is removed by an anti join.
    """
    words = F.col("message")
    rows = messages.where(F.col("id").isNotNull() & words.isNotNull())
    split = segmenter(F.lower(words) if lower else words)
    listed = not isinstance(stopwords, DataFrame)
    if clean:
        split = tk.drop_noise(split, stopwords if listed else ())
    found = rows.select("id", "ord", split.alias("tokens"))
    return found if listed or not clean else remove_stopwords(found, stopwords)


def clean_tokens(token_rows: DataFrame, stopwords: Iterable[str] | DataFrame = ()) -> DataFrame:
    """Token rows without noise and stopwords."""
    listed = not isinstance(stopwords, DataFrame)
    found = token_rows.select("id", "ord", tk.drop_noise(F.col("tokens"), stopwords if listed else ()).alias("tokens"))
    return found if listed else remove_stopwords(found, stopwords)


def remove_stopwords(token_rows: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop the tokens listed in ``stopwords (word)``; messages left empty stay."""
    each = token_rows.select("id", "ord", F.posexplode("tokens").alias("pos", "word"))
    left = each.join(stopwords, "word", "left_anti")
    # a group is one message
    kept = left.groupBy("id", "ord").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda t: t["word"]).alias("kept")
    )
    nothing = F.array().cast("array<string>")
    return token_rows.select("id", "ord").join(kept, ["id", "ord"], "left").select(
        "id", "ord", F.coalesce("kept", nothing).alias("tokens")
    )


def user_text(messages: DataFrame, shown: Column | str = "message") -> DataFrame:
    """All texts of a user joined by blanks, in order, as the pieces they consist of: ``(id, ord, start, message)``.

    ``start`` is the place of a piece in the user's text, counted in characters from 0. A user's text may be larger
    than a row can be, so it is never put together. Places are worked out on narrow rows; the texts take part
    in one join only. ``shown`` is what is returned in place of the text; a column made from ``message`` that is narrower is
    worked out before that join, so that the texts themselves are not moved.
    """
    rows = messages.where(F.col("id").isNotNull() & F.col("message").isNotNull()).select("id", "ord", "message")
    lengths = rows.select("id", "ord", (F.length("message").cast("long") + 1).alias("length"))
    placed = running_total_before(lengths, "id", "ord", F.col("length"), "start")
    pieces = rows.select("id", "ord", F.struct(shown).alias("piece"))
    return pieces.join(placed.select("id", "ord", "start"), ["id", "ord"]).select("id", "ord", "start", "piece.*")
