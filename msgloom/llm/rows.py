"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALLEST_ID = -(1 << 63)  # stands for a null document id


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take Spark's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_count(text: Column) -> Column:
    """Number of runs of non-white characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns of ``docs``, so that no helper name can clash), ``doc`` (the id, the
    smallest long if null), ``th`` and ``tg`` (two hashes of the text) and ``text`` (empty if null).

    (doc, th, tg) names a row: rows equal in all three hold the same text and so fare alike.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(SMALLEST_ID)).alias("doc"),
        F.xxhash64(text).alias("th"),
        F.xxhash64(F.lit(1), text).alias("tg"),
        text.alias("text"),
    )


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
