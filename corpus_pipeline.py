"""Documents to training tokens in five stages, each written and read back before the next.

Every stage takes (spark, docs, sf_dir) and looks at all rows its predecessor kept; all but the last return the
columns of ``documents``. Null and empty texts leave in the first stage, as they hold no letter. An empty table
passes through all stages. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.llm import bpe, jaccard, langid, lines, mixing
from msgloom.staging import Staging


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language learned from the labelled ones; the others go."""
    found = langid.identify(spark, docs, langid.trained_on(docs), Staging(spark)).where("accepted")
    return found.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of 40 code points or more that five documents hold, but for the last of these."""
    kept = lines.dedup_lines(docs, Staging(spark))
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % common shingles of five words: the smallest id."""
    return jaccard.keep_one(docs, Staging(spark), size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs, Staging(spark))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with packed token ids, their number, and whether they decode to its text.

    Columns of the documents that are called like one of these give way to them.
    """
    both = bpe.round_trip(docs.select(F.struct("*").alias("row"), "text"), bpe.public_vocabulary())
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    number = (F.length("token_ids") / 4).cast("long")
    made = {"token_ids": F.col("token_ids"), "n_tokens": number, "round_trip": same}
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in made]
    return both.select(*kept, *(column.alias(name) for name, column in made.items()))


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("source_mix", source_mix),
    ("bpe", tokens),
]

ORACLE_SQL = None  # a language model and a tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    staging = Staging(spark)
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return docs
