"""License scans by diagonal voting.

Every rolling gram of ``GRAM`` words of every document meets the grams of the templates in one join. A hit votes
for the diagonal (place in the document minus place in the template). Votes are bit sets of template places,
combined before the shuffle. Diagonals at most ``slack`` apart, as words left out or put in make
them, merge into one span, which counts if it covers enough of the template within a fitting length.
A diagonal with all votes is the template word for word.

The templates are a fixed list (at most 62 grams each), the only thing broadcast.

Edge cases: null and empty texts have no words and no labels. Documents shorter than a gram match
nothing. Rows of the same id and text get the same result; rows that share an id but not the text are
kept apart. A text that holds a phrase a million times yields a million places, of that document only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import ascii_lower, keyed

GRAM = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# The phrases that count word for word, then well-known sentences of public licenses.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("cc-by-nc", "this work is licensed under the creative commons attribution noncommercial license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per gram: template number, label, base, number of grams, place, words and their hash."""
    rows = []
    for number, template in enumerate(templates):
        words = re.findall(WORD, template.text)
        grams = len(words) - GRAM + 1
        if not 1 <= grams <= 62:
            raise ValueError(f"a template has {GRAM} to {61 + GRAM} words: {template.text[:40]}")
        rows += [(number, template.label, template.base, grams, at, *words[at : at + GRAM]) for at in range(grams)]
    names = ", ".join(f"t{i} string" for i in range(GRAM))
    table = spark.createDataFrame(rows, f"template int, label string, base boolean, grams int, place int, {names}")
    return table.withColumn("h", F.xxhash64(*(f"t{i}" for i in range(GRAM))))


def words_of(text):
    """The words of a text column, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def diagonals(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, th, tg, template, label, base, grams, diagonal, votes): a bit per gram of the template found there."""
    words = keyed(docs, id_col, text_col).select("doc", "th", "tg", words_of(F.col("text")).alias("w")).where(F.size("w") >= GRAM)
    shifted = F.arrays_zip(*(F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(GRAM)))
    grams = (
        words.select("doc", "th", "tg", F.posexplode(shifted).alias("at", "gram"))
        .select("doc", "th", "tg", "at", *(F.col("gram")[f"w{i}"].alias(f"w{i}") for i in range(GRAM)))
        .where(F.col(f"w{GRAM - 1}").isNotNull())
        .withColumn("h", F.xxhash64(*(f"w{i}" for i in range(GRAM))))
    )
    same = [grams.h == templates.h, *(F.col(f"w{i}") == F.col(f"t{i}") for i in range(GRAM))]
    return (
        grams.join(F.broadcast(templates), same)  # a fixed list of a few hundred rows
        .groupBy("doc", "th", "tg", "template", "label", "base", "grams", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.expr("bit_or(shiftleft(1L, place))").alias("votes"))
    )


def spans(found: DataFrame, slack: int = 2, coverage: float = 0.8) -> DataFrame:
    """Merged and verified diagonals: (doc, th, tg, template, label, base, first, last, covered), words from
    ``first`` to before ``last``."""
    near = Window.partitionBy("doc", "th", "tg", "template").orderBy("diagonal")
    low = F.expr("diagonal + cast(log2(votes & -votes) as int)")
    high = F.expr(f"diagonal + length(bin(votes)) - 1 + {GRAM}")
    merged = (
        found.withColumn("new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > slack, F.lit(True)))
        .withColumn("group", F.sum(F.col("new").cast("int")).over(near))
        .groupBy("doc", "th", "tg", "template", "label", "base", "grams", "group")
        .agg(F.min(low).alias("first"), F.max(high).alias("last"), F.bit_or("votes").alias("votes"))
    )
    covered = (F.bit_count("votes") / F.col("grams")).alias("covered")
    fits = (F.col("last") - F.col("first")) <= 2 * (F.col("grams") + GRAM)
    return merged.select("doc", "th", "tg", "template", "label", "base", "first", "last", covered).where((F.col("covered") >= coverage) & fits)


def exact_places(found: DataFrame) -> DataFrame:
    """(doc, th, tg, label, start) of base templates that stand word for word."""
    full = F.expr("votes = shiftleft(1L, grams) - 1")
    return found.where(F.col("base") & full).select("doc", "th", "tg", "label", F.col("diagonal").cast("long").alias("start"))


def _joined(labels):
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def scan(docs: DataFrame, templates: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` with all columns of ``docs``, and beside it n_words, n_base, first_word, last_word, base_labels,
    labels and score (the largest part of a template that a span covers)."""
    found = staging.write(diagonals(docs, templates, id_col, text_col), "votes")
    every = spans(found).select("doc", "th", "tg", "label", "covered", F.lit(None).cast("long").alias("start"))
    every = every.unionByName(exact_places(found).withColumn("covered", F.lit(1.0)))
    per_document = every.groupBy("doc", "th", "tg").agg(
        F.count("start").alias("n_base"),
        F.min("start").alias("first_word"),
        F.max("start").alias("last_word"),
        _joined(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base_labels"),
        _joined(F.col("label")).alias("labels"),
        F.max("covered").alias("score"),
    )
    counted = keyed(docs, id_col, text_col).select(
        "row", "doc", "th", "tg", F.regexp_count(ascii_lower(F.col("text")), F.lit(WORD)).cast("long").alias("n_words")
    )
    return counted.join(per_document, ["doc", "th", "tg"], "left").select(
        "row",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op6_license_scan(spark, sf_dir):
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, template_grams(spark), Staging(spark)).select("row.doc_id", *("n_words n_base first_word last_word base_labels labels score".split()))
