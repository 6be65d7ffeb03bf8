"""Quality scores by compression.

Two zstandard dictionaries are built, from text labelled good and from text labelled bad. A text
is compressed with each, in pieces of ``PIECE`` bytes so that the dictionaries and not the text's own repetition decide;
the difference of the two sizes, divided by the text's bytes, is turned into a probability by a
logistic curve fitted on labelled rows that no dictionary has seen.

Fitting uses a bounded sample: of each label the ``sample`` rows with the smallest id hashes (half for the
dictionaries, half for the curve), and of the former at most ``pieces`` pieces. Only those pieces, and one number
per calibration row, reach the driver. Every text is scored whole.

Edge cases: null and empty texts differ by 0 and get the curve's value there. Labels other than 0 and 1,
null labels and labels without a document teach nothing; a row that stands twice counts twice. If one label
has no text, all texts get the share of label 1 among the labelled rows, 0.5 if there are none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import crc_fold

PIECE = 1024
DICTIONARY = 110 << 10
LEVEL = 3
SAMPLE = 4_000
PIECES = 4_000


@dataclass(frozen=True)
class Model:
    """Dictionaries as bytes, and the curve 1 / (1 + exp(-(slope * difference + intercept)))."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; plain content where zstandard has too few samples to train on."""
    size = min(DICTIONARY, max(256, sum(map(len, samples)) // 4))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(content)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)


def difference(text: Column, good: bytes, bad: bytes) -> Column:
    """(size with the bad dictionary - size with the good one) / bytes of the text."""

    @F.pandas_udf("double")
    def differ(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by_good, by_bad = _compressor(good).compress, _compressor(bad).compress

        def of(value: str | None) -> float:
            parts = pieces(value) if value else []
            if not parts:
                return 0.0
            return (sum(len(by_bad(p)) for p in parts) - sum(len(by_good(p)) for p in parts)) / sum(map(len, parts))

        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype=float)

    return differ(text)


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for label, text in zip(batch["label"], batch["text"]):
            parts = pieces(text)
            yield pd.DataFrame({"label": [label] * len(parts), "piece": pd.Series(parts, dtype=object)})


def curve(differences: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic regression, lightly regularised, by Newton steps."""
    scale = max(float(np.abs(differences).mean()), 1e-9)
    x = np.column_stack([differences / scale, np.ones(len(differences))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weights * (p - labels)) + 1e-3 * w
        hessian = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, staging: Staging, sample: int = SAMPLE, most_pieces: int = PIECES) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, label (1 good, 0 bad), whose rows may all be learned from."""
    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chance = F.xxhash64(F.lit("quality"), F.col("doc_id").cast("string"))
    chosen = [known.where(F.col("label") == y).select("doc_id", "label", chance.alias("at")).orderBy("at", "doc_id").limit(sample) for y in (0, 1)]
    # at most 2 * sample rows of three numbers, whatever the size of the tables
    texts = docs.where(F.length("text") > 0).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    texts = staging.write(texts.select("text", "label", "at"), "labelled-sample")
    for_dictionaries = texts.where(F.col("at") % 2 == 0).select("label", "text").mapInPandas(_split, "label int, piece binary")
    content = []
    for label in (1, 0):
        own = for_dictionaries.where(F.col("label") == label).select("piece", F.xxhash64("piece").alias("at"))
        content.append([bytes(r["piece"]) for r in own.orderBy("at", "piece").limit(most_pieces).collect()])
    labelled = sum(totals.values())
    share = totals.get(1, 0) / labelled if labelled else 0.5
    if not all(content):
        return Model(b"", b"", 0.0, _logit(share))
    good, bad = map(dictionary, content)
    held = texts.where(F.col("at") % 2 != 0).select("label", difference(F.col("text"), good, bad).alias("d")).toPandas()
    y, d = held["label"].to_numpy(float), held["d"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return Model(good, bad, 0.0, _logit(share))
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(good, bad, *curve(d, y, weights))


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def score(text: Column, model: Model) -> Column:
    """Probability that a text is good."""
    if model.slope == 0.0:
        return F.lit(1 / (1 + math.exp(-model.intercept)))
    return 1 / (1 + F.exp(-(model.slope * difference(text, model.good, model.bad) + model.intercept)))


def op5_quality(spark, sf_dir):
    """Per document: doc_id, held_out, score, predicted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = labels.where(crc_fold("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("label"))
    scored = docs.select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), score(F.col("text"), fit(docs, learned, Staging(spark))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
