"""Message embeddings and their pooling per user."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions import tokens as tk
from msgloom.functions import vectors

# Names known from the start; all but "hashing" wait for an encoder to be registered.
PRETRAINED = ("bge-m3", "qwen3", "bert", "roberta")

Encode = Callable[[list[str]], np.ndarray]
# name -> function(language) that loads a model and returns its encode function
_LOADERS: dict[str, Callable[[str], Encode]] = {}


def register_encoder(name: str, loader: Callable[[str], Encode]) -> None:
    """Make ``name`` available to :func:`embed_messages`; ``loader`` runs once in every task."""
    _LOADERS[name] = loader


def encoder_column(loader: Callable[[str], Encode], language: str, batch_size: int) -> Callable[[Column], Column]:
    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader(language)
        for texts in batches:
            values = texts.fillna("").tolist()
            rows: list[np.ndarray] = []
            for at in range(0, len(values), batch_size):
                rows.extend(np.asarray(model(values[at : at + batch_size]), dtype=np.float32))
            yield pd.Series(rows)

    return encode


def hashing_embeddings(messages: DataFrame, size: int = 64) -> DataFrame:
    """Unit-length token counts in ``size`` hash buckets: deterministic, and without a model."""
    split = messages.withColumn("_tokens", F.coalesce(tk.segment(F.lower("message")), F.array().cast("array<string>")))
    counted = HashingTF(numFeatures=size, inputCol="_tokens", outputCol="_counts").transform(split)
    unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(counted)
    return unit.withColumn("embedding", vectors.as_array(F.col("_unit"))).drop("_tokens", "_counts", "_unit")


def embed_messages(
    messages: DataFrame, method: str, language: str = "cn", batch_size: int = 32, size: int = 64
) -> DataFrame:
    """Add ``embedding``, one vector per message. ``size`` is for the hashing method only."""
    if method in _LOADERS:
        column = encoder_column(_LOADERS[method], language, batch_size)
        return messages.withColumn("embedding", column(F.col("message")))
    if method == "hashing":
        return hashing_embeddings(messages, size)
    if method in PRETRAINED:
        raise ValueError(f"register an encoder for {method!r} first (register_encoder)")
    raise ValueError(f"unsupported embedding method: {method!r}")


_POOLINGS = {"mean": Summarizer.mean, "max": Summarizer.max, "min": Summarizer.min, "sum": Summarizer.sum}


def pool_embeddings(messages: DataFrame, pooling: str = "mean", column: str = "embedding") -> DataFrame:
    """``(id, embedding)``, element-wise per user; an unknown pooling means ``mean``.

    The vectors are summed up before the shuffle. Without an embedding column only the distinct
    ids are returned.
    """
    rows = messages.where(F.col("id").isNotNull())
    if column not in messages.columns:
        return rows.select("id").distinct()
    summarize = _POOLINGS.get(pooling, Summarizer.mean)
    known = rows.where(F.col(column).isNotNull()).select("id", vectors.as_vector(F.col(column)).alias("_v"))
    return known.groupBy("id").agg(vectors.as_array(summarize(F.col("_v"))).alias(column))
