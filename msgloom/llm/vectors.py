"""What the two vector operators share: which vectors count, and samples to learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *keep: str) -> DataFrame:
    """(id, v, ``keep``...): ``v`` in double precision, without vectors that are null, empty or zero, or hold
    null or non-finite components, without null ids, and of the commonest length only (ties to the longer)."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    good = vectors.where(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite & F.exists(vector_col, lambda x: x != 0)
    ).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), *keep)
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return good.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def hashed(good: DataFrame) -> DataFrame:
    """With two 64-bit hashes of the vector, equal for equal vectors."""
    return good.withColumn("h", F.xxhash64("v")).withColumn("g", F.xxhash64(F.lit(1), "v"))


def sample_of(distinct: DataFrame, rows: int) -> np.ndarray:
    """At most ``rows`` vectors, those with the smallest hashes, as a matrix."""
    found = distinct.select("h", "v").orderBy("h").limit(rows).toPandas()
    return np.stack(found["v"].to_list()) if len(found) else np.zeros((0, 0))
