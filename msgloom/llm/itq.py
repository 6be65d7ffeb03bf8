"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

Equal vectors of one label are one vector with a weight. From a bounded sample, rotations are learned that turn
principal components into balanced binary codes. Each code is cut into substrings, one hash table each; vectors
of one label that agree on a substring meet in a bucket and are compared on their original components. Large
buckets are cut into blocks and the pairs of blocks are compared in tasks of their own, so
that no task holds more than two blocks. A pair that meets in several tables counts in the first; links are counted and
never written out, and each task returns at most one edge per vector for the components.

Rotations are added, and then substrings shortened, until pairs at the threshold made from the sample, apart in any direction
or in that of other vectors, agree on a substring with a probability of ``RECALL``, whatever the length and the mean of the
vectors. Closer pairs agree more surely. Vectors with a strong mean get short keys, so large buckets.

Edge cases: vectors that are null, zero, of another than the commonest length or with null or non-finite
components, rows with a null label and rows with a null id link with nothing. Rows that repeat an id
count as vectors of their own in n_links. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import Staging
from .components import components
from .vectors import hashed, sample_of, usable

SAMPLE = 20_000
CODES = 4  # rotations learned at least
TABLES = 64  # before substrings are shortened
RECALL = 0.999
SUBSTRING = 16  # bits of a table's key
BLOCK = 1024


def learn_rotation(sample: np.ndarray, rng: np.random.Generator, bits: int, rounds: int = 50) -> np.ndarray:
    """Projection to ``bits`` principal components, then the rotation that alternately fits codes to
    rotated data and the rotation to the codes."""
    _, _, axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)
    projection = np.zeros((sample.shape[1], bits))
    projection[:, : min(bits, len(axes))] = axes[:bits].T
    reduced = sample @ projection
    rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        codes = np.where(reduced @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(reduced.T @ codes)
        rotation = left @ right
    return projection @ rotation


def threshold_pairs(sample: np.ndarray, threshold: float, rng: np.random.Generator, most: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the sample and partners at the threshold: first apart in any direction, then in that of another vector."""
    units = sample[rng.integers(0, len(sample), most)]
    pairs = []
    for away in (rng.normal(size=units.shape), sample[rng.integers(0, len(sample), most)]):
        away = away - (away * units).sum(axis=1, keepdims=True) * units
        length = np.linalg.norm(away, axis=1, keepdims=True)
        away = np.where(length > 1e-6, away / np.maximum(length, 1e-6), 0.0)
        partner = threshold * units + math.sqrt(max(0.0, 1 - threshold**2)) * away
        pairs.append(partner / np.maximum(np.linalg.norm(partner, axis=1, keepdims=True), 1e-12))
    return np.vstack([units, units]), np.vstack(pairs)


class Tables:
    """Keys of the multi-index tables of unit vectors."""

    def __init__(self, sample: np.ndarray, codes: int = CODES, substring: int = SUBSTRING, seed: int = 7, threshold: float = 0.98):
        rng = np.random.default_rng(seed)
        self.bits = sample.shape[1]
        self.center = sample.mean(axis=0)
        rotations: list[np.ndarray] = []
        one, other = threshold_pairs(sample, threshold, np.random.default_rng(seed + 1))
        half = len(one) // 2
        for self.width in range(min(substring, self.bits), 0, -1):
            self.per_code = self.bits // self.width
            most = max(codes, TABLES // self.per_code)
            for count in range(codes, most + 1):
                while len(rotations) < count:
                    rotations.append(learn_rotation(sample - self.center, rng, self.bits))
                self.planes = np.hstack(rotations[:count])
                agree = self.keys(one) == self.keys(other)
                found = agree.any(axis=1)
                if min(found[:half].mean(), found[half:].mean()) >= RECALL:
                    return
                chance = min(agree[:half].mean(), agree[half:].mean())
                if 1 - (1 - chance) ** (most * self.per_code) < RECALL - 0.01:
                    break  # no number of rotations will do

    def keys(self, units: np.ndarray) -> np.ndarray:
        """One row per vector, one number per table."""
        on = (units - self.center) @ self.planes >= 0
        codes = on.reshape(len(units), -1, self.bits)[:, :, : self.per_code * self.width]
        parts = codes.reshape(len(units), -1, self.width)
        values = parts @ (1 << np.arange(self.width, dtype=np.int64))
        return values + (np.arange(values.shape[1], dtype=np.int64) << 32)


def units_of(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_list()).astype(np.float64)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _table_rows(distinct: DataFrame, tables: Broadcast) -> DataFrame:
    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "keys": list(tables.value.keys(units_of(batch["v"])))})

    rows = distinct.select("id", "label", "v").mapInPandas(look_up, "id long, label string, keys array<long>")
    return rows.select("id", "label", F.explode("keys").alias("key"))


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        lower = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def _compare(group: pd.DataFrame, tables: Tables, threshold: float) -> pd.DataFrame:
    """Links inside the buckets, or pairs of blocks of buckets, of one task: per vector the weight of its links that
    belong to this table, and an edge to the smallest vector of its component here."""
    group = group.sort_values(["label", "key", "i", "j", "id"], ignore_index=True)
    units, ids, weight = units_of(group["v"]), group["id"].to_numpy(), group["w"].to_numpy()
    keys, sides, key = tables.keys(units), group["block"].to_numpy(), group["key"].to_numpy()
    across = (group["i"] != group["j"]).to_numpy()  # pairs inside one block have a task of their own
    new = (group[["label", "key", "i", "j"]] != group[["label", "key", "i", "j"]].shift()).any(axis=1).to_numpy()
    starts = np.flatnonzero(new)
    out = []
    for start, end in zip(starts, [*starts[1:], len(group)]):
        own = units[start:end]
        linked = own @ own.T >= threshold
        if across[start]:
            linked &= sides[start:end, None] != sides[None, start:end]
        np.fill_diagonal(linked, False)
        any_link = linked.any(axis=1)
        if not any_link.any():
            continue
        root = _roots(linked)
        counted = linked.copy()
        for earlier in keys[start:end].T[: int(key[start]) >> 32]:
            counted &= earlier[:, None] != earlier[None, :]
        here = ids[start:end]
        out.append(pd.DataFrame({"id": here, "links": counted @ weight[start:end], "root": here[root]})[any_link])
    return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")


def near_duplicates(
    spark: SparkSession,
    vectors: DataFrame,
    staging: Staging,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """``row`` with all columns of ``vectors``, and beside it n_links and component (the smallest id
    reachable by links of cosine >= ``threshold`` inside one label)."""
    narrow = vectors.select(id_col, vector_col, F.col(label_col).cast("string").alias("label")).where("label is not null")
    rows = staging.write(hashed(usable(narrow, id_col, vector_col, "label")), "vectors")
    distinct = staging.write(
        rows.groupBy("label", "h", "g").agg(F.min("id").alias("id"), F.count("*").alias("w"), F.first("v").alias("v")), "distinct"
    )
    learned = sample_of(distinct, sample)
    if not len(learned):
        learned = np.ones((1, 1))
    tables = spark.sparkContext.broadcast(Tables(units_of(pd.Series(list(learned))), threshold=threshold))
    keyed = staging.write(_table_rows(distinct, tables), "tables")
    shared = staging.write(
        keyed.groupBy("label", "key").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.expr(f"cast((n + {block - 1}) div {block} as int)")),
        "buckets",
    )
    # a vector goes to every pair of blocks that its block is part of; small buckets share tasks
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    members = keyed.join(shared.drop("n"), ["label", "key"]).withColumn("block", own)
    paired = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    paired = paired.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    small = shared.where("blocks = 1").agg(F.sum("n")).first()[0] or 0
    together = F.pmod(F.xxhash64("label", "key"), F.lit(max(1, small // (4 * block))))
    task = F.when(F.col("blocks") > 1, F.xxhash64("label", "key", "i", "j")).otherwise(together).alias("task")
    paired = paired.select(task, "id", "label", "key", "block", "i", "j")
    groups = paired.join(distinct.select("id", "label", "w", "v"), ["id", "label"])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return _compare(group, tables.value, threshold)

    found = staging.write(
        groups.groupBy("task").applyInPandas(compare, "id long, links long, root long"), "links"
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), staging)
    # ids that stand for several vectors join their classes
    per_class = distinct.select("label", "h", "g", "id", "w").join(links, "id", "left")
    per_class = per_class.join(named, F.col("id") == F.col("node"), "left")
    per_class = staging.write(
        per_class.select("label", "h", "g", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")),
        "classes",
    )
    wide = vectors.select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("long").alias("own"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    taking_part = rows.select("h", "g", "label", "id").distinct().select(F.col("id").alias("own"), "h", "g", "label")
    answered = taking_part.join(per_class, ["label", "h", "g"])
    result = hashed(wide).drop("v").join(answered, ["own", "label", "h", "g"], "left")
    return result.select(
        "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "own").alias("component")
    )


def op7_embedding_dedup(spark, sf_dir):
    """Per vector: vec_id, n_links, component_id, kept."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = near_duplicates(spark, vectors, Staging(spark)).select(F.col("row.vec_id").alias("vec_id"), "n_links", F.col("component").alias("component_id"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = r"""
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(vec_id, r) as (
  select a, a from links union select r.vec_id, l.b from reach r join links l on r.r = l.a
), summed as (
  select e.vec_id, coalesce((select count(*) from links where a = e.vec_id), 0) as n_links,
         coalesce((select min(r) from reach where reach.vec_id = e.vec_id), e.vec_id) as component_id
  from embeddings e
)
select vec_id, n_links, component_id, vec_id = component_id as kept from summed
"""
