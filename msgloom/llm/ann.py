"""Approximate nearest neighbours on shifted space-filling curves.

Every curve projects the vectors to a few random directions, shifts them at random, and orders
them by their place on a Hilbert curve, ties by id. Spark sorts all curves in one range-partitioned
shuffle; equal stretches of a curve are blocks. A query is compared with the vectors in its own block and the two
next to it on every curve, on the original components; the best of all curves merge.

Vectors are dealt into bands by length, each half as long as the one before, with curves of their own, and every query asks all
bands. For the inner product, the vectors of a band are given one more component that makes all of them equally long (0 for
queries, which count by direction only), so that near means a large inner product. Equal vectors are one vector with its smallest ids, as
many as can be answers, so a vector that a third of the rows hold costs one comparison. Large blocks, and the
queries that meet them, are cut so that no task holds more than ``TASK`` of either.

The share of the data that a query sees is the same at every size (blocks hold at least ``LEAST``
points, so small tables are searched in full). Vectors without structure, whose neighbours are hardly nearer than the
rest, need the default 16 curves of 32 blocks for a recall above 0.95; structured ones do with fewer.

Edge cases: vectors that are null, zero, of another than the commonest length or with null or non-finite components
take no part, nor do rows with a null id. Ties go to the smaller id. A row that is repeated is one candidate. With fewer
candidates than asked for, all are returned. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .vectors import hashed, usable

CURVES = 16
BLOCKS = 32
DIRECTIONS = 6
BITS = 3
SAMPLE = 20_000
LEAST = 256
TASK = 4096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates below 2 ** bits (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= turn
    place = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = place << 1 | (x[i] >> b & 1)
    return place


class Curves:
    """Directions, scales and shifts of all curves, from a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.longest = longest
        wide, asking = self.lengthened(sample), self.lengthened(sample, True)
        self.directions = [np.linalg.qr(rng.normal(size=(wide.shape[1], min(DIRECTIONS, wide.shape[1]))))[0] for _ in range(curves)]
        self.spread = [((wide @ d).mean(axis=0), (wide @ d).std(axis=0) + 1e-12) for d in self.directions]
        # queries are standardised as the directions of the vectors are, whose last component is not 0
        self.asking = [((asking @ d).mean(axis=0), (asking @ d).std(axis=0) + 1e-12) for d in self.directions]
        self.shifts = [rng.random(d.shape[1]) for d in self.directions]

    def lengthened(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        if queries:
            scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
            return np.column_stack([scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros(len(scaled))])
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        return np.column_stack([scaled, rest])

    def places(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """One row per vector, one place per curve."""
        wide = self.lengthened(vectors, queries)
        out = []
        for directions, (mean, deviation), shift in zip(self.directions, self.asking if queries else self.spread, self.shifts):
            z = (wide @ directions - mean) / deviation
            even = 0.5 + 0.5 * np.tanh(0.7978845608 * (z + 0.044715 * z**3))  # close to the normal distribution's
            cells = ((even + shift) / 2 * (1 << BITS)).astype(np.int64)
            out.append(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS))
        return np.column_stack(out)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _points(distinct: DataFrame, bands: Broadcast, curves: int) -> DataFrame:
    """(curve, place, query, id): every vector on every curve of its band, and once more on all curves if it is a query."""

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, (band, shape) in enumerate(bands.value):
                for query, rows in ((False, batch[batch["band"] == band]), (True, batch[batch["asks"]])):
                    if len(rows):
                        yield pd.DataFrame({"id": rows["id"], "query": query, "at": at, "places": list(shape.places(_matrix(rows["v"]), query))})

    located = distinct.select("id", "v", "asks", "band").mapInPandas(locate, "id long, query boolean, at int, places array<long>")
    placed = located.select("at", F.posexplode("places").alias("nth", "place"), "query", "id")
    return placed.select((F.col("at") * curves + F.col("nth")).alias("curve"), "place", "query", "id")


def _with_blocks(points: DataFrame, staging: Staging, curves: int, blocks: int, least: int, stored: list[int], asking: int) -> DataFrame:
    """Points with the block of their rank on their curve; ``stored`` vectors in each band, and ``asking`` queries in all."""
    bits = 33  # monotonically_increasing_id packs partition and offset so
    ordered = points.orderBy("curve", "place", "id", "query").withColumn("at", F.monotonically_increasing_id())
    packed = staging.write(ordered, "curves")
    part = F.shiftright("at", bits)
    sizes = {r["p"]: r["n"] for r in packed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(sizes):  # as many as there are shuffle partitions
        starts.append((p, total))
        total += sizes[p]
    begins, total = [], 0
    for band, n in enumerate(stored):  # as many as bands times curves
        for curve in range(curves):
            begins.append((band * curves + curve, total, n + asking, max(1, min(blocks, n // least))))
            total += n + asking
    spark = packed.sparkSession
    firsts = spark.createDataFrame(starts, "p long, start long")
    begins = spark.createDataFrame(begins, "curve int, begin long, size long, count long")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << bits) - 1)) - F.col("begin")
    block = F.floor(rank * F.col("count") / F.col("size")).cast("int")
    placed = packed.withColumn("p", part).join(F.broadcast(firsts), "p").join(F.broadcast(begins), "curve")
    return placed.select("curve", "id", "query", block.alias("block"))


def _search(group: pd.DataFrame, most: int) -> pd.DataFrame:
    """The ``most`` largest inner products of each query of one task."""
    asks = group["query"].to_numpy()
    data, queries = group[~asks], group[asks]
    if not len(data) or not len(queries):
        return pd.DataFrame({"asker": [], "id": [], "score": []}).astype({"asker": "int64", "id": "int64", "score": "float64"})
    data = data.sort_values("id")
    matrix, ids = _matrix(data["v"]), data["id"].to_numpy()
    out = []
    for start in range(0, len(queries), 256):
        some = queries.iloc[start : start + 256]
        scores = _matrix(some["v"]) @ matrix.T
        keep = min(most, len(ids))
        least = np.partition(scores, len(ids) - keep, axis=1)[:, [len(ids) - keep]]
        above, level = scores > least, scores == least
        level &= np.cumsum(level, axis=1) <= keep - above.sum(axis=1, keepdims=True)  # the smallest ids
        best = np.nonzero(above | level)[1].reshape(len(some), keep)
        out.append(
            pd.DataFrame(
                {
                    "asker": np.repeat(some["id"].to_numpy(), keep),
                    "id": ids[best].ravel(),
                    "score": np.take_along_axis(scores, best, 1).ravel(),
                }
            )
        )
    return pd.concat(out)


def _length(v: str) -> Column:
    """Of vectors with a component that is not 0; squares neither overflow nor vanish."""
    most = F.array_max(F.transform(v, F.abs))
    return most * F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + (x / most) * (x / most)))


def inner_product(a: str, b: str) -> Column:
    """Summed from the first component on, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def nearest(
    spark: SparkSession,
    vectors: DataFrame,
    asking: Column,
    staging: Staging,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    blocks: int = BLOCKS,
    least: int = LEAST,
    task: int = TASK,
) -> DataFrame:
    """(query_id, rank, id, score): for the rows whose id satisfies ``asking`` (a condition on column ``id``), the ``k``
    vectors of the largest inner product found among all rows but their own."""
    rows = staging.write(hashed(usable(vectors, id_col, vector_col)).withColumn("asks", asking), "vectors")
    per_vector = rows.groupBy("h", "g").agg(F.min("id").alias("first"), F.max("asks").alias("asks"), F.first("v").alias("v"))
    few = rows.select("h", "g", "id").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("h", "g").orderBy("id")))
    few = few.where(F.col("nth") <= k + 1).groupBy("h", "g").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    named = per_vector.withColumnRenamed("first", "id").join(few, ["h", "g"])
    distinct = staging.write(named, "distinct")

    length = _length("v")
    ends = distinct.agg(F.max(length).alias("longest"), F.count_if("asks").alias("asking")).first()
    if ends["longest"] is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    banded = distinct.withColumn("band", F.floor(math.log2(ends["longest"]) - F.log2(length)).cast("int"))
    sizes = {r["band"]: r["n"] for r in banded.groupBy("band").agg(F.count("*").alias("n")).collect()}
    each = max(SAMPLE // len(sizes), LEAST)  # by hash, about so many of each band
    share = F.create_map(*(F.lit(x) for band, n in sizes.items() for x in (band, each / n)))[F.col("band")]
    learned = banded.where(F.abs(F.col("h").cast("double")) / 2.0**63 <= share).select("h", "g", "band", "v").orderBy("h", "g").toPandas()
    shapes = []
    for band in sorted(sizes):
        some = learned[learned["band"] == band]["v"]
        sample = _matrix(some) if len(some) else np.eye(len(distinct.first()["v"])) * ends["longest"] * 2.0**-band
        shapes.append((band, Curves(sample, ends["longest"] * 2.0**-band, curves)))
    points = _points(banded, spark.sparkContext.broadcast(shapes), curves)
    stored = [sizes[band] for band in sorted(sizes)]
    placed = staging.write(_with_blocks(points, staging, curves, blocks, least, stored, ends["asking"]), "blocks")

    # how often each block and what asks it must be cut: at most bands * curves * blocks rows
    data = placed.where("not query").groupBy("curve", "block").agg(F.count("*").alias("n"))
    around = F.explode(F.expr("array(block - 1, block, block + 1)"))
    asked = placed.where("query").withColumn("block", around)
    askers = asked.groupBy("curve", "block").agg(F.count("*").alias("q"))
    cut = lambda c: F.ceil(F.col(c) / task).cast("int")
    cuts = data.join(askers, ["curve", "block"]).select("curve", "block", cut("n").alias("parts"), cut("q").alias("turns"))
    cuts = F.broadcast(staging.write(cuts, "cuts"))
    piece = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = placed.where("not query").join(cuts, ["curve", "block"]).withColumn("part", piece("parts")).withColumn("turn", every("turns"))
    asking_ = asked.join(cuts, ["curve", "block"]).withColumn("turn", piece("turns")).withColumn("part", every("parts"))
    names = ["curve", "block", "part", "turn", "id", "query"]
    meeting = stored.select(names).unionAll(asking_.select(names)).join(distinct.select("id", "v"), "id")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        return _search(group, k + 1)

    found = meeting.groupBy("curve", "block", "part", "turn").applyInPandas(search, "asker long, id long, score double")
    once = found.groupBy("asker", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "id")
    best = staging.write(once.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).select("asker", "id"), "best")

    of_id = distinct.select("id", F.col("v").alias("of_id"), "ids")
    of_asker = distinct.select(F.col("id").alias("asker"), F.col("v").alias("of_asker"))
    scored = best.join(of_id, "id").join(of_asker, "asker").withColumn("score", inner_product("of_asker", "of_id"))
    entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("id")))
    lists = scored.select("asker", entry.alias("entries")).groupBy("asker")
    lists = staging.write(
        lists.agg(F.slice(F.sort_array(F.flatten(F.collect_list("entries"))), 1, k + 1).alias("entries")), "lists"
    )
    who = rows.where("asks").select("h", "g", F.col("id").alias("query_id")).distinct()
    who = who.join(distinct.select("h", "g", F.col("id").alias("asker")), ["h", "g"]).select("query_id", "asker")
    own = who.join(lists, "asker")
    others = F.slice(F.filter("entries", lambda e: e["id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("id"), (-F.col("e.minus")).alias("score")
    )


def op10_nearest_neighbours(spark, sf_dir):
    """Per query (vec_id divisible by 20) and rank: query_id, rank, vec_id, score."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(spark, vectors, F.col("id") % 20 == 0, Staging(spark)).withColumnRenamed("id", "vec_id")
