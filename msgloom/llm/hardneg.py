"""Hard-negative mining with a cover tree over norm-augmented candidates.

Components become integers, so scores are exact inner products. Equal vectors of one label are one point that knows its
smallest ids, more of which no answer can hold. A point gets one more component that brings all points of a
length to the same norm; a ball around a center then bounds the inner products inside it from both sides.

The upper levels of the tree are made by Spark: nodes with too many points choose some of them as centers and every point
goes to the nearest, round by round, in slices of bounded size; nodes that cannot be told apart are dealt by hash. What is
left are blocks of bounded size, in which farthest-first centers make the lower levels; every node has the exact
covering radius of its points. Index rows hold their way through the tree, so searching a block rebuilds nothing.

A query is a distinct anchor vector with one or more windows of scores. It first descends in its own block, which
raises the lower ends of its windows to the k-th score found; then only the blocks whose bounds meet a window are visited
(queries and block roots meet in slices as well), and inside a block, level by level, only such nodes. Leaves are
opened best bound first until no window can gain, and every point in them is verified exactly. Positives are one such search, negatives
another, with one window per distinct positive score.

Edge cases: rows with a null id, a null label, or a vector that is null, empty or holds null or non-finite components
take no part; zero vectors do. Vectors of different lengths do not meet. An id is never its own partner, also if it stands in several
rows; such rows are anchors and candidates each, equal ones once. Windows of negative positive scores are empty, of zero
hold zero. Empty tables give empty results. Scores must fit 64 bits; beyond 53 they are added up as integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging

SCALE = 256
BLOCK = 4096  # points in a block at most (but for what hashing deals unevenly)
FAN = 32  # centers that a node of the upper levels chooses at most
SLICE = 20_000  # rows of a node or a side that one task holds
QUERIES = 2048  # queries that visit a block in one task
ROUNDS = 12  # of the upper levels, before what is left is dealt by hash
LEAF = 16
WIDEN = 4  # centers of a level for each of the level above, inside a block
ANY = 1 << 62
POINT = "dim int, node string, p long, label string, ids array<long>, v array<double>, extra double, m2 double"
INDEX = POINT + ", rank int, path array<int>, radius double"
FOUND = "p long, slot long, id long, score long"


def points_of(vectors: DataFrame, staging: Staging, most: int, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> tuple[DataFrame, DataFrame]:
    """Points (dim, label, h, g, p, ids, v, extra, m2) and the rows (id, dim, label, h, g) they stand for."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector_col) > 0) & good).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v")
    )
    rows = rows.withColumns({"dim": F.size("v"), "h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})
    rows = staging.write(rows.groupBy("dim", "label", "h", "g", "id").agg(F.first("v").alias("v")), "rows")
    least = Window.partitionBy("dim", "label", "h", "g").orderBy("id")  # Spark limits it before the shuffle, too
    few = rows.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= most)
    points = few.groupBy("dim", "label", "h", "g").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    points = staging.write(points.withColumn("n2", norm).withColumn("p", F.monotonically_increasing_id()), "distinct")
    longest = staging.write(points.groupBy("dim").agg(F.max("n2").alias("m2")), "norms")
    extra = F.sqrt(F.greatest(F.col("m2") - F.col("n2"), F.lit(0.0)))
    return points.join(longest, "dim").withColumn("extra", extra).drop("n2"), rows.drop("v")


def _matrix(rows: pd.DataFrame, augmented: bool = True) -> np.ndarray:
    v = np.stack(rows["v"].to_list())
    return np.column_stack([v, rows["extra"].to_numpy()]) if augmented else v


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1) - 2 * points @ centers.T
    return np.sqrt(np.maximum(square, 0.0))


def _go_down(points: pd.DataFrame, centers: pd.DataFrame, block: int, deal: bool) -> pd.DataFrame:
    """The points of a slice of a node, at the child whose center is nearest."""
    if not len(points):
        return points
    centers = centers.sort_values("nth")
    there = _matrix(centers)
    if deal or (there == there[0]).all():
        mixed = points["p"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        child = mixed % np.uint64(-(-int(centers["n"].iloc[0]) * 2 // block))
        mark = "="
    else:
        child, mark = _distances(_matrix(points), there).argmin(axis=1), "/"
    parent = points["node"].iloc[0]
    return points.assign(node=[f"{parent}{mark}{number}" for number in child])


def blocks_of(points: DataFrame, staging: Staging, block: int = BLOCK, fan: int = FAN, slice_: int = SLICE, rounds: int = ROUNDS) -> DataFrame:
    """The points with the block (dim, node) that the upper levels of the tree lead them to."""
    names = [part.split()[0] for part in POINT.split(", ")]
    open_, done, turn = points.withColumn("node", F.lit("")).select(*names), None, 0
    while True:
        sized = staging.write(open_.groupBy("dim", "node").agg(F.count("*").alias("n")).where(F.col("n") > block), "large-nodes")
        small = open_.join(sized.drop("n"), ["dim", "node"], "left_anti")
        done = small if done is None else done.unionByName(small)
        if sized.isEmpty():
            return staging.write(done, "blocks")
        large = open_.join(sized, ["dim", "node"])
        some = Window.partitionBy("dim", "node").orderBy(F.xxhash64(F.lit(turn), "p"))
        chosen = large.withColumn("nth", F.row_number().over(some)).where(F.col("nth") <= fan)
        chosen = staging.write(chosen.where(F.col("nth") <= F.ceil(F.col("n") * 2 / block)).select("dim", "node", "nth", "n", "v", "extra"), "centers")
        slices = F.ceil(F.col("n") / slice_).cast("int")
        here = large.withColumn("slice", F.pmod(F.xxhash64("p"), slices).cast("int")).drop("n")
        everywhere = chosen.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        deal = turn >= rounds

        def down(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return _go_down(left, right, block, deal)[names]

        keys = ["dim", "node", "slice"]
        open_ = staging.write(here.groupBy(*keys).cogroup(everywhere.groupBy(*keys)).applyInPandas(down, POINT), "children")
        turn += 1


def farthest_first(points: np.ndarray, most: int) -> list[int]:
    """Up to ``most`` different points, each the farthest from those before it; the first is near the mean."""
    found = [int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    away = ((points - points[found[0]]) ** 2).sum(axis=1)
    while len(found) < most and away.max() > 0:
        found.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[found[-1]]) ** 2).sum(axis=1))
    return found


def build(block: pd.DataFrame) -> pd.DataFrame:
    """Index rows of a block: ``path`` names the center of each level above a point, ``rank`` the center that a point is
    itself (or -1); the root's row has the radius of the block."""
    block = block.sort_values("p", ignore_index=True)
    points = _matrix(block)
    sizes = [1]
    while sizes[-1] * WIDEN * LEAF <= len(points):
        sizes.append(sizes[-1] * WIDEN)
    centers = farthest_first(points, sizes[-1])
    sizes = [s for s in sizes if s <= len(centers)]
    near = _distances(points, points[centers[: sizes[-1]]]).argmin(axis=1)
    near[centers[: sizes[-1]]] = np.arange(sizes[-1])
    levels = [near]
    for wide, narrow in zip(sizes[::-1], sizes[-2::-1]):
        parent = _distances(points[centers[:wide]], points[centers[:narrow]]).argmin(axis=1)
        parent[:narrow] = np.arange(narrow)
        levels.append(parent[levels[-1]])
    rank = np.full(len(points), -1, np.int32)
    rank[centers[: sizes[-1]]] = np.arange(sizes[-1])
    radius = np.full(len(points), np.nan)
    radius[centers[0]] = np.sqrt(((points - points[centers[0]]) ** 2).sum(axis=1).max())
    return block.assign(rank=rank, path=list(np.stack(levels[::-1], axis=1).astype(np.int32)), radius=radius)


def bounds(queries: np.ndarray, m2: float, centers: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with any point within ``radius`` of each (augmented) center."""
    both = (queries**2).sum(axis=1)[:, None] + m2
    away = np.sqrt(np.maximum(both - 2 * queries @ centers[:, :-1].T, 0.0))
    slack = 1e-6 * both + 1  # far above what rounding can do
    return (both - (away + radius) ** 2) / 2 - slack, (both - np.maximum(away - radius, 0.0) ** 2) / 2 + slack


def _meets(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether any window of a query (rows of ``low`` and ``high``) meets the bounds of a node (rows: queries)."""
    out = np.zeros(least.shape, bool)
    for s in range(low.shape[1]):
        out |= (most >= low[:, s, None]) & (least <= high[:, s, None])
    return out


def _windows(queries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the windows as matrices, missing ones never met."""
    width = max(map(len, queries["low"]))
    low, high = np.full((len(queries), width), np.inf), np.full((len(queries), width), -np.inf)
    for i, (a, b) in enumerate(zip(queries["low"], queries["high"])):
        low[i, : len(a)], high[i, : len(b)] = a, b
    return low, high


def exact_scores(v: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued vectors, exact."""
    if len(query) * np.abs(v).max(initial=0) * np.abs(query).max() < 2**53:
        return (v @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in v], np.int64)


class Block:
    """A block's tree, from its index rows."""

    def __init__(self, rows: pd.DataFrame):
        path = np.stack(rows["path"].to_list())
        order = np.lexsort(path.T[::-1])  # nodes of every level are runs of rows
        rows, path = rows.iloc[order], path[order]
        points = _matrix(rows)
        self.v, self.m2 = points[:, :-1], float(rows["m2"].iloc[0])
        self.labels, self.ids = rows["label"].to_numpy(), rows["ids"].to_list()
        self.first_id = np.array([ids[0] for ids in self.ids])
        rank = rows["rank"].to_numpy()
        center_at = np.full(rank.max() + 1, -1)
        center_at[rank[rank >= 0]] = np.flatnonzero(rank >= 0)
        self.levels = []
        for column in path.T:
            starts = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
            centers = points[center_at[column]]
            radius = np.maximum.reduceat(np.sqrt(((points - centers) ** 2).sum(axis=1)), starts)
            parent = np.searchsorted(self.levels[-1][0], starts, "right") - 1 if self.levels else None
            self.levels.append((starts, centers[starts], radius, parent))
        self.ends = np.append(self.levels[-1][0][1:], len(points))

    def search(self, queries: pd.DataFrame, k: int, same_label: bool) -> Iterator[tuple[int, int, int, int]]:
        """(p, slot, id, score) of the ``k`` best ids of every window, and no others."""
        q = np.stack(queries["v"].to_list())
        low, high = _windows(queries)
        alive = None
        for starts, centers, radius, parent in self.levels:
            open_ = np.ones((len(q), 1), bool) if alive is None else alive[:, parent]
            wanted = np.flatnonzero(open_.any(axis=0))
            least, most = np.zeros(open_.shape), np.zeros(open_.shape)
            least[:, wanted], most[:, wanted] = bounds(q, self.m2, centers[wanted], radius[wanted])
            alive = open_ & _meets(least, most, low, high)
        starts = self.levels[-1][0]
        for i, (p, label, slots) in enumerate(zip(queries["p"], queries["label"], queries["slot"])):
            leaves = np.flatnonzero(alive[i])
            leaves = leaves[np.argsort(-most[i, leaves], kind="stable")]
            best: list[list] = [[] for _ in slots]
            floor, take, at = low[i].copy(), 4, 0
            while at < len(leaves):
                if (most[i, leaves[at]] < floor[: len(slots)]).all():
                    break
                ahead, at, take = leaves[at : at + take], at + take, take * 2
                ahead = ahead[_meets(least[i : i + 1, ahead], most[i : i + 1, ahead], floor[None], high[i : i + 1])[0]]
                if not len(ahead):
                    continue
                rows = np.concatenate([np.arange(starts[leaf], self.ends[leaf]) for leaf in ahead])
                rows = rows[(self.labels[rows] == label) == same_label]
                scores = exact_scores(self.v[rows], q[i])
                for s in range(len(slots)):
                    inside = np.flatnonzero((scores >= floor[s]) & (scores <= high[i, s]))
                    inside = inside[np.lexsort((self.first_id[rows[inside]], -scores[inside]))][:k]
                    new = [(-int(scores[j]), id_) for j in inside for id_ in self.ids[rows[j]]]
                    if new:
                        best[s] = sorted(best[s] + new)[:k]
                        if len(best[s]) == k:
                            floor[s] = max(floor[s], -best[s][-1][0])
            for slot, found in zip(slots, best):
                yield from ((p, slot, id_, -score) for score, id_ in found)


def _visit(queries: DataFrame, index: DataFrame, staging: Staging, k: int, same_label: bool, per_task: int) -> DataFrame:
    """The answers of the blocks (dim, node) that the queries name, in tasks of a block and a slice of its queries."""
    visits = staging.write(queries, "visits")
    many = staging.write(visits.groupBy("dim", "node").agg(F.ceil(F.count("*") / per_task).cast("int").alias("slices")), "slices")
    dealt = visits.join(many, ["dim", "node"]).withColumn("slice", F.pmod(F.xxhash64("p"), F.col("slices")).cast("int")).drop("slices")
    copies = index.join(many, ["dim", "node"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(Block(right).search(left, k, same_label)) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=["p", "slot", "id", "score"])

    keys = ["dim", "node", "slice"]
    return staging.write(dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(search, FOUND), "found")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("p", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def descend(queries: DataFrame, index: DataFrame, staging: Staging, k: int, same_label: bool, per_task: int = QUERIES, roots_per_task: int = QUERIES) -> DataFrame:
    """(p, slot, id, score, nth): the ``k`` best of each window of each query (p, dim, node, label, v, m2, slot, low, high)."""
    queries = staging.write(queries, "queries")
    own = _visit(queries, index, staging, k, same_label, per_task)
    # a window with k answers asks for nothing below the last of them
    raised = _best(own, k).where(F.col("nth") == k).groupBy("p").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    known = queries.join(raised, "p", "left").withColumn(
        "low", F.zip_with("slot", "low", lambda s, x: F.greatest(x, F.coalesce(F.try_element_at(F.col("kth"), s), x)))
    )
    known = known.drop("kth")
    roots = index.where("rank = 0").select("dim", F.col("node").alias("root"), "v", "extra", "radius", "m2")
    roots = staging.write(roots, "roots")
    n_roots, n_queries = roots.count(), queries.count()
    chunks, slices = max(1, -(-n_roots // roots_per_task)), max(1, -(-n_queries // per_task))
    here = known.withColumn("slice", F.pmod(F.xxhash64("p"), F.lit(slices))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    there = roots.withColumn("chunk", F.pmod(F.xxhash64("root"), F.lit(chunks)).cast("int")).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def route(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"p": np.empty(0, np.int64), "root": np.empty(0, object)})
        meets = _meets(*bounds(np.stack(left["v"].to_list()), float(right["m2"].iloc[0]), _matrix(right), right["radius"].to_numpy()), *_windows(left))
        meets &= left["node"].to_numpy()[:, None] != right["root"].to_numpy()[None, :]
        i, j = np.nonzero(meets)
        return pd.DataFrame({"p": left["p"].to_numpy()[i], "root": right["root"].to_numpy(object)[j]})

    keys = ["dim", "chunk", "slice"]
    routes = here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(route, "p long, root string")
    further = known.join(staging.write(routes, "routes"), "p").withColumn("node", F.col("root")).drop("root")
    return _best(own.unionByName(_visit(further, index, staging, k, same_label, per_task)), k)


def index_of(points: DataFrame, staging: Staging, block: int = BLOCK, **shape) -> DataFrame:
    """Every point with its block and its way through the block's tree."""
    names = [part.split()[0] for part in INDEX.split(", ")]

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        return build(rows)[names]

    return staging.write(blocks_of(points, staging, block, **shape).groupBy("dim", "node").applyInPandas(built, INDEX), "index")


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    staging: Staging,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    per_task: int = QUERIES,
    **shape,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` holds the ids (column ``id_col``) of the rows of ``vectors`` to mine for. A positive is one of the ``positives`` best
    other rows of the anchor's label; its negatives are the ``negatives`` best rows of other labels that score ``low`` to ``high``
    hundredths of it.
    """
    most = max(positives, negatives) + 1  # one of them may be the anchor itself
    points, rows = points_of(vectors, staging, most, id_col, vector_col, label_col, scale)
    points = staging.write(points, "points")
    index = index_of(points, staging, block, **shape)
    ids = anchors.select(F.col(id_col).cast("long").alias("id")).distinct()
    place = index.select("p", "dim", "node", "v", "m2", F.col("label").alias("of_label"))
    asked = rows.join(ids, "id").join(points.select("p", "dim", "label", "h", "g"), ["dim", "label", "h", "g"]).select("id", "p", "label")
    asked = staging.write(asked, "anchors")
    who = asked.groupBy("p").agg(F.first("label").alias("label")).join(place.drop("of_label"), "p")
    whole = {"slot": F.array(F.lit(0).cast("long")), "low": F.array(F.lit(-ANY)), "high": F.array(F.lit(ANY))}
    near = staging.write(descend(who.withColumns(whole), index, staging, positives + 1, True, per_task).drop("slot", "nth"), "positives")
    slots = near.groupBy("p").agg(F.array_sort(F.collect_set("score")).alias("slot"))
    to_low = F.transform("slot", lambda s: -F.call_function("div", F.lit(-low) * s - F.pmod(F.lit(-low) * s, F.lit(100)), F.lit(100)))
    to_high = F.transform("slot", lambda s: F.call_function("div", F.lit(high) * s - F.pmod(F.lit(high) * s, F.lit(100)), F.lit(100)))
    windows = who.join(slots, "p").withColumns({"low": to_low, "high": to_high})
    hard = descend(windows, index, staging, negatives + 1, False, per_task).select("p", F.col("slot").alias("positive_score"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of_anchor = Window.partitionBy("anchor_id", "p").orderBy(F.desc("positive_score"), "positive_id")
    pairs = asked.select(F.col("id").alias("anchor_id"), "p").join(near.select("p", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "p")
    pairs = pairs.where("anchor_id <> positive_id").withColumn("turn", F.row_number().over(of_anchor)).where(F.col("turn") <= positives)
    of_pair = Window.partitionBy("anchor_id", "p", "turn").orderBy(F.desc("negative_score"), "negative_id")
    mined = pairs.join(hard, ["p", "positive_score"]).where("anchor_id <> negative_id").withColumn("rank", F.row_number().over(of_pair))
    return mined.where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir):
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(vectors, vectors.where("vec_id % 50 = 0"), Staging(spark))


SQL = r"""
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from usable a join usable b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
 and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3
"""
