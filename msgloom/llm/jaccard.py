"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Documents with equal sets form a class; one of them stands for
it. A set is dealt over chunks by the hashes of its shingles. Similar sets differ in
at most r elements, r following from the size; of more than r chunks, at least one must then hold the same shingles. A
chunk's key is the XOR of their whole hashes, so that unrelated documents do not meet by chance, which a few bits a chunk let them do.

Numbers of chunks belong to size bands (powers of two); a document near the upper end of its band also appears in the
next. Every document publishes its r + 1 fullest chunks, in an order that their contents alone settle: shingles, then hash. Of
a similar pair, the one whose last published chunk comes earlier in that order has an equal chunk among
its own, and the other one publishes it too, so no pair is lost, and chunks with little in them, which
unrelated documents share, stay out.

Documents that share a chunk meet in a bucket, whose center is its smallest document. Buckets are never expanded into all
pairs: each document is verified against the centers it meets most often, and the links give components. Where many members of a bucket
are outside its largest component, rounds follow: the bucket is dealt over slices by a hash that changes from round to round, and each member meets the center
of its slice, so that a round makes a row per member; the likeliest pairs by their sketches, which are finer here, are verified. Rounds go on while they link. Where a bucket
then still holds several components, the members outside its largest one are compared with the members of the others. Pairs inside one component need no
check, as the result is the component. A sketch has a bit for the parity of the shingles that hash to it, so two sketches
differ in at most as many bits as the sets in elements. Every pair first passes the test of its sketches; verification then intersects the shingle sets themselves.

Edge cases: null texts and texts without words have empty sets and link with nothing. With fewer words than a
shingle has, the whole sequence is the one shingle. Rows with the same id are one document, linked to
whatever any of them links to; null ids are one document, smaller than all others. Texts of any length
are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .components import components
from .rows import SMALLEST_ID, WHITE

CENTERS = 3  # that a document is tried against at once; what this leaves open is settled pair by pair
MANY = 64  # members outside a bucket's largest component up to which it goes without rounds
SLICE = 32  # members of a bucket that meet one center in a round, about
USEFUL = 10  # another round follows if the last one made one in so many of all rounds' links
FINER = 8  # times as many bits have sketches of documents in buckets that take part in rounds
MANY_OUTSIDE = f"outside > {MANY}"
PARTS = 4  # that pairs are verified in, one after the other
SLACK = 1.25  # chunks per chunk that must be published
_WHITE = np.zeros(256, bool)
_WHITE[[ord(c) for c in WHITE]] = True


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A fixed random number per byte; A-Z share those of a-z."""
    values = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) if text else np.zeros(0, np.uint8)
    solid = ~_WHITE[data]
    starts = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1]))) if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))), axis=0) if starts[0] == 0 else None
    if place is None:
        data, solid = data[starts[0] :], solid[starts[0] :]
        starts = starts - starts[0]
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    values = np.where(solid, _byte_values()[data] * powers[place], np.uint64(0))
    words = _mixed(np.add.reduceat(values, starts))
    count = max(len(words) - size + 1, 1)
    length = min(size, len(words))
    out = np.full(count, length, np.uint64)
    for i in range(length):
        out = _mixed(out * np.uint64(0xD1342543DE82EF95) + words[i : i + count])
    return np.unique(out)


def most_different(n: int, percent: int) -> int:
    """Elements in which a set of ``n`` can differ from one at least ``percent`` / 100 similar, either way."""
    return n * (100 - percent) // percent


def sketch_keys(found: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the chunks that a set publishes, over its bands."""
    n = len(found)
    need = most_different(n, percent) + 1
    band = n.bit_length()  # sizes from 2 ** (band - 1) to 2 ** band - 1
    bands = [band, band + 1] if 100 * n >= percent << band else [band]
    keys = []
    for own in bands:
        chunks = int(np.ceil(SLACK * (most_different((1 << own) - 1, percent) + 1)))
        content = np.zeros(chunks, np.uint64)
        chunk = ((found >> np.uint64(6)) % np.uint64(chunks)).astype(np.int64)
        np.bitwise_xor.at(content, chunk, found)
        tag = np.uint64(own << 32) + np.arange(1, chunks + 1, dtype=np.uint64)
        key = _mixed(content ^ _mixed(tag))
        held = np.minimum(np.bincount(chunk, minlength=chunks), 127).astype(np.uint64)
        order = held << np.uint64(57) | key >> np.uint64(7)
        keys.append(key[np.argpartition(order, chunks - need)[chunks - need :]] if need < chunks else key)
    return np.concatenate(keys)


def parity_sketch(found: np.ndarray, finer: int = 1) -> np.ndarray:
    """The whole set in half as many bits as the band's sizes (at least 64), or ``finer`` (a power of two) times as many. Folding a sketch, by XOR of its halves,
    gives the sketch of half the width."""
    width = max(64, 1 << (len(found).bit_length() - 1)) * finer
    bit = (found >> np.uint64(8)) & np.uint64(width - 1)
    sketch = np.zeros(width // 64, np.uint64)
    np.bitwise_xor.at(sketch, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return sketch


def _sided(sketch: DataFrame, side: str) -> DataFrame:
    """(doc, n, sketch) as one side of a pair."""
    return sketch.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))


def may_be_similar(percent: int, a: str, n_a: str, b: str, n_b: str) -> Column:
    """False if the sizes or the sketches of two sets already show that they are not similar enough."""
    near = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return near & (_differing(a, b) * (100 + percent) <= (F.col(n_a) + F.col(n_b)) * (100 - percent))


def _differing(a: str, b: str) -> Column:
    """In how many bits two sketches differ, the larger one folded."""
    words = F.least(F.size(a), F.size(b))

    def folded(name: str) -> Column:
        halves = F.zip_with(F.slice(name, 1, words), F.slice(name, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(name) > words, halves).otherwise(F.col(name))

    bits = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc, n, s1, s2, sketch, keys): number of shingles, two hashes of the whole set, its sketch, published chunks.
    ``docs``: doc, text."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc": batch["doc"],
                    "n": [len(s) for s in sets],
                    "s1": [int(_mixed(s).sum(dtype=np.uint64).view(np.int64)) for s in sets],
                    "s2": [int(np.bitwise_xor.reduce(_mixed(s + np.uint64(0x632BE59BD9B4E019))).view(np.int64)) if len(s) else 0 for s in sets],
                    "sketch": [parity_sketch(s).view(np.int64) if len(s) else [] for s in sets],
                    "keys": [sketch_keys(s, percent).view(np.int64) if len(s) else [] for s in sets],
                }
            )

    return docs.select("doc", "text").mapInPandas(sketch, "doc long, n long, s1 long, s2 long, sketch array<long>, keys array<long>")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(doc, shingles) as sorted arrays. ``docs``: doc, text."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc": batch["doc"], "shingles": [shingles(t, size).view(np.int64) for t in batch["text"]]})

    return docs.select("doc", "text").mapInPandas(collect, "doc long, shingles array<long>")


def fine_sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc, n, sketch) with finer sketches. ``docs``: doc, text."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch["text"]]
            fine = [parity_sketch(s, FINER).view(np.int64) if len(s) else [] for s in sets]
            yield pd.DataFrame({"doc": batch["doc"], "n": [len(s) for s in sets], "sketch": fine})

    return docs.select("doc", "text").mapInPandas(sketch, "doc long, n long, sketch array<long>")


class JaccardJoin:
    """Classes and components of documents by the similarity of their shingle sets.

    ``size`` words make a shingle; ``percent`` / 100 is the least similarity of linked sets.
    """

    def __init__(self, docs: DataFrame, staging: Staging, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"):
        self.staging, self.size, self.percent = staging, size, percent
        self.docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(SMALLEST_ID)).alias("doc"), F.col(text_col).alias("text"))

    def result(self) -> DataFrame:
        """(doc, n_shingles, component) per row of the input; ``doc`` is the id, SMALLEST_ID for null."""
        scratch = Staging(self.docs.sparkSession, self.staging.path)
        sketched = scratch.write(sketches(self.docs, self.size, self.percent), "sketches")
        sizes = self.staging.write(sketched.select("doc", "n", "s1", "s2"), "sizes")
        # wide rows move once, copies having been reduced before that
        classes = sketched.where("n > 0").groupBy("s1", "s2").agg(
            F.min("doc").alias("rep"), F.count("*").alias("docs"), *(F.first(c).alias(c) for c in ("n", "sketch", "keys"))
        )
        classes = scratch.write(classes, "classes")
        published = self.staging.write(classes.select(F.col("rep").alias("doc"), "n", "sketch"), "published")
        self.staging.release()
        # Documents with the same id may belong to several classes, so a class hangs on each of its documents.
        several = classes.where("docs > 1").select("s1", "s2", "rep")
        same = self.staging.write(sizes.join(several, ["s1", "s2"]).where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")), "copies")
        members = self._members(classes.select(F.explode("keys").alias("key"), F.col("rep").alias("doc")))
        scratch.drop()
        links = self._links(published, members)
        found = components(links.unionAll(same), self.staging)
        return (
            sizes.select("doc", F.col("n").alias("n_shingles"))
            .join(found, F.col("doc") == F.col("node"), "left")
            .select("doc", "n_shingles", F.coalesce("component", "doc").alias("component"))
        )

    def _members(self, rows: DataFrame) -> DataFrame:
        """(key, doc, center) of the chunks that several documents publish."""
        scratch = Staging(self.docs.sparkSession, self.staging.path)
        shared = rows.groupBy("key").agg(F.min("doc").alias("center"), F.max("doc").alias("last")).where("center < last").drop("last")
        shared = scratch.write(shared, "shared-chunks")
        self.staging.release()
        members = self.staging.write(rows.join(shared, "key"), "members")
        scratch.drop()
        self.staging.release()
        return members

    def _links(self, published: DataFrame, members: DataFrame) -> DataFrame:
        """Verified links (a, b) between representatives that keep every component of all links together."""
        of = {side: _sided(published, side) for side in "ab"}
        met = members.where("doc <> center").select("doc", "center").repartition("doc").groupBy("doc", "center").agg(F.count("*").alias("times"))
        often = Window.partitionBy("doc").orderBy(F.desc("times"), "center")
        stars = met.withColumn("nth", F.row_number().over(often)).where(F.col("nth") <= CENTERS)
        stars = stars.select(F.col("center").alias("a"), F.col("doc").alias("b"))
        stars = stars.join(of["b"], "b").join(of["a"], "a").where(may_be_similar(self.percent, "sketch_a", "n_a", "sketch_b", "n_b"))
        tried = self.staging.write(stars.select("a", "b"), "star-pairs")
        self.staging.release()
        links = self._verified(tried)
        found, split = self._split(members, links)
        number, made, last, fine = 0, 0, 0, None
        while USEFUL * last >= made and not split.where(MANY_OUTSIDE).isEmpty():
            if fine is None:
                fine = self._fine(members, split)
            more = self.staging.write(self._round(members, fine, found, split, number).join(tried, ["a", "b"], "left_anti"), "round-pairs")
            self.staging.release()
            linked = self._verified(more)
            last = linked.count()
            links, tried, number, made = links.unionAll(linked), tried.unionAll(more), number + 1, made + last
            if not last:
                break
            found, split = self._split(members, links)
        rest = self._rest(members, of["b"], fine, found, split).join(tried, ["a", "b"], "left_anti")
        return links.unionAll(self._verified(rest))

    def _split(self, members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(doc, component) by the links so far; (key, bulk, size, outside) of the buckets that hold several
        components: the largest one, and how many members there are in all and outside it."""
        found = components(links, self.staging).withColumnRenamed("node", "doc")
        named = members.join(found, "doc", "left").select("key", F.col("doc").alias("b"), F.coalesce("component", "doc").alias("c_b"))
        parts = named.groupBy("key", "c_b").agg(F.count("*").alias("size"))
        split = parts.groupBy("key").agg(F.max(F.struct("size", "c_b")).alias("most"), F.count("*").alias("parts"), F.sum("size").alias("size"))
        split = split.where("parts > 1").select("key", F.col("most.c_b").alias("bulk"), "size", (F.col("size") - F.col("most.size")).alias("outside"))
        split = self.staging.write(split, "split-buckets")
        self.staging.release()
        return found, split

    def _fine(self, members: DataFrame, split: DataFrame) -> DataFrame:
        """(doc, n, sketch) of the members of buckets that take part in rounds, now and later, as members outside only get fewer."""
        wanted = members.join(split.where(MANY_OUTSIDE).select("key"), "key", "left_semi").select("doc").distinct()
        fine = fine_sketches(self.docs.join(wanted, "doc", "left_semi"), self.size).where("n > 0").distinct()
        return self.staging.write(fine, "fine-sketches")

    def _round(self, members: DataFrame, fine: DataFrame, found: DataFrame, split: DataFrame, number: int) -> DataFrame:
        """Up to ``CENTERS`` pairs (a, b) of different components per document: with the centers of its slices, the likeliest first."""
        many = split.where(MANY_OUTSIDE).select("key", F.ceil(F.col("size") / SLICE).alias("slices"))
        part = F.pmod(F.xxhash64("doc", "key", F.lit(number)), F.col("slices"))
        rows = members.select("key", "doc").join(many, "key").join(found, "doc", "left")
        rows = rows.select("key", part.alias("slice"), F.col("doc").alias("b"), F.coalesce("component", "doc").alias("c_b"))
        rows = self.staging.write(rows, "round-members")
        first = F.min_by(F.struct(F.col("b").alias("a"), F.col("c_b").alias("c_a")), F.xxhash64("b", F.lit(number + 1)))
        centers = rows.groupBy("key", "slice").agg(first.alias("center")).select("key", "slice", "center.*")
        met = rows.join(centers, ["key", "slice"]).where("c_a <> c_b").select("a", "b").distinct()
        met = met.join(_sided(fine, "b"), "b").join(_sided(fine, "a"), "a").where(may_be_similar(self.percent, "sketch_a", "n_a", "sketch_b", "n_b"))
        share = _differing("sketch_a", "sketch_b") / (F.col("n_a") + F.col("n_b"))
        likeliest = Window.partitionBy("b").orderBy("share", "a")
        best = met.select("a", "b", share.alias("share")).withColumn("nth", F.row_number().over(likeliest)).where(F.col("nth") <= CENTERS)
        return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _rest(self, members: DataFrame, sketch: DataFrame, fine: DataFrame | None, found: DataFrame, split: DataFrame) -> DataFrame:
        """Pairs of different components in one bucket, but none inside its largest component, and none that
        the sketches rule out: the fine ones, too, where both documents have one."""
        open_ = members.join(split.select("key", "bulk"), "key").join(found, "doc", "left")
        open_ = open_.select("key", "bulk", F.col("doc").alias("b"), F.coalesce("component", "doc").alias("c_b"))
        every, columns, test = open_.join(sketch, "b"), ["c", "n", "sketch"], may_be_similar(self.percent, "sketch_a", "n_a", "sketch_b", "n_b")
        if fine is not None:
            every = every.join(_sided(fine, "b").toDF("b", "m_b", "fine_b"), "b", "left")
            # the short sketches settle most pairs
            columns += ["m", "fine"]
            test = test & (F.expr("fine_a is null or fine_b is null") | may_be_similar(self.percent, "fine_a", "m_a", "fine_b", "m_b"))
        every = self.staging.write(every, "open-members")
        self.staging.release()
        small = every.where("c_b <> bulk").select("key", *(F.col(f"{c}_b").alias(f"{c}_a") for c in columns), F.col("b").alias("a"))
        # a member of the largest component meets the others once; two others meet in the order of their ids
        meet = F.expr("c_a <> c_b and (c_b = bulk or b < a)")
        pairs = every.join(small, "key").where(meet & test)
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are similar enough; sets are made for documents in pairs only.

        A set travels once per pair, so the pairs are verified in ``PARTS`` parts, and only one part's sets lie in shuffle files at a time.
        """
        scratch = Staging(self.docs.sparkSession, self.staging.path)
        pairs = scratch.write(pairs, "pairs")
        self.staging.release()
        wanted = pairs.select(F.col("a").alias("doc")).unionAll(pairs.select(F.col("b").alias("doc"))).distinct()
        sets = scratch.write(self._sets(wanted), "sets")
        self.staging.release()
        of_b = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("of_b"))
        of_a = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("of_a"))
        common = F.size(F.array_intersect("of_a", "of_b"))
        union = F.size("of_a") + F.size("of_b") - common
        found = None
        for part in range(PARTS):
            own = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(PARTS)) == part)
            both = own.join(of_b, "b").join(of_a, "a")
            links = self.staging.write(both.where(100 * common.cast("long") >= self.percent * union.cast("long")).select("a", "b"), "links")
            self.staging.release()
            found = links if found is None else found.unionAll(links)
        scratch.drop()
        return found

    def _sets(self, wanted: DataFrame) -> DataFrame:
        return sets_of(self.docs.join(wanted, "doc", "left_semi"), self.size)


def keep_one(docs: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents of a component other than its smallest id.

    Rows that repeat an id all stay or all go.
    """
    scratch = Staging(docs.sparkSession, staging.path)
    found = JaccardJoin(docs, scratch, id_col=id_col, text_col=text_col, **options).result()
    gone = staging.write(found.where("doc <> component").select("doc").distinct(), "near-duplicates")
    scratch.drop()
    staging.release()
    wrapped = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(SMALLEST_ID)).alias("doc"))
    return wrapped.join(gone, "doc", "left_anti").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def op9_jaccard_join(spark, sf_dir):
    """Per document: doc_id, n_shingles, component_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = JaccardJoin(docs, Staging(spark), size=3, percent=90).result()
    null_if = lambda c: F.when(F.col(c) != SMALLEST_ID, F.col(c))
    return found.select(null_if("doc").alias("doc_id"), "n_shingles", null_if("component").alias("component_id"))


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] end) as s from words
), items as (
  select doc_id, len(s) as n, unnest(s) as x from sets
), shared as (
  select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as common
  from items a join items b on a.x = b.x and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by all
), links as (
  select a, b from shared where 100 * common >= 90 * (na + nb - common)
), both_ways as (
  select a, b from links union all select b, a from links
), reach(doc_id, r) as (
  select a, a from both_ways union select r.doc_id, e.b from reach r join both_ways e on r.r = e.a
)
select s.doc_id, len(s.s) as n_shingles, coalesce(least(m.c, s.doc_id), s.doc_id) as component_id
from sets s left join (select doc_id, min(r) as c from reach group by 1) m using (doc_id)
"""
