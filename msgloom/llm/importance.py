"""Importance resampling towards a target distribution.

A document's words are hashed into a fixed number of buckets. Both corpora are counted per bucket (combined before the
shuffle), which gives every bucket a gain: how much likelier the target's words fall there. The gains are one array of
fixed length inside the plan, so a document's weight is a sum over its own bucket array and nothing is joined. A Gumbel
number drawn from a hash of the id turns the weights into a draw without replacement: the k largest scores.

The k-th score is found by a distributed quickselect on narrow keys. Every round takes a few random keys of the open
interval as pivots, counts exactly how many keys lie below, on and between them, and goes on with the one
interval that holds the k-th; the interval shrinks by the number of pivots each time. Only the winners are sorted
and ranked. Keys are (score descending, id, hash of the text, row), so they are unique, and a third of all rows with one
id or one score is no group that meets anywhere.

Edge cases: a null or empty text has no features, weight 0 and still a score. A null id counts as the word
"null" in the draw and comes after all others in ties. Rows that repeat an id share a Gumbel number, are scored each by its own text and may
be drawn each; equal rows tie and any of them fare alike but for the rank. Empty documents give an empty
result; an empty target leaves the smoothed gains. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import ngrams_in_range
from ..staging import Staging, dense_index
from .licenses import WORD, words_of

BUCKETS = 10_000
SEED = 2024
PIVOTS = 31
KEY = ["k_score", "k_null", "k_id", "k_text", "row_no"]


def bucket_array(text: Column, runs: int = 1, buckets: int = BUCKETS) -> Column:
    """The bucket of each run of 1 to ``runs`` words of a text: crc32 of its UTF-8 bytes, repeats included."""
    grams = ngrams_in_range(words_of(F.coalesce(text, F.lit(""))), 1, runs)
    return F.transform(grams, lambda gram: (F.crc32(gram.cast("binary")) % buckets).cast("int"))


def bucket_counts(arrays: DataFrame, name: str) -> DataFrame:
    """(bucket, ``name``) from rows with an array ``buckets``."""
    return arrays.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket, in thousandths of a nat, rounded down; both tables have an array ``buckets``.

    One row per bucket comes to the driver: their number is a parameter and does not grow with the data.
    """
    both = bucket_counts(raw, "s").join(bucket_counts(target, "t"), "bucket", "full")
    counts = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left").fillna(0)
    totals = counts.agg(F.sum("s").cast("double").alias("S"), F.sum("t").cast("double").alias("T")).first()
    odds = (F.col("t").cast("double") + 1.0) * F.lit(totals["S"] + buckets) / ((F.col("s").cast("double") + 1.0) * F.lit(totals["T"] + buckets))
    gains = dict(counts.select("bucket", F.floor(F.lit(1000.0) * F.log(odds)).alias("gain")).collect())
    return [gains[b] for b in range(buckets)]


def weight_of(buckets: Column, gains: list[int]) -> Column:
    """Mean gain over a bucket array, rounded down; 0 without features."""
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")  # folded to one constant array
    total = F.aggregate(buckets, F.lit(0).cast("bigint"), lambda sum_, b: sum_ + F.get(table, b))
    n = F.size(buckets).cast("bigint")
    floored = F.call_function("div", total - F.pmod(total, n), n)
    return F.when(n > 0, floored).otherwise(F.lit(0)).cast("bigint")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel number in thousandths, rounded down, from 32 bits of a hash of the id and the seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def _literal(values: tuple, names: list[str]) -> Column:
    return F.struct(*(F.lit(v).cast("bigint").alias(n) for v, n in zip(values, names)))


def kth_key(keys: DataFrame, k: int, names: list[str], salt: str, pivots: int = PIVOTS) -> tuple | None:
    """The ``k``-th smallest (from 1) of the unique composite keys ``names`` (all bigint), None if there are fewer.

    ``salt`` is a column that the random choice of pivots hashes. Each round brings at most ``pivots`` keys and twice as many counts
    to the driver.
    """
    key = F.struct(*names)
    inside, wanted, turn = keys.select(*names), k, 0
    while True:
        drawn = inside.orderBy(F.xxhash64(F.lit(turn), salt), *names).limit(pivots).collect()
        if not drawn:
            return None
        at = sorted(tuple(r) for r in drawn)
        # 2 i: between the pivots i - 1 and i; 2 i + 1: on pivot i
        place = F.lit(0)
        for pivot in at:
            literal = _literal(pivot, names)
            place = place + F.when(key > literal, 2).when(key == literal, 1).otherwise(0)
        counts = dict(inside.groupBy(place.alias("place")).count().collect())
        for here in range(2 * len(at) + 1):
            found = counts.get(here, 0)
            if wanted <= found:
                break
            wanted -= found
        else:
            return None
        if here % 2:
            return at[here // 2]
        if here:
            inside = inside.where(key > _literal(at[here // 2 - 1], names))
        if here < 2 * len(at):
            inside = inside.where(key < _literal(at[here // 2], names))
        turn += 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    staging: Staging,
    percent: int = 10,
    min_words: int = 20,
    runs: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default), and beside it n_words, n_features, weight, score and rank.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn and
    ranked from 1; the others have no rank.
    """
    arrays = docs.select(
        F.struct(*(keep if keep is not None else docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("k_text"),
        bucket_array(F.col(text_col), runs, buckets).alias("buckets"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_words"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    featured = staging.write(arrays if runs > 1 else arrays.withColumn("n_words", F.size("buckets").cast("bigint")), "features")
    aim = staging.write(target.select(bucket_array(F.col(target_text), runs, buckets).alias("buckets")), "target-features")
    gains = bucket_gains(featured, aim, buckets)
    weighed = featured.withColumn("weight", weight_of(F.col("buckets"), gains)).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = staging.write(
        weighed.select(
            "row",
            "n_words",
            F.size("buckets").cast("bigint").alias("n_features"),
            "weight",
            "score",
            (-F.col("score")).alias("k_score"),
            F.col("id").isNull().cast("bigint").alias("k_null"),
            F.coalesce(F.col("id").cast("bigint"), F.lit(0)).alias("k_id"),
            "k_text",
            "row_no",
        ),
        "scored",
    )
    eligible = staging.write(scored.where(F.col("n_words") >= min_words).select(*KEY), "keys")
    last = kth_key(eligible, percent * eligible.count() // 100, KEY, "row_no")
    winners = eligible.where(F.struct(*KEY) <= _literal(last, KEY)) if last else eligible.limit(0)
    ranks = dense_index(winners, KEY, "rank", staging, start=1, kind="bigint").select("row_no", "rank")
    return scored.join(ranks, "row_no", "left").select("row", "n_words", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark, sf_dir):
    """Per document: doc_id, n_features, weight, score, rank."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = resample(docs, target, Staging(spark), keep=["doc_id"])
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
with words as (
  select 'd' as side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select 't', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark
), per_word as (
  select side, doc_id, w, count(*) as n from words group by all
), crc_table as (
  select list(list_reduce(range(8), lambda c, bit: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) order by b) as tab
  from range(256) t(b)
), hashed as (
  select w, hex(encode(w)) as x from (select distinct w from words)
), bucketed as (
  select w, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, (1 + 2 * i)::bigint, 2))::bigint),
                            lambda c, byte: xor(c // 256, tab[(1 + xor(c % 256, byte))::bigint]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket
  from hashed, crc_table
), counts as (
  select b.bucket, coalesce(sum(n) filter (where side = 'd'), 0)::double as s, coalesce(sum(n) filter (where side = 't'), 0)::double as t
  from per_word join bucketed b using (w) group by 1
), totals as (
  select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from counts
), gains as (
  select bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as gain from counts, totals
), summed as (
  select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as total
  from per_word join bucketed using (w) join gains using (bucket) where side = 'd' group by 1
), scored as (
  select d.doc_id, coalesce(n_features, 0) as n_features,
         coalesce(((total - ((total % n_features) + n_features) % n_features) // n_features), 0)::bigint as weight,
         ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint as h
  from documents d left join summed using (doc_id)
), drawn as (
  select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored
), eligible as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from drawn where n_features >= 20
)
select d.doc_id, d.n_features, d.weight, d.score, e.rank
from drawn d left join eligible e on e.doc_id = d.doc_id and e.rank <= 10 * e.n // 100
"""
