"""Mixing sources to target weights.

Words are summed per source (combined before the shuffle, so a hot source costs one row per task),
targets follow from the weights, and a document is emitted floor(rate) times plus once more with the
rate's fraction as probability, decided by a hash of its id (without an id: of its text and place in the input): reruns and
retried tasks agree.

Edge cases: a null text has size 0. Null is a source of its own, last in order. A source without
words has target 0 and emits nothing; so does an empty table. Rows with the same id decide alike, rows without one each by
itself, so that a source of nothing else meets its target, too. Extra
columns pass through; helper columns cannot clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import word_count

WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources by code point, null last, take ``weights`` in turn and share the sum of all sizes. No
    target passes ``cap`` times its source; what is above goes to the others by weight. In the
    order of size / weight, the sources that reach the cap come first, so running sums settle it. The
    windows see one row per source.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*(F.lit(w) for w in weights))
    weighed = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(order))
        .withColumn("weight", F.get(cycle, (F.col("nth") - 1) % len(weights)).cast("long"))
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "nth")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ceiling = F.col("source_size") * cap
    settled = (
        weighed.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum(ceiling).over(before), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(after))
        .withColumn("capped", ceiling * F.col("sharing") <= F.col("weight") * F.col("left"))
        # of the first source below its ceiling
        .withColumn("rest", F.first(F.when(~F.col("capped"), F.col("left")), True).over(everything))
        .withColumn("shares", F.first(F.when(~F.col("capped"), F.col("sharing")), True).over(everything))
    )
    shared = (F.col("weight") * F.col("rest")).cast("double") / F.col("shares").cast("double")
    target = F.when(F.col("capped"), ceiling.cast("double")).otherwise(shared)
    return settled.select("source", "source_size", target.alias("target"))


def chance(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1), 52 bits of an MD5, that depends on the seed and the id alone, or for a null id on the text and the row's
    place in the input."""
    place = F.concat_ws(":", F.lit("null"), F.xxhash64(text), F.monotonically_increasing_id())
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), place))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def with_copies(
    docs: DataFrame,
    staging: Staging,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = 3,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``row`` with all columns of ``docs``, and beside it size, source_size, target and copies.

    The table of sources is written first: Spark broadcasts it if its true size allows, else joins by
    shuffle with the hot source's partitions split.
    """
    sized = docs.select(
        F.struct("*").alias("row"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        chance(F.col(id_col), F.col(text_col), seed).alias("chance"),
    )
    targets = staging.write(source_targets(sized.select("source", "size"), weights, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    extra = F.col("chance") < F.col("rate") - whole
    named = targets.withColumnRenamed("source", "of")
    return (
        sized.join(named, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("rate", rate)
        .select("row", "size", "source_size", "target", (whole + extra.cast("long")).alias("copies"))
    )


def mix(docs: DataFrame, staging: Staging, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    counted = with_copies(docs, staging, **options).where(F.col("copies") > 0)
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *(F.col("row")[c].alias(c) for c in docs.columns)
    )


def op3_mixing(spark, sf_dir):
    """Per document: doc_id, size, source_size, target, taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return with_copies(docs, Staging(spark)).select("row.doc_id", "size", "source_size", "target", taken)


SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
), per_source as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3]::bigint as weight,
         row_number() over (order by source nulls last) as nth
  from per_source
), running as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (
             order by source_size / weight, nth rows between unbounded preceding and 1 preceding), 0))::bigint as rest,
         (sum(weight) over (order by source_size / weight, nth rows between current row and unbounded following))::bigint as shares
  from weighed
), judged as (
  select *, 3 * source_size * shares <= weight * rest as capped from running
), below as (
  select rest, shares from judged where not capped order by source_size / weight, nth limit 1
), targets as (
  select j.source, j.source_size, case when j.capped then (3 * j.source_size)::double
         else (j.weight * b.rest)::double / b.shares::double end as target
  from judged j left join below b on true
), rated as (
  select d.doc_id, d.size, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
         ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0::double as chance
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target,
       (size * (floor(rate) + case when chance < rate - floor(rate) then 1 else 0 end))::bigint as taken
from rated
"""
