"""Statistics and distinct rows over batches of messages, without going back to earlier batches.

Both keep a :class:`BucketTable`. Statistics keep mergeable parts per (id, sign), and a batch reads and rewrites the buckets
of its users only. Distinct rows keep two hashes per row, in buckets with Bloom filters of their own, and a batch reads the hashes of
only those buckets in which a filter says that one of its rows may be known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.operators.statistics import everything, with_carriers
from msgloom.sources.buckets import BucketTable, bucket_of, digest_of
from msgloom.staging import Staging


class IncrementalStatistics:
    """The statistics of :func:`all_statistics`, kept up to date batch by batch below ``path``.

    Batches must be free of each other's duplicates, see :class:`DistinctRows`. ``buckets`` should be such that one
    holds what a task can: parts take about a kilobyte per user and signature.
    """

    def __init__(self, spark: SparkSession, path: str, keywords: dict[str, list[str]] | None = None, buckets: int = 64):
        self.table = BucketTable(spark, path, buckets)
        self.wanted = everything(keywords)

    def commit(self, batch: str, messages: DataFrame, staging: Staging) -> bool:
        """Add a batch; False if it was there already."""
        dated = messages.where(F.col("ts").isNotNull())
        own = self.wanted.parts(dated).withColumn("bucket", bucket_of("id", buckets=self.table.buckets))
        own = staging.write(own, "parts")
        digest = digest_of(own)
        if self.table.committed(batch, digest):
            return False
        touched = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # as many as there are buckets at most
        before = self.table.read(touched)
        if before is not None:
            own = own.unionByName(before.withColumn("bucket", bucket_of("id", buckets=self.table.buckets)))
        if not touched:  # an empty batch is remembered, too
            return self.table.commit(batch, digest, {}, replace=True)
        return self.table.commit(batch, digest, {"data": self.wanted.merged(own, "bucket")}, replace=True)

    def parts(self) -> DataFrame | None:
        return self.table.read()

    def statistics(self, staging: Staging, as_of: Column | None = None, language: str = "cn") -> DataFrame:
        """What one run over all batches would give."""
        found = self.parts()
        if found is None:
            raise ValueError("no batch has been committed")
        return with_carriers(self.wanted.finished(found, as_of), language, staging)


class DistinctRows:
    """Which rows no earlier batch had, by content.

    A row is known by two 64-bit hashes of ``content``. New hashes are appended to their buckets, with Bloom filters over
    them: words of 64 bits, of which a bucket and commit writes those that have a bit set.
    """

    PROBES = 4
    BITS = 12  # per row that a bucket gains

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.table = BucketTable(spark, path, buckets)

    def _hashed(self, rows: DataFrame, content: list[str]) -> DataFrame:
        # a hash passes over nulls, so where they stand is hashed, too
        packed = F.struct(*content, F.array(*(F.col(c).isNull() for c in content)))
        hashes = rows.withColumn("_h", F.xxhash64(packed)).withColumn("_g", F.xxhash64(F.lit(1), packed))
        return hashes.withColumn("bucket", bucket_of("_h", buckets=self.table.buckets))

    def _probes(self, hashes: DataFrame, words: Column) -> DataFrame:
        """A row per probe: commit word and bit that a hash sets."""
        position = F.transform(F.sequence(F.lit(0), F.lit(self.PROBES - 1)), lambda i: F.pmod(F.xxhash64("_g", i), words * 64))
        return hashes.withColumn("_at", F.explode(position)).withColumns(
            {"word": F.expr("cast(_at div 64 as bigint)"), "bit": F.expr("shiftleft(1L, cast(_at % 64 as int))")}
        )

    def _may_know(self, hashes: DataFrame) -> DataFrame | None:
        """The hashes that a filter of their bucket does not rule out."""
        touched = [r["bucket"] for r in hashes.select("bucket").distinct().collect()]
        filters = self.table.read(touched, "bloom")
        if filters is None:
            return None
        sizes = filters.select("in_bucket", "part", "words").distinct()
        asked = hashes.join(sizes, hashes["bucket"] == sizes["in_bucket"])
        probes = self._probes(asked, F.col("words"))
        keys = ["in_bucket", "part", "word"]
        hit = probes.join(filters.drop("words"), keys).where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        return hit.groupBy("bucket", "_h", "_g", "part").agg(F.count_distinct("_at").alias("hits"), F.first("words").alias("words")).join(
            # a row whose probes fall together needs fewer hits
            probes.groupBy("_h", "_g", "part").agg(F.count_distinct("_at").alias("need")), ["_h", "_g", "part"]
        ).where("hits = need").select("bucket", "_h", "_g").distinct()

    def take(self, batch: str, rows: DataFrame, staging: Staging, order: str = "row_no") -> DataFrame:
        """The rows of a batch that are new, one per content with the smallest ``order``, and remember them.

        Taking the same batch again gives the same rows. Equal to one ``drop_duplicate_rows`` over all batches, in the order
        in which they were first taken.
        """
        content = [c for c in rows.columns if c != order]
        least = F.min(F.struct(F.col(order).alias("_order"))).alias("_least")
        hashed = self._hashed(rows, content)
        once = staging.write(hashed.groupBy("_h", "_g", "bucket", *content).agg(least), "batch")
        hashes = once.select("bucket", "_h", "_g")
        digest = digest_of(hashes)
        repeated = self.table.committed(batch, digest)
        fresh = once
        maybe = self._may_know(hashes)
        if maybe is not None:
            maybe = staging.write(maybe, "candidates")
            suspects = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
            # hashes of the same batch are its own, from when it was first taken
            known = self.table.read(suspects).where(F.col("batch") != batch).join(maybe.drop("bucket"), ["_h", "_g"], "left_semi")
            fresh = once.join(known.select("_h", "_g"), ["_h", "_g"], "left_anti")
        fresh = staging.write(fresh, "fresh")
        if not repeated:
            self._remember(batch, digest, fresh.select("bucket", "_h", "_g"))
        return fresh.select(*content, F.col("_least._order").alias(order))

    def _remember(self, batch: str, digest: str, fresh: DataFrame) -> None:
        if fresh.isEmpty():
            self.table.commit(batch, digest, {}, replace=False)
            return
        sizes = fresh.groupBy("bucket").agg(F.ceil(F.count("*") * self.BITS / 64).alias("words"))
        probes = self._probes(fresh.join(sizes, "bucket"), F.col("words"))
        bloom = probes.groupBy("bucket", "words", "word").agg(F.bit_or("bit").alias("bits"))
        bloom = bloom.select("bucket", F.col("bucket").alias("in_bucket"), F.lit(batch).alias("part"), "words", "word", "bits")
        data = fresh.withColumn("batch", F.lit(batch)).sortWithinPartitions("bucket", "_h")
        self.table.commit(batch, digest, {"data": data, "bloom": bloom}, replace=False)
