"""Intermediate tables written to the cluster's shared folder.

Tables read by several later steps are written once as Parquet and read back. That cuts the
lineage (a lost executor costs a re-read, not a recomputation), keeps column pruning, and gives
the planner the true size of the table, so that it broadcasts only what is really small.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_own_folders: dict[str, str] = {}  # of applications without the setting, which cannot be set once a session runs


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one fresh folder per application only for a master inside this process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if re.fullmatch(r"local(\[.*\])?", context.master) is None:
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="msgloom-")
    return _own_folders[context.applicationId]


class Staging:
    """A private sub-folder of the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        base = (root or shared_folder(spark)).rstrip("/")
        self.path = f"{base}/msgloom-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` below this folder and return it as read back from there."""
        target = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def release(self) -> None:
        """Collect the driver's garbage, so that Spark deletes the shuffle files of finished steps now and not at some later time."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self) -> None:
        """Delete the folder, through the file system it lives on."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def dense_index(df: DataFrame, order: list, name: str, staging: Staging, start: int = 0, kind: str = "int") -> DataFrame:
    """Number the rows ``start, start+1, ...`` in ``order`` without a single-partition window.

    The rows are sorted by a range shuffle and written with (partition, offset) packed in one
    number; partition starting points come from one tiny aggregate over that written table.
    """
    offset_bits = 33  # layout of monotonically_increasing_id: partition << 33 | offset
    packed = staging.write(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()), "index")
    part = F.shiftright("_pos", offset_bits)
    sizes = {r["p"]: r["n"] for r in packed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    first, starts = start, []
    for p in sorted(sizes):
        starts.append((p, first))
        first += sizes[p]
    schema = T.StructType([T.StructField("_p", T.LongType()), T.StructField("_start", T.LongType())])
    firsts = df.sparkSession.createDataFrame(starts, schema)
    offset = F.col("_pos").bitwiseAND(F.lit((1 << offset_bits) - 1))
    # one row per sorted partition, so at most spark.sql.shuffle.partitions rows to broadcast
    return (
        packed.withColumn("_p", part)
        .join(F.broadcast(firsts), "_p")
        .withColumn(name, (F.col("_start") + offset).cast(kind))
        .drop("_p", "_pos", "_start")
    )
