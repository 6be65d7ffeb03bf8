"""Session defaults for local runs and for submitting to a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that only change how a plan is executed, never what it returns.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g", more: dict[str, str] | None = None
) -> SparkSession:
    """A ``local[cores]`` session for tests and benchmarks; ``more`` settings win."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("msgloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (RUNTIME_CONF | (more or {})).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 200 << 20, at_least: int = 8) -> int:
    """Value for ``spark.sql.shuffle.partitions`` at which a shuffle of the whole input still
    fits in memory task by task; adaptive execution merges what turns out small."""
    return max(at_least, -(-input_bytes // partition_bytes))
