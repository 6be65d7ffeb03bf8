"""Scans spread over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """The scan dealt over ``partitions`` by ``key``; with None it stays as its files are split.

    For a few small or unsplittable files, which would leave the text work to a few tasks.
    """
    return scan if partitions is None else scan.repartition(partitions, key)
