"""Order-dependent work inside groups of any size.

A plain window over ``id`` puts a whole user into one task. Here each user is first cut into
stretches of the order key; a window runs inside every stretch, and a second window runs over one
small row per stretch. Both windows sort and spill, and no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.functions.tokens import last_tokens

# A stretch spans this many values (as a power of two) of the order key.
STRETCH_BITS = 16


def stretch(order: str, bits: int = STRETCH_BITS) -> Column:
    return F.shiftright(order, bits)


def running_total_before(
    df: DataFrame, group: str, order: str, weight: Column, name: str, bits: int = STRETCH_BITS
) -> DataFrame:
    """Add the sum of ``weight`` over the group's rows that come before each row."""
    rows = df.withColumn("_part", stretch(order, bits)).withColumn("_w", weight)
    inside = Window.partitionBy(group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(group, "_part")
        .agg(F.sum("_w").alias("_total"))
        .select(group, "_part", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_start"))
    )
    local = rows.withColumn("_local", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return (
        local.join(parts, [group, "_part"])
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_part", "_w", "_local", "_start")
    )


def tokens_before(
    df: DataFrame, group: str, order: str, tail: str, k: int, name: str, bits: int = STRETCH_BITS
) -> DataFrame:
    """Add the last ``k`` tokens of everything that precedes each row in its group.

    ``tail`` holds the last ``k`` tokens of a row and must not be empty, so that the ``k``
    preceding rows are enough. Within a stretch only the first rows can lack tokens; these, and
    one row for all the rest of the stretch, take part in the second window.
    """
    nothing = F.array().cast("array<string>")

    def preceding(column: str, window) -> Column:
        parts = [F.coalesce(F.lag(column, back).over(window), nothing) for back in range(k, 0, -1)]
        return last_tokens(F.concat(*parts), k)

    inside = Window.partitionBy(group, "_part").orderBy(order)
    across = Window.partitionBy(group).orderBy(order)
    local = (
        df.withColumn("_part", stretch(order, bits))
        .withColumn(name, preceding(tail, inside))
        .withColumn("_last", F.lead(F.lit(1)).over(inside).isNull())
    )
    enough = F.size(name) == k
    # the last row of a stretch stands for it, unless all rows of the stretch are here anyway
    unit = F.when(enough & F.col("_last"), last_tokens(F.concat(name, tail), k)).otherwise(F.col(tail))
    openers = (
        local.where(~enough | F.col("_last"))
        .withColumn("_unit", unit)
        .withColumn("_enough", enough)
        .withColumn(name, preceding("_unit", across))
        .where(~F.col("_enough"))
    )
    columns = [*df.columns, name]
    return local.where(enough).select(*columns).unionByName(openers.select(*columns))


def first_n(df: DataFrame, group: str, order: list[Column], n: int, spread: str, rank: str, salts: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group, ranked from 1.

    A first round ranks within ``salts`` slices of each group, taken by a hash of ``spread``, so
    that the last round sees at most ``n * salts`` rows of any group. By default there is a slice per
    shuffle partition, so that one group can keep all tasks busy.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = Window.partitionBy(group, "_slice").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(salts)))
        .withColumn(rank, F.row_number().over(slices))
        .where(F.col(rank) <= n)
        .drop(rank, "_slice")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
    )
