"""The last known value as of a time, in one pass per key instead of a copy of each value for every time that can see it.

The times asked for are reduced to the different ones of each key before they are shuffled, put among the known values and carried
forward within blocks of time.  What a block opens with comes from the blocks before it, one row each.  So neither a key with most of
the rows nor a long history meets in one task: the window holds the different times of one key and block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 64


def asof_merge(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str, values: Sequence[str],
    tolerance_days: int | None = None, block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Every row of ``left`` with ``right_time`` and ``values`` of the latest row of ``right`` at or before ``time``.

    Both times are dates or both are time stamps.  A row with NULL in a key or in its time, and one that finds nothing within
    ``tolerance_days`` (between calendar days, both ends count), has NULLs.  Of several rows of ``right`` at one time the one with the largest
    ``values`` stands; a NULL value there is the value found.
    """
    known = right.where(_complete(keys, right_time)).select(
        *keys, F.col(right_time).alias("_at"), F.struct(F.col(right_time).alias("_at"), *values).alias("_found")
    )
    asked = left.where(_complete(keys, time)).select(*keys, F.col(time).alias("_at"))
    block = F.floor(F.unix_date(F.to_date("_at")) / F.lit(block_days)).alias("_block")
    points = known.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "_at").agg(F.max("_found").alias("_found")).select("*", block)
    upto = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    openings = (
        points.groupBy(*keys, "_block").agg(F.max("_found").alias("_last"))
        .select(*keys, "_block", F.last("_last", ignorenulls=True).over(before).alias("_opening"))
    )
    carried = (
        points.withColumn("_inner", F.last("_found", ignorenulls=True).over(upto))
        .join(openings, [*keys, "_block"])
        .select(*keys, "_at", F.coalesce("_inner", "_opening").alias("_found"))
    )
    if tolerance_days is not None:
        carried = carried.where(F.datediff("_at", "_found._at") <= tolerance_days)
    answers = carried.select(*keys, F.col("_at").alias(time), F.col("_found._at").alias(right_time), *[F.col(f"_found.{v}").alias(v) for v in values])
    return left.join(answers, [*keys, time], "left")


def _complete(keys: Sequence[str], time: str) -> Column:
    condition = F.col(time).isNotNull()
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
