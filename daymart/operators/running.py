"""Running sums that survive a hot key.

A plain ``SUM() OVER (PARTITION BY key ORDER BY time)`` puts all rows of a key into one task.  Here a key is cut into time
buckets: sums per bucket (pre-aggregated before the shuffle), running sums over the bucket rows, and a window within each
bucket on top of its opening value.  ``bucket=None`` takes the plain window, for keys known to be small.

Sums are taken in whole units of ``10 ** -DIGITS``, so they are exact and the same on either route, in any order of rows;
rows with equal time share their result, like the default RANGE frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymart.functions.dates import time_slot

DIGITS = 8
UNIT = 10**DIGITS


def _units(value: Column) -> Column:
    """A number in whole units of ``10 ** -DIGITS``; sums and sums of sums of these lose nothing."""
    return (value.cast("double").cast(f"decimal(28,{DIGITS})") * F.lit(UNIT)).cast("decimal(28,0)")


def running_sums(
    rows: DataFrame, keys: Sequence[str], time: str, sums: Mapping[str, Column], bucket: str | None = "minute"
) -> DataFrame:
    """Append one running sum per entry of ``sums`` (output name -> summed column), as doubles."""
    exact = {n: _units(c) for n, c in sums.items()}
    if bucket is None:
        within = Window.partitionBy(*keys).orderBy(time)
        summed = rows.withColumns({n: F.sum(c).over(within) for n, c in exact.items()})
    else:
        summed = _bucketed(rows, keys, time, exact, bucket)
    return summed.withColumns({n: F.col(n).cast("double") / F.lit(float(UNIT)) for n in sums})


def _add(opening: Column, inner: Column) -> Column:
    zero = F.lit(0)
    return F.when(opening.isNotNull() | inner.isNotNull(), F.coalesce(opening, zero) + F.coalesce(inner, zero))


def earlier_sums(slots: DataFrame, keys: Sequence[str], slot: str, sums: Mapping[str, str]) -> DataFrame:
    """Append, per key and slot number, the sum of a column over all earlier slots of the key.

    ``slots`` has one row per key and slot; ``sums`` maps output names to its columns.  The sum
    is taken within blocks of slots and over the blocks, so that a key's whole history of
    slots never meets in one task.
    """
    blocks = slots.withColumn("_block", F.floor(F.col(slot) / F.lit(3600)))
    earlier = (Window.unboundedPreceding, -1)
    of_block = Window.partitionBy(*keys, "_block").orderBy(slot).rowsBetween(*earlier)
    of_key = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*earlier)
    openings = (
        blocks.groupBy(*keys, "_block")
        .agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
        .select(*keys, "_block", *[F.sum(f"_sum_{n}").over(of_key).alias(f"_open_{n}") for n in sums])
    )
    within = blocks.withColumns({f"_in_{n}": F.sum(c).over(of_block) for n, c in sums.items()})
    return within.join(openings, [*keys, "_block"]).select(
        *slots.columns, *[_add(F.col(f"_open_{n}"), F.col(f"_in_{n}")).alias(n) for n in sums]
    )


def _bucketed(
    rows: DataFrame, keys: Sequence[str], time: str, sums: Mapping[str, Column], bucket: str
) -> DataFrame:
    slot = "_slot"
    rows = rows.withColumn(slot, time_slot(F.col(time), bucket))
    per_slot = rows.groupBy(*keys, slot).agg(*[F.sum(c).alias(f"_in_{n}") for n, c in sums.items()])
    openings = earlier_sums(per_slot, keys, slot, {f"_open_{n}": f"_in_{n}" for n in sums})
    openings = openings.drop(*[f"_in_{n}" for n in sums])
    within = Window.partitionBy(*keys, slot).orderBy(time)
    return (
        rows.join(openings, [*keys, slot], "left")
        .withColumns({f"_in_{n}": F.sum(c).over(within) for n, c in sums.items()})
        .withColumns({n: _add(F.col(f"_open_{n}"), F.col(f"_in_{n}")) for n in sums})
        .drop(slot, *[f"_in_{n}" for n in sums], *[f"_open_{n}" for n in sums])
    )
