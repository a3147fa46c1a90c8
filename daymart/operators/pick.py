"""One or a few rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import time_slot
from daymart.operators.running import earlier_sums


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order (a total order makes it repeatable).

    Spark limits each group before the shuffle as well, so a key that holds a third of
    the table shrinks to one row per input partition first.
    """
    return first_n(rows, keys, order, 1)


def first_n(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows per key, for an ``n`` of up to some hundreds (see ``newest_n``).

    Rows meet by the digests of text keys, so no text is hashed, compared or sorted in the shuffle.
    """
    digests = {f"_digest{i}": F.sha2(F.col(k), 256) for i, k in enumerate(keys) if isinstance(rows.schema[k].dataType, T.StringType)}
    by = [f"_digest{i}" if f"_digest{i}" in digests else k for i, k in enumerate(keys)]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumns(digests).withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", *digests)


def newest_n(rows: DataFrame, keys: Sequence[str], stamp: str, tie: str, n: int, unit: str = "minute") -> DataFrame:
    """The newest ``n`` rows per key, for an ``n`` in the millions.

    Ranking a key would need all of its rows in one task.  Here rows are counted per time
    slot; slots that fit into ``n`` as a whole are kept whole, and only the one slot per key
    in which the limit falls is ranked.
    """
    slotted = rows.withColumn("_slot", -time_slot(F.col(stamp), unit))  # newest slot first
    sizes = slotted.groupBy(*keys, "_slot").agg(F.count("*").alias("_n"))
    room = (
        earlier_sums(sizes, keys, "_slot", {"_newer": "_n"})
        .withColumn("_room", F.lit(n) - F.coalesce(F.col("_newer"), F.lit(0)))
        .where("_room > 0")
        .drop("_newer")
    )
    kept = slotted.join(room, [*keys, "_slot"])
    whole = kept.where(F.col("_n") <= F.col("_room"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(stamp).desc(), F.col(tie)))
    edge = kept.where(F.col("_n") > F.col("_room")).withColumn("_rank", rank).where("_rank <= _room")
    return whole.select(*rows.columns).unionByName(edge.select(*rows.columns))


def last_values(rows: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """The values of each key's latest row, all from the same row, by an aggregation instead of a sort.

    Rows of the same time are ordered by ``tie`` and then by the values, so that the result is repeatable.
    """
    last = F.max(F.struct(time, *tie, *values)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col("_last")[c].alias(c) for c in (time, *values)])
