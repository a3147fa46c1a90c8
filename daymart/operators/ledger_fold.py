"""Accept or reject ledger entries in order: a balance may never go below zero.

An entry that would take the running total below zero is skipped, and later entries are
judged without it.  Whether an entry counts therefore depends on every earlier decision,
which no window sum can express.

Rows are sorted by key and time inside Spark and streamed through one Arrow step that carries the total, so no group is held in memory.
Stretches whose plain running total stays at or above zero are accepted as a whole, by vector; only others are run entry by entry.

A key with more than ``chunk_rows`` entries is cut into consecutive chunks that run in parallel.  What a chunk does to the total it opens
with is a map: a sorted list of breakpoints, and between two of them the same entries are accepted, so the closing total is the opening one
plus a constant.  From the chunk's deepest fall on there is but one constant.

1. every chunk computes its map; a map that would get more than ``MAX_PIECES`` breakpoints is kept around a guessed opening and for large openings only;
2. the maps of a key are strung together, one at a time, into the opening of every chunk;
3. a chunk whose map is not known at its opening computes it again around that opening, until no such chunk is left.

The first chunk's opening is known and each round settles at least the first chunk that was not known, so the loop ends; a map that was not
shortened needs no second round.  Then all chunks run in parallel from their openings, and no stream is longer than a chunk.  Totals are sums of
doubles: for whole numbers (and any amounts whose sums are exact) the result is exactly the sequential one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import time_slot
from daymart.operators.running import earlier_sums
from daymart.operators.skew import oversized_keys
from daymart.session import materialise

_FIRST, _START, _CHUNK, _SLOT = "_first", "_start", "_chunk", "_slot"
CHUNK_ROWS = 100_000
MAX_PIECES = 4096


def accept_flags(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    amount: str,
    time: str,
    flag: str = "Is_Valid",
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = "second",
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Append ``flag``: was the entry accepted?

    ``order`` must start with ``time``-compatible columns and should be total.  Sizes of keys are looked up, and the maps of
    large ones computed, when the function is called; with ``chunk_rows=None`` it is a plan only, and a key is one stream.
    """
    oversized = oversized_keys(rows, keys, chunk_rows) if chunk_rows else None
    if oversized is None:
        return _fold(rows.withColumn(_START, F.lit(0.0)), keys, order, amount, flag)

    cold = rows.join(oversized, list(keys), "left_anti").withColumn(_START, F.lit(0.0))
    hot = materialise(_chunked(rows.join(oversized, list(keys), "left_semi"), keys, order, time, chunk_rows, slot))
    openings = _settle(hot, keys, order, amount, max_pieces)
    parts = [*keys, _CHUNK]
    settled = _fold(hot.join(openings, parts, "inner"), parts, order, amount, flag)
    return _fold(cold, keys, order, amount, flag).unionByName(settled.drop(_CHUNK))


def _chunked(rows: DataFrame, keys, order, time: str, chunk_rows: int, slot: str) -> DataFrame:
    """Rows with the number of their chunk, by how many rows of the key come before; a slot is ranked by itself."""
    slotted = rows.withColumn(_SLOT, time_slot(F.col(time), slot))
    sizes = slotted.groupBy(*keys, _SLOT).agg(F.count("*").alias("_n"))
    earlier = earlier_sums(sizes, keys, _SLOT, {"_earlier": "_n"}).drop("_n")
    rank = F.row_number().over(Window.partitionBy(*keys, _SLOT).orderBy(*order)) - 1
    number = F.floor((F.coalesce(F.col("_earlier"), F.lit(0)) + rank) / F.lit(chunk_rows)).cast("long")
    return slotted.join(earlier, [*keys, _SLOT]).withColumn(_CHUNK, number).drop(_SLOT, "_earlier")


def _ordered(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows clustered by key, in order, with the first row of each key marked."""
    within = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_FIRST, F.row_number().over(within) == 1)
    )


def _fold(rows: DataFrame, keys, order, amount: str, flag: str) -> DataFrame:
    ordered = _ordered(rows, keys, order)
    kept = [f for f in ordered.schema.fields if f.name not in (_FIRST, _START)]
    schema = T.StructType([*kept, T.StructField(flag, T.BooleanType(), False)])
    names = [f.name for f in kept]

    # Defined here so that executors need no copy of this package.
    def step(batches):
        import numpy as np
        import pyarrow as pa

        total = 0.0
        for batch in batches:
            moves = batch.column(amount).cast(pa.float64()).to_numpy(zero_copy_only=False)
            firsts = np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))
            starts = batch.column("_start").to_numpy(zero_copy_only=False)
            accepted = np.ones(len(moves), dtype=bool)
            bounds = [0, *firsts[firsts > 0].tolist(), len(moves)]
            for low, high in zip(bounds, bounds[1:]):
                if low == high:
                    continue
                if len(firsts) and (low > 0 or firsts[0] == 0):
                    total = float(starts[low])
                reached = np.cumsum(np.concatenate(([total], moves[low:high])))
                if (reached >= 0).all():
                    total = float(reached[-1])
                    continue
                for i, value in enumerate(moves[low:high].tolist(), low):
                    if total + value >= 0:
                        total += value
                    else:
                        accepted[i] = False
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(accepted)], [*names, flag])

    return ordered.mapInArrow(step, schema)


_MAP = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("_low", "_shift")]


def _maps(rows: DataFrame, keys, order, amount: str, max_pieces: int) -> DataFrame:
    """Per key and chunk: breakpoints of the opening, and what is added from each on (NaN: not known); ``_start`` is the guess."""
    parts = [*keys, _CHUNK]
    ordered = _ordered(rows, parts, order).select(*parts, _START, _FIRST, F.col(amount).cast("double").alias("_amount"))
    schema = T.StructType([*[ordered.schema[c] for c in parts], T.StructField(_START, T.DoubleType()), *_MAP])
    names = schema.names

    def step(batches):
        import numpy as np
        import pyarrow as pa

        def shortened(low, shift, guess):
            """The pieces around the guess and the last one; the rest is not known."""
            same = np.concatenate(([False], shift[1:] == shift[:-1]))
            low, shift = low[~same], shift[~same]
            if len(low) <= max_pieces:
                return low, shift
            here = int(np.searchsorted(low, guess, side="right")) - 1
            first = max(0, min(here - max_pieces // 4, len(low) - 1 - max_pieces // 2))
            last = min(len(low) - 1, first + max_pieces // 2)
            ends_low, ends_shift = [low[first:last]], [shift[first:last]]
            if first > 0:
                ends_low.insert(0, [0.0])
                ends_shift.insert(0, [np.nan])
            if last < len(low) - 1:
                ends_low.append(low[last : last + 1])
                ends_shift.append([np.nan])
            return np.concatenate([*ends_low, low[-1:]]), np.concatenate([*ends_shift, shift[-1:]])

        run = None  # parts, guess, breakpoints, added, added to all
        target = None

        def closed(run):
            low, shift = run["low"], run["shift"] + run["all"]
            same = np.concatenate(([False], shift[1:] == shift[:-1]))
            return [*run["parts"], run["guess"], low[~same].tolist(), shift[~same].tolist()]

        for batch in batches:
            if target is None:
                fields = [batch.schema.field(p) for p in parts]
                doubles = pa.list_(pa.float64())
                target = pa.schema([*fields, pa.field("_start", pa.float64()), pa.field("_low", doubles), pa.field("_shift", doubles)])
            done = []
            amounts, firsts = batch.column("_amount").to_pylist(), batch.column("_first").to_pylist()
            for i, (value, first) in enumerate(zip(amounts, firsts)):
                if first:
                    if run is not None:
                        done.append(closed(run))
                    run = {"parts": [batch.column(p)[i].as_py() for p in parts], "guess": batch.column("_start")[i].as_py()}
                    run |= {"low": np.zeros(1), "shift": np.zeros(1), "all": 0.0}
                if value is None or value >= 0:
                    run["all"] += value or 0.0
                    continue
                low, shift, need = run["low"], run["shift"], -value - run["all"]
                image = low + shift  # without what is added to all
                taken = image >= need
                split = np.flatnonzero(~taken & (np.concatenate((low[1:], [np.inf])) + shift > need))
                if len(split):
                    at = split + 1
                    low = np.insert(low, at, need - shift[split])
                    taken = np.insert(taken, at, True)
                    shift = np.insert(shift, at, shift[split])
                run["low"], run["shift"] = low, np.where(taken, shift + value, shift)
                if len(low) > max_pieces:
                    run["low"], run["shift"] = shortened(run["low"], run["shift"], run["guess"])
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema=target)
        if run is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, closed(run)))], schema=target)

    return ordered.mapInArrow(step, schema)


def _strung(maps: DataFrame, keys) -> DataFrame:
    """Per key and chunk: the opening, and whether the chunk's map is known there.  One map after the other goes through."""
    parts = [*keys, _CHUNK]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(_CHUNK)) == 1
    ordered = maps.repartition(*keys).sortWithinPartitions(*keys, _CHUNK).withColumn(_FIRST, first)
    schema = T.StructType([*[maps.schema[c] for c in parts], T.StructField("_opening", T.DoubleType()), T.StructField("_known", T.BooleanType())])

    def step(batches):
        import math

        import numpy as np
        import pyarrow as pa

        total = 0.0
        for batch in batches:
            openings, known = [], []
            for i in range(batch.num_rows):
                if batch.column("_first")[i].as_py():
                    total = 0.0
                low, shift = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("_low", "_shift"))
                added = float(shift[int(np.searchsorted(low, total, side="right")) - 1])
                openings.append(total)
                known.append(not math.isnan(added))
                if math.isnan(added):  # go on from the guess, where every map is known
                    guess = batch.column("_start")[i].as_py()
                    total, added = guess, float(shift[int(np.searchsorted(low, guess, side="right")) - 1])
                total += added
            columns = [batch.column(p) for p in parts]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(openings, pa.float64()), pa.array(known)], [*parts, "_opening", "_known"])

    return ordered.mapInArrow(step, schema)


def _settle(hot: DataFrame, keys, order, amount: str, max_pieces: int) -> DataFrame:
    """Per key and chunk: the opening."""
    parts = [*keys, _CHUNK]
    maps = materialise(_maps(hot.withColumn(_START, F.lit(0.0)), keys, order, amount, max_pieces))
    while True:
        openings = materialise(_strung(maps, keys))
        unknown = openings.where("not _known").select(*parts, F.col("_opening").alias(_START))
        if unknown.isEmpty():
            return openings.select(*parts, F.col("_opening").alias(_START))
        again = _maps(hot.join(unknown, parts, "inner"), keys, order, amount, max_pieces)
        maps = materialise(maps.join(unknown, parts, "left_anti").unionByName(again))
