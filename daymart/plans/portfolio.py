"""Portfolio snapshots carried forward from day to day.

Two readings of the same report exist.  ``portfolio_snapshot`` gives the figures as the
warehouse has always published them, including its known oddities:

* sells arrive with a negative amount and are negated again, so they add to a holding;
* the published average price is amount over value, the reciprocal of a price;
* the daily change is the opening balance rather than the day's movement;
* every distinct close of the last eight days yields its own row;
* the unrealised gain has the sign of average minus actual price.

``portfolio_snapshot_intent`` gives what the names promise.  Divisions by zero give NULL in
both instead of failing the whole day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymart.functions.dates import midnight
from daymart.operators import ledger_fold
from daymart.operators.lookback import latest_price, recent_prices
from daymart.operators.running import running_sums
from daymart.plans.ledger import signed_entries
from daymart.session import materialise
from daymart.sources.day_tables import on_day

KEYS = ["run_date", "Analyst", "Ticker"]
SNAPSHOT_COLUMNS = [
    "Analyst", "Ticker", "Amount", "Daily_Amount_Change", "Realised_Gain", "Unrealised_Gain", "p_date", "Avg_Price",
]


def holdings_events(ledger: DataFrame, snapshot: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """The day's validated entries and yesterday's holdings as one buy at midnight."""
    entries = on_day(ledger, ds).select(
        "Analyst", "Ticker", "Amount", "Txn_Type", "Price", "Txn_Time", "p_date", F.col("p_date").alias("run_date")
    )
    previous = on_day(snapshot, None if ds is None else ds - dt.timedelta(days=1))
    opening = previous.select(
        "Analyst",
        "Ticker",
        "Amount",
        F.lit("BUY").alias("Txn_Type"),
        F.col("Avg_Price").alias("Price"),
        midnight(F.col("p_date")).alias("Txn_Time"),
        "p_date",
        F.date_add("p_date", 1).alias("run_date"),
    )
    return entries.unionByName(opening)


def buys_positive() -> Column:
    """Amount with every non-buy negated, whatever sign it already has."""
    return F.when(F.col("Txn_Type") == "BUY", F.col("Amount")).otherwise(-F.col("Amount"))


def running_position(events: DataFrame, keys: list[str], moved: Column, bucket: str | None = "minute") -> DataFrame:
    """Append the running amount and the running value (amount times price) per key."""
    sums = {"Running_Amount": moved, "Running_Value": moved * F.col("Price")}
    return running_sums(events, keys, "Txn_Time", sums, bucket)


def signed_balance(events: DataFrame, moved: Column, change_day: Column) -> DataFrame:
    """Balance per holding, and the part of it that comes from rows of ``change_day``."""
    return events.groupBy(*KEYS).agg(
        F.sum(moved).alias("Amount"),
        F.sum(F.when(change_day, moved).otherwise(0.0)).alias("Daily_Amount_Change"),
    )


def _holdings(events: DataFrame, moved: Column, sold: Column, change_day: Column, bucket: str | None) -> DataFrame:
    """Balances, realised gain and closing position from one pass over the day's events.

    All figures share the key, so one aggregation serves them all; the latest position is
    a ``max_by``, which needs no further sort.
    """
    gain = sold * (F.col("Price") - F.try_divide("Running_Value", "Running_Amount"))
    return (
        running_position(events, KEYS, moved, bucket)
        .groupBy(*KEYS)
        .agg(
            F.sum(moved).alias("Amount"),
            F.sum(F.when(change_day, moved).otherwise(0.0)).alias("Daily_Amount_Change"),
            F.sum(F.when(F.col("Txn_Type") == "SELL", gain).otherwise(0.0)).alias("Realised_Gain"),
            F.max_by("Running_Amount", "Txn_Time").alias("Running_Amount"),
            F.max_by("Running_Value", "Txn_Time").alias("Running_Value"),
        )
    )


def _priced(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    quotes = prices.select("run_date", F.col("Stock_Code").alias("Ticker"), "Actual_Price")
    return holdings.join(quotes, ["run_date", "Ticker"], "left")


def portfolio_snapshot(
    ledger: DataFrame,
    snapshot: DataFrame,
    prices: DataFrame,
    ds: dt.date | None = None,
    bucket: str | None = "minute",
) -> DataFrame:
    """Snapshot with the published figures; ``ledger`` holds signed amounts."""
    events = holdings_events(ledger, snapshot, ds)
    before = F.col("p_date") < F.col("run_date")
    holdings = _holdings(events, buys_positive(), F.col("Amount"), before, bucket).withColumn(
        "Avg_Price", F.try_divide("Running_Amount", "Running_Value")
    )
    return _priced(holdings, recent_prices(prices, ds)).select(
        "Analyst",
        "Ticker",
        "Amount",
        "Daily_Amount_Change",
        "Realised_Gain",
        ((F.col("Avg_Price") - F.col("Actual_Price")) * F.col("Amount")).alias("Unrealised_Gain"),
        F.col("run_date").alias("p_date"),
        "Avg_Price",
    )


def portfolio_snapshot_intent(
    ledger: DataFrame,
    snapshot: DataFrame,
    prices: DataFrame,
    ds: dt.date | None = None,
    bucket: str | None = "minute",
) -> DataFrame:
    """Snapshot with the figures the column names promise."""
    events = holdings_events(ledger, snapshot, ds)
    today = F.col("p_date") == F.col("run_date")
    holdings = _holdings(events, F.col("Amount"), -F.col("Amount"), today, bucket).withColumn(
        "Avg_Price", F.try_divide("Running_Value", "Running_Amount")
    )
    return _finish_intent(holdings, latest_price(prices, ds))


def _finish_intent(holdings: DataFrame, quotes: DataFrame) -> DataFrame:
    return _priced(holdings, quotes).select(
        "Analyst",
        "Ticker",
        "Amount",
        "Daily_Amount_Change",
        "Realised_Gain",
        ((F.col("Actual_Price") - F.col("Avg_Price")) * F.col("Amount")).alias("Unrealised_Gain"),
        F.col("run_date").alias("p_date"),
        "Avg_Price",
    )


def portfolio_history(
    raw: DataFrame, prices: DataFrame, last_day: dt.date, chunk_rows: int | None = ledger_fold.CHUNK_ROWS, bucket: str | None = "minute"
) -> DataFrame:
    """Every day's ``portfolio_snapshot_intent`` from an empty start to ``last_day``, as one job.

    Each day's snapshot feeds the next day's, but only within a holding, and what is carried
    is a balance and a value.  So the recursion turns into: one fold for validity over the
    whole history, day totals, and window sums over the day rows - the value restarts after
    a day that closed at zero, because an empty holding carries no average price.
    """
    entries = signed_entries(raw).where(F.col("p_date") <= F.lit(last_day))
    holding = ["Analyst", "Ticker"]
    flagged = ledger_fold.accept_flags(
        entries, holding, ["p_date", "Txn_Time", "Txn_Type", "Txn_Id", "Amount", "Price"], "Amount", "Txn_Time", chunk_rows=chunk_rows
    )
    # Three aggregations read the accepted entries; staged, the fold runs once.
    accepted = materialise(flagged.where("Is_Valid").drop("Is_Valid", "Txn_Id"))
    moved, value = F.col("Amount"), F.col("Amount") * F.col("Price")

    by_day = Window.partitionBy(*holding).orderBy("p_date")
    since_reset = Window.partitionBy(*holding, "_era").orderBy("p_date")
    day_rows = materialise(
        accepted.groupBy(*holding, "p_date")
        .agg(F.sum(moved).alias("day_amount"), F.sum(value).alias("day_value"))
        .withColumn("close_amount", F.sum("day_amount").over(by_day))
        .withColumn("open_amount", F.lag("close_amount", 1, 0.0).over(by_day))
        .withColumn("_era", F.sum(F.when(F.col("open_amount") == 0, 1).otherwise(0)).over(by_day))
        .withColumn("close_value", F.sum("day_value").over(since_reset))
        .withColumn("open_value", F.lag("close_value", 1, 0.0).over(since_reset))
    )

    # Within the day: position after each entry, on top of the day's opening.
    opening = day_rows.select(*holding, "p_date", "open_amount", "open_value")
    position = running_sums(
        accepted, [*holding, "p_date"], "Txn_Time", {"_amount": moved, "_value": value}, bucket
    ).join(opening, [*holding, "p_date"])
    cost = F.try_divide(F.col("open_value") + F.col("_value"), F.col("open_amount") + F.col("_amount"))
    realised = position.groupBy(*holding, "p_date").agg(
        F.sum(F.when(F.col("Txn_Type") == "SELL", -moved * (F.col("Price") - cost)).otherwise(0.0)).alias("gain")
    )

    # A holding stays in the snapshot on days without entries.
    until = F.coalesce(F.date_sub(F.lead("p_date").over(by_day), 1), F.lit(last_day))
    dense = (
        day_rows.withColumn("_until", until)
        .join(realised, [*holding, "p_date"], "left")
        .withColumn("run_date", F.explode(F.sequence("p_date", "_until")))
        .withColumn("_today", F.col("run_date") == F.col("p_date"))
    )
    holdings = dense.select(
        "run_date",
        *holding,
        F.col("close_amount").alias("Amount"),
        F.when(F.col("_today"), F.col("day_amount")).otherwise(0.0).alias("Daily_Amount_Change"),
        F.when(F.col("_today"), F.coalesce("gain", F.lit(0.0))).otherwise(0.0).alias("Realised_Gain"),
        F.try_divide("close_value", "close_amount").alias("Avg_Price"),
    )
    return _finish_intent(holdings, latest_price(prices))
