"""Consolidated daily prices in one currency."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.sources.day_tables import on_day


def with_rate(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Append the day's ``Rate`` of each row's ``Currency`` (NULL if there is none)."""
    return rows.join(rates.select("p_date", "Currency", "Rate"), ["p_date", "Currency"], "left")


def priority_merge(
    primary: DataFrame, backup: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """Rows of either source; each value comes from the primary unless it is NULL there."""
    first, second = primary.alias("first"), backup.alias("second")
    same = [F.col(f"first.{k}") == F.col(f"second.{k}") for k in keys]
    either = [F.coalesce(F.col(f"first.{c}"), F.col(f"second.{c}")).alias(c) for c in [*keys, *values]]
    return first.join(second, same, "full").select(*either)


def _untraded(volume: str, last: str, price: str) -> Column:
    """Without trades the file has zeros, so the last known price stands in."""
    return F.when(F.col(volume) == 0, F.col(last)).otherwise(F.col(price))


def daily_prices(
    primary: DataFrame, backup: DataFrame, rates: DataFrame, ds: dt.date | None = None
) -> DataFrame:
    """Exchange prices with the backup feed behind them, both converted by the day's rates.

    The backup feed names no currency: it takes the one of the primary row with the same
    code, so a code that the primary lacks gets NULL prices but keeps its row and volume.
    """
    primary, backup, rates = (on_day(t, ds) for t in (primary, backup, rates))
    rated, rate = with_rate(primary, rates), F.col("Rate")

    # The rate, not the currency, is handed to the backup rows: they then stay partitioned by
    # code from this join to the final one.
    quoted = rated.select("p_date", F.col("Stock_Code").alias("Ticker"), "Rate")
    second = backup.join(quoted, ["p_date", "Ticker"], "left").select(
        "p_date",
        F.col("Ticker").alias("Stock_Code"),
        F.col("Ticker").alias("Stock_Name"),
        *[(F.col(c) * rate).alias(c) for c in ("Open", "Close", "High", "Low")],
        "Volume",
    )
    first = rated.select(
        "p_date",
        "Stock_Code",
        "Stock_Name",
        (_untraded("Volume", "Last", "Open") * rate).alias("Open"),
        (F.col("Last") * rate).alias("Close"),
        (_untraded("Volume", "Last", "High") * rate).alias("High"),
        (_untraded("Volume", "Last", "Low") * rate).alias("Low"),
        "Volume",
    )
    return priority_merge(
        first, second, ["p_date", "Stock_Code"], ["Stock_Name", "Open", "Close", "High", "Low", "Volume"]
    )


def currencies_in_use(primary: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """The currencies for which a rate is needed."""
    return on_day(primary, ds).select("p_date", "Currency").distinct()


def wide_prices_to_long(wide: DataFrame, keep: list[str], tickers: list[str], fields: list[str], sep: str = "|") -> DataFrame:
    """Columns named ``<ticker>|<field>`` -> one row per ticker, without a shuffle.

    Tickers that are empty in a row leave no row.
    """

    def entry(ticker: str) -> Column:
        values = [F.col(f"`{ticker}{sep}{f}`").alias(f.replace(" ", "_")) for f in fields]
        return F.struct(F.lit(ticker).alias("Ticker"), *values)

    long = wide.select(*keep, F.explode(F.array(*[entry(t) for t in tickers])).alias("_t")).select(*keep, "_t.*")
    return long.dropna("all", subset=[f.replace(" ", "_") for f in fields])
