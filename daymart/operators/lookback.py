"""The price known on a run date: looked for in the last days, because days without
trading have no price rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.operators.asof import asof_merge

LOOKBACK_DAYS = 7  # both ends count, so eight days


def _visible(prices: DataFrame, ds: dt.date | None, days: int) -> DataFrame:
    """Each price under every run date that can see it; turns the range condition into an
    equality, at a fixed factor of ``days + 1``."""
    prices = prices.select("Stock_Code", "Close", "p_date")
    if ds is not None:
        return prices.where(
            F.col("p_date").between(F.lit(ds - dt.timedelta(days=days)), F.lit(ds))
        ).withColumn("run_date", F.lit(ds))
    reach = F.sequence(F.col("p_date"), F.date_add("p_date", days))
    return prices.withColumn("run_date", F.explode(reach))


def recent_prices(prices: DataFrame, ds: dt.date | None = None, days: int = LOOKBACK_DAYS) -> DataFrame:
    """``run_date, Stock_Code, Actual_Price``: every distinct close of the window - the
    grouping by day makes each day its own latest, so all of them stay."""
    return (
        _visible(prices.select("Stock_Code", "Close", "p_date").distinct(), ds, days)
        .select("run_date", "Stock_Code", "p_date", F.col("Close").alias("Actual_Price"))
    )


def latest_price(prices: DataFrame, ds: dt.date | None = None, days: int = LOOKBACK_DAYS) -> DataFrame:
    """``run_date, Stock_Code, Actual_Price``: the close of the latest day in the window."""
    return (
        _visible(prices, ds, days)
        .groupBy("run_date", "Stock_Code")
        .agg(F.max_by("Close", "p_date").alias("Actual_Price"), F.max("p_date").alias("p_date"))
    )


def with_latest_price(held: DataFrame, prices: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows with ``run_date`` and ``Ticker`` and the ``price_date`` and ``Actual_Price`` of ``latest_price``; no price is copied."""
    quotes = prices.select(F.col("Stock_Code").alias("Ticker"), F.col("p_date").alias("price_date"), F.col("Close").alias("Actual_Price"))
    return asof_merge(held, quotes, ["Ticker"], "run_date", "price_date", ["Actual_Price"], days)
