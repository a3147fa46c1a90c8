"""Marts: what reports read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.functions.text import with_suffix
from daymart.schemas import FINANCIAL_MEASURES
from daymart.sources.day_tables import on_day


def mart_portfolio(snapshot: DataFrame, employees: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """Snapshot rows with the analyst's name and address, if known."""
    people = employees.select(F.col("Employee_Id").alias("Analyst"), "First_Name", "Last_Name", "Email")
    return on_day(snapshot, ds).join(people, "Analyst", "left").select(
        "Analyst", "First_Name", "Last_Name", "Email", "Ticker", "Amount", "Daily_Amount_Change", "Realised_Gain",
        "Unrealised_Gain", "p_date",
    )


def mart_sentiment(sentiment: DataFrame, ds: dt.date | None = None) -> DataFrame:
    return on_day(sentiment, ds).select(
        "p_date", "ticker", "company_name", "combined_sentiment_score_ticker", "benchmark_score_for_today_market",
        "overall_sentiment_for_ticker",
    )


def mart_prices_financials(prices: DataFrame, financials: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """Prices and financial statistics side by side, rows of either kept.

    Published as it has always been: a row that has statistics only carries its suffixed
    ticker as ``Stock_Code``, the price-to-book ratio appears as ``Enterprise_valuerevenue``
    (the real one does not appear), and duplicated codes in the prices repeat the statistics.
    """
    prices, financials = on_day(prices, ds), on_day(financials, ds)
    listed = prices.select("p_date", with_suffix(F.col("Stock_Code")).alias("Ticker"))
    stats = financials.join(listed, ["p_date", "Ticker"], "left").alias("stats")
    quotes = prices.withColumn("_ticker", with_suffix(F.col("Stock_Code"))).alias("quotes")
    same = (F.col("stats.Ticker") == F.col("quotes._ticker")) & (F.col("stats.p_date") == F.col("quotes.p_date"))

    measures = []
    for name in FINANCIAL_MEASURES:
        if name == "Pricebook__mrq_":
            measures.append(F.col("stats.Pricebook__mrq_").alias("Enterprise_valuerevenue"))
        elif name != "Enterprise_valuerevenue":
            measures.append(F.col(f"stats.{name}"))
    return stats.join(quotes, same, "full").select(
        F.coalesce("stats.p_date", "quotes.p_date").alias("p_date"),
        F.coalesce("quotes.Stock_Code", "stats.Ticker").alias("Stock_Code"),
        F.coalesce("quotes.Stock_Name", "stats.Ticker").alias("Stock_Name"),
        *[F.col(f"quotes.{c}") for c in ("Open", "Close", "High", "Low", "Volume")],
        *measures,
    )
