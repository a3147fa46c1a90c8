"""Landed source files to the raw and dimension tables, one function per feed.

Each returns typed rows of the run date, ready for ``sinks.day_partitions.overwrite_day``.
On days without trading the price feeds give an empty but typed result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import as_date, epoch_date
from daymart.functions.text import strip_suffix
from daymart.operators.calendar import trading_days_only
from daymart.plans.prices import wide_prices_to_long
from daymart.plans.sentiment import FORUM_SOURCE
from daymart.schemas import table_schema
from daymart.sinks.load import enforce
from daymart.sources.day_tables import on_day
from daymart.sources.html import news_items
from daymart.sources.payloads import dated_rate, intraday_points, page_records

# The fields of the vendor's price frame.
VENDOR_FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]


def primary_prices(file_rows: DataFrame, holidays: DataFrame) -> DataFrame:
    """Rows of the exchange's daily file (see ``landed_files.read_price_file``)."""
    return enforce(trading_days_only(file_rows, "p_date", holidays), table_schema("primary_prices"))


def backup_prices(wide: DataFrame, tickers: list[str], ds: dt.date | str, holidays: DataFrame) -> DataFrame:
    """The vendor's wide frame, one column per ticker and field, as one row per ticker."""
    long = wide_prices_to_long(wide, [], tickers, VENDOR_FIELDS)
    stamped = long.withColumns({"p_date": F.lit(as_date(ds)), "Ticker": strip_suffix(F.col("Ticker"))})
    return enforce(trading_days_only(stamped, "p_date", holidays), table_schema("backup_prices"))


def exchange_rates(payloads: DataFrame, currency: str, payload: str, ds: dt.date | str) -> DataFrame:
    """One payload per currency -> that currency's rate on the run date."""
    day = F.lit(as_date(ds))
    rates = payloads.select(
        F.col(currency).alias("Currency"), dated_rate(F.col(payload), day).alias("Rate"), day.alias("p_date")
    )
    return enforce(rates, table_schema("exchange_rates"))


def stock_list(pages: DataFrame, payload: str, fields: list[str], ds: dt.date | str) -> DataFrame:
    """All pages of the security list.  ``fields`` names the payload's fields in their order;
    they become the table's columns by position."""
    table = table_schema("stock_list")
    columns = [f for f in table.fields if f.name != "p_date"]
    record = T.StructType([T.StructField(name, f.dataType) for name, f in zip(fields, columns, strict=True)])
    rows = page_records(pages, payload, record).toDF(*[f.name for f in columns])
    return enforce(rows.withColumn("p_date", F.lit(as_date(ds))), table)


def intraday_chart(payloads: DataFrame, payload: str, ds: dt.date | str) -> DataFrame:
    """Points of the day's charts, all stocks."""
    table = table_schema("intraday_chart")
    point = T.StructType([f for f in table.fields if f.name != "p_date"])
    rows = intraday_points(payloads, payload, point)
    return enforce(rows.withColumn("p_date", F.lit(as_date(ds))), table)


def news(pages: DataFrame, html: str, ticker: str, url: str, ds: dt.date | str) -> DataFrame:
    """News of the run date; cleaning and de-duplication follow in ``sentiment.news_table``."""
    return enforce(on_day(news_items(pages, html, ticker, url), ds), table_schema("news_items"))


def forum_posts(posts: DataFrame, forum: str, title: str, seconds: str) -> DataFrame:
    """Submissions with their forum and UTC day from an epoch stamp."""
    rows = posts.select(
        F.concat(F.lit(FORUM_SOURCE), F.col(forum)).alias("source"),
        F.col(title).alias("title"),
        epoch_date(F.col(seconds)).alias("p_date"),
    )
    return enforce(rows, table_schema("forum_posts"))
