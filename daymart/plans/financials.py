"""Financial statistics: from pages to raw rows to typed rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.dates import as_date
from daymart.functions.numbers import parse_magnitude, parse_percent, parse_ratio
from daymart.schemas import FINANCIALS, table_schema
from daymart.sinks.load import enforce
from daymart.sources import html
from daymart.sources.day_tables import on_day


def financials_raw(pages: DataFrame, ticker: str, page: str, ds: dt.date | str) -> DataFrame:
    """One row per ticker from all key/value tables of its statistics page.

    A page without such tables gives no row; ``unreadable_pages`` names its ticker.
    """
    names = [name for name, _ in FINANCIALS]
    parsed = _parsed(pages, ticker, page).where(F.size("_pairs") > 0)
    values = parsed.select("Ticker", html.first_values(F.col("_pairs"), names).alias("_values"))
    wide = values.select(F.lit(as_date(ds)).alias("p_date"), "Ticker", *html.wide(F.col("_values"), names))
    numbers = [f.name for f in table_schema("financials_raw").fields if f.dataType.simpleString() == "double"]
    return enforce(
        wide.withColumns({n: F.col(n).try_cast("double") for n in numbers}), table_schema("financials_raw")
    )


def financials_routed(pages: DataFrame, ticker: str, page: str) -> DataFrame:
    """All of the pages in one pass, ``route`` naming the table of a row: the wide row of a page under ``financials_raw``; a page without
    statistics, and each statistic without a column (``name, value``), under ``financials_rejects``."""
    names = [name for name, _ in FINANCIALS]
    kinds = table_schema("financials_raw")
    entry = "struct<name: string, value: string>"
    unknown = F.filter("_pairs", lambda p: ~p["name"].isin(names))
    each = F.concat(F.array(F.lit(None).cast(entry)), unknown)
    parsed = _parsed(pages, ticker, page).withColumn("_values", html.first_values(F.col("_pairs"), names))
    rows = parsed.select("Ticker", "_pairs", "_values", F.posexplode_outer(each).alias("_place", "_entry"))
    own = (F.col("_place") == 0) & (F.size("_pairs") > 0)
    values = [F.when(own, value).try_cast(kinds[name].dataType).alias(name) for name, value in zip(names, html.wide(F.col("_values"), names))]
    return rows.select(
        "Ticker",
        *values,
        F.col("_entry")["name"].alias("name"),
        F.col("_entry")["value"].alias("value"),
        F.when(own, "financials_raw").otherwise("financials_rejects").alias("route"),
    )


def unreadable_pages(pages: DataFrame, ticker: str, page: str) -> DataFrame:
    """Tickers whose page holds no statistics."""
    return _parsed(pages, ticker, page).where(F.size("_pairs") <= 0).select("Ticker")


def unknown_labels(pages: DataFrame, ticker: str, page: str) -> DataFrame:
    """Statistics found on the pages under names that the table has no column for.

    The outer form of the explosion, whose empty row the filter on the name drops: from the plain form Spark infers a filter on the
    size of the parsed array, which then meets every column that a caller computes from the page and keeps planning busy.
    """
    names = [name for name, _ in FINANCIALS]
    found = _parsed(pages, ticker, page).select("Ticker", F.explode_outer("_pairs").alias("_pair"))
    return found.select("Ticker", F.col("_pair")["name"].alias("name"), F.col("_pair")["value"].alias("value")).where(
        ~F.col("name").isin(names)
    )


def _parsed(pages: DataFrame, ticker: str, page: str) -> DataFrame:
    pairs = F.coalesce(html.key_values(F.col(page)), F.array().cast("array<struct<name: string, value: string>>"))
    # Exploded from an array of one, so that a filter on the pairs stays above and a page is parsed once.
    return pages.select(F.col(ticker).alias("Ticker"), F.explode(F.array(pairs)).alias("_pairs"))


_PARSERS = {
    "magnitude": parse_magnitude,
    "percent": parse_percent,
    "ratio": parse_ratio,
    "text_number": lambda value: value.try_cast("double"),
}


def financials_clean(raw: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """Raw statistics as numbers; the date-like columns are dropped.

    Columns of one kind are parsed as one array.  Fifty parsers side by side would make a
    generated method too large for the JVM to compile; an array keeps it small.
    """
    kept = [(name, kind) for name, kind in FINANCIALS if kind != "dropped"]
    texts = {k: [name for name, kind in kept if kind == k] for k in _PARSERS}
    parsed = on_day(raw, ds).select(
        "p_date",
        "Ticker",
        *[name for name, kind in kept if kind == "number"],
        *[F.transform(F.array(*names), _PARSERS[k]).alias(f"_{k}") for k, names in texts.items()],
    )

    def value(name: str, kind: str) -> Column:
        if kind == "number":
            return F.col(name)
        if kind == "number_ratio":
            # Already a number when it gets here, and only text counts as a ratio: always NULL.
            return F.lit(None).cast("double").alias(name)
        return F.col(f"_{kind}")[texts[kind].index(name)].alias(name)

    return enforce(parsed.select("p_date", "Ticker", *[value(*c) for c in kept]), table_schema("financials"))


def pivot_key_values(rows: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Key/value rows -> one wide row per key.  The names are given, which saves the job that
    would look them up; the smallest value stands where a key repeats a name."""
    return rows.groupBy(key).pivot(name, names).agg(F.min(value))


def join_requested(requested: DataFrame, received: DataFrame, key: str = "Ticker") -> DataFrame:
    """Requested keys and received rows, whichever side has them; the key is merged."""
    return requested.join(received, key, "full")
