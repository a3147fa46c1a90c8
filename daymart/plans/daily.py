"""What runs each day, and reruns of a range of days.

Every step first checks that the days it reads were written (a day without rows counts, a day that never was does not),
reads partitions, computes one frame and replaces one partition, so it can be repeated at any time with the same result.  The
order within a day is the order of the functions here; only ledger and portfolio also need the day before, unless the
day is named as the first one.  What an ingest step cannot use goes to a ``*_rejects`` table of the same day, and what belongs to another day,
such as posts around a local midnight, to ``*_other_days``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import partial, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.dates import epoch_date
from daymart.operators.ledger_fold import CHUNK_ROWS
from daymart.operators.lookback import LOOKBACK_DAYS
from daymart.plans import feeds, financials, marts, sentiment
from daymart.plans.ledger import validated_ledger
from daymart.plans.portfolio import portfolio_snapshot, portfolio_snapshot_intent
from daymart.plans.prices import daily_prices
from daymart.schemas import table_schema
from daymart.sources import landed_files
from daymart.sources.day_tables import on_day
from daymart.sources.html import news_items
from daymart.sources.payloads import dated_rate
from daymart.warehouse import Warehouse


def _step(function: Callable) -> Callable:
    """A step's tables become visible together, when all of them are written."""

    @wraps(function)
    def run(warehouse: Warehouse, *args, **kwargs):
        with warehouse.step():
            return function(warehouse, *args, **kwargs)

    return run


def _ingest_texts(
    warehouse: Warehouse, rows: DataFrame, table: str, kind: str, complete: Column, clean: Callable[[DataFrame], DataFrame], texts: list[str],
    same: list[str], order: list[str], aside: list[str], ds: dt.date,
) -> None:
    """Cleaned texts of the day, the first of equal ones, to ``table``; incomplete rows to ``<kind>_rejects`` and rows of other days
    to ``<kind>_other_days``, both with their texts as they came.  Decided once and written by one job."""
    route = F.when(~complete, f"{kind}_rejects").when(F.col("p_date").eqNullSafe(F.lit(ds)), table).otherwise(f"{kind}_other_days")
    own = F.col("route") == table
    routed = rows.select("*", F.struct(*texts).alias("_came"), route.alias("route"))
    first = sentiment.first_posts(clean(routed), same, order, own)
    kept = first.withColumns({t: F.when(own, F.col(t)).otherwise(F.col("_came")[t]) for t in texts})
    own_day = kept.withColumn("own_date", F.col("p_date"))
    tables = {table: None, f"{kind}_rejects": aside, f"{kind}_other_days": [*aside, "own_date"]}
    warehouse.write_routed(own_day, tables, ds)


@_step
def ingest_prices(warehouse: Warehouse, path: str, holidays: DataFrame, ds: dt.date) -> None:
    """The exchange's landed price file."""
    rows = landed_files.read_price_file(warehouse.spark, path, ds, table_schema("primary_prices"))
    warehouse.write("primary_prices", feeds.primary_prices(rows, holidays), ds)


@_step
def ingest_backup_prices(warehouse: Warehouse, wide: DataFrame, tickers: list[str], holidays: DataFrame, ds: dt.date) -> None:
    warehouse.write("backup_prices", feeds.backup_prices(wide, tickers, ds, holidays), ds)


@_step
def ingest_rates(warehouse: Warehouse, payloads: DataFrame, currency: str, payload: str, ds: dt.date) -> None:
    """Rates of the day; currencies whose payload has none are rejects.  One job parses the payloads and writes both."""
    rated = payloads.select(
        F.col(currency).alias("Currency"), F.col(payload).alias("payload"), dated_rate(F.col(payload), F.lit(ds)).alias("Rate")
    )
    route = F.when(F.col("Rate").isNotNull(), "exchange_rates").otherwise("exchange_rates_rejects")
    tables = {"exchange_rates": None, "exchange_rates_rejects": ["Currency", "payload"]}
    warehouse.write_routed(rated.withColumn("route", route), tables, ds)


@_step
def ingest_stock_list(warehouse: Warehouse, path: str, fields: list[str], ds: dt.date) -> None:
    """All landed pages of the security list."""
    pages = landed_files.read_pages(warehouse.spark, path)
    warehouse.write("stock_list", feeds.stock_list(pages, "payload", fields, ds), ds)


@_step
def ingest_charts(warehouse: Warehouse, path: str, ds: dt.date) -> None:
    pages = landed_files.read_pages(warehouse.spark, path)
    warehouse.write("intraday_chart", feeds.intraday_chart(pages, "payload", ds), ds)


@_step
def ingest_financials(warehouse: Warehouse, pages: DataFrame, ticker: str, page: str, ds: dt.date) -> None:
    """Statistics pages; pages without statistics and statistics without a column are rejects.  A page is parsed once."""
    tables = {"financials_raw": None, "financials_rejects": ["Ticker", "name", "value"]}
    warehouse.write_routed(financials.financials_routed(pages, ticker, page), tables, ds)


@_step
def ingest_social(warehouse: Warehouse, posts: DataFrame, ds: dt.date, newest: int | None = None) -> None:
    """Posts found by search words (``keyword, content, created, seq``) to the day's clean table; with ``newest``
    only that many of each word."""
    dated = posts.withColumn("p_date", F.to_date("created"))
    if newest is not None:
        today = sentiment.newest_per_keyword(on_day(dated, ds), ["keyword", "p_date"], "created", "seq", newest)
        dated = today.unionByName(dated.where(~F.col("p_date").eqNullSafe(F.lit(ds))))
    tagged = sentiment.tag_by_keyword(dated, "keyword")
    complete = F.col("ticker").isNotNull() & F.col("content").isNotNull()
    aside = ["keyword", "content", "seq", "created"]
    texts = ["content", "ticker", "source"]
    _ingest_texts(warehouse, tagged, "social_posts", "social", complete, sentiment.clean_social, texts, sentiment.SAME_SOCIAL, ["seq"], aside, ds)


@_step
def ingest_news(warehouse: Warehouse, pages: DataFrame, html: str, ticker: str, url: str, ds: dt.date) -> None:
    """News pages to the day's clean table; items whose date cannot be read are rejects."""
    found = news_items(pages, html, ticker, url)
    complete, texts = F.col("p_date").isNotNull(), ["title", "description"]
    aside = ["item_no", "ticker", "title", "source", "description", "url"]
    _ingest_texts(warehouse, found, "news_items", "news", complete, sentiment.clean_news, texts, sentiment.SAME_NEWS, ["url", "item_no"], aside, ds)


@_step
def ingest_forum(warehouse: Warehouse, posts: DataFrame, tagged: DataFrame, ds: dt.date) -> None:
    """Forum posts (``forum, title, seconds``) and posts under the hashtag (``content, created``) to one clean table.

    The earliest of equal texts of the day stays.
    """
    stamp = F.timestamp_seconds("seconds").cast("timestamp_ntz")
    forum = posts.select(
        F.concat(F.lit(sentiment.FORUM_SOURCE), "forum").alias("source"), "title", epoch_date(F.col("seconds")).alias("p_date"),
        stamp.alias("created"),
    )
    hashtag = tagged.select(
        F.lit(sentiment.HASHTAG_SOURCE).alias("source"), F.col("content").alias("title"), F.to_date("created").alias("p_date"), "created"
    )
    rows = sentiment.union_sources(forum, hashtag)
    complete = F.col("source").isNotNull() & F.col("title").isNotNull()
    aside, order = ["source", "title", "created"], ["created", "source"]
    _ingest_texts(warehouse, rows, "forum_posts", "forum", complete, sentiment.clean_forum, ["title"], sentiment.SAME_FORUM, order, aside, ds)


@_step
def run_prices(warehouse: Warehouse, ds: dt.date) -> None:
    names = ("primary_prices", "backup_prices", "exchange_rates")
    warehouse.require(*((n, ds) for n in names))
    warehouse.write("stock_prices", daily_prices(*(warehouse.read(n, ds) for n in names), ds), ds)


@_step
def run_financials(warehouse: Warehouse, ds: dt.date) -> None:
    warehouse.require(("financials_raw", ds), ("stock_prices", ds))
    warehouse.write("financials", financials.financials_clean(warehouse.read("financials_raw", ds), ds), ds)
    mart = marts.mart_prices_financials(warehouse.read("stock_prices", ds), warehouse.read("financials", ds), ds)
    warehouse.write_mart("mart_prices_financials", mart, ds)


def _yesterday(warehouse: Warehouse, ds: dt.date, first_day: dt.date | None, *needed: str) -> DataFrame:
    before = ds - dt.timedelta(days=1)
    starts = ds == first_day
    warehouse.require(*((n, ds) for n in needed), *([] if starts else [("portfolio_snapshot", before)]))
    return warehouse.read("portfolio_snapshot", before, allow_absent=starts)


@_step
def run_ledger(warehouse: Warehouse, ds: dt.date, first_day: dt.date | None = None, chunk_rows: int | None = CHUNK_ROWS) -> None:
    """``first_day`` names the start of history, the only day that needs no snapshot before it; holdings with more
    than ``chunk_rows`` entries on the day are validated in parallel chunks."""
    yesterday = _yesterday(warehouse, ds, first_day, "ledger_raw")
    warehouse.write("ledger", validated_ledger(warehouse.read("ledger_raw", ds), yesterday, ds, chunk_rows), ds)


@_step
def run_portfolio(
    warehouse: Warehouse,
    ds: dt.date,
    employees: DataFrame | None = None,
    intent: bool = False,
    first_day: dt.date | None = None,
) -> None:
    """Snapshot from the day's validated ledger and yesterday's snapshot, which is read back
    from its partition: lineage never grows with the number of days.  Prices may be absent on any day."""
    yesterday = _yesterday(warehouse, ds, first_day, "ledger")
    snapshot = portfolio_snapshot_intent if intent else portfolio_snapshot
    prices = warehouse.read_range("stock_prices", ds - dt.timedelta(days=LOOKBACK_DAYS), ds)
    warehouse.write("portfolio_snapshot", snapshot(warehouse.read("ledger", ds), yesterday, prices, ds), ds)
    if employees is not None:
        mart = marts.mart_portfolio(warehouse.read("portfolio_snapshot", ds), employees, ds)
        warehouse.write_mart("mart_portfolio", mart, ds)


@_step
def run_sentiment(warehouse: Warehouse, ds: dt.date, lexicon: sentiment.Lexicon) -> None:
    """Scores and rollup; a lexicon given as a mapping travels in the plan, a table is joined."""
    warehouse.require(*((n, ds) for n in ("social_posts", "news_items", "forum_posts", "stock_list")))
    forum_score = "NLTK_SIA_compound_score"
    for table, target, text, score in (
        ("social_posts", "social_scored", "content", "NLTK_score"),
        ("news_items", "news_scored", "description", "NLTK_score"),
        ("forum_posts", "forum_scored", "title", forum_score),
    ):
        warehouse.write(target, sentiment.score_posts(warehouse.read(table, ds), text, lexicon, score), ds)
    scored = (warehouse.read(n, ds) for n in ("social_scored", "news_scored", "forum_scored", "stock_list"))
    warehouse.write("sentiment_daily", sentiment.sentiment_rollup(*scored, ds), ds)
    mart = marts.mart_sentiment(warehouse.read("sentiment_daily", ds), ds)
    warehouse.write_mart("mart_sentiment", mart, ds)


def run_range(first: dt.date, last: dt.date, *steps: Callable[[dt.date], None]) -> None:
    """All steps of a day, then the next day.

    This is the daily schedule replayed.  To rebuild the portfolio history from nothing, use
    ``portfolio.portfolio_history``, which needs no day order.
    """
    day = first
    while day <= last:
        for step in steps:
            step(day)
        day += dt.timedelta(days=1)


def run_stale(warehouse: Warehouse, first: dt.date, last: dt.date, steps: Mapping[str, Callable[[dt.date], None]]) -> list[tuple[str, dt.date]]:
    """As ``run_range``, but only where it changes anything; what was run.

    ``steps`` names a table that each step writes, in the order of a day.  A step runs on a day that it never wrote or of whose inputs one
    is another now.  A day that comes out as it was, in whatever order of rows, leaves those behind it alone, so a change goes as far as it
    has effects, along later days where a step reads the day before.
    """
    done = []

    def step(table: str, ds: dt.date) -> None:
        if warehouse.outdated(table, ds):
            steps[table](ds)
            done.append((table, ds))

    run_range(first, last, *[partial(step, table) for table in steps])
    return done
