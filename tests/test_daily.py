"""One day through all tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymart.plans import daily
from daymart.schemas import FINANCIALS, table_schema
from daymart.warehouse import MissingDay, Warehouse

DAY = dt.date(2022, 4, 4)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def put(warehouse, name, *records):
    """Write records given by name; absent fields are missing."""
    schema = table_schema(name)
    values = [tuple({"p_date": DAY, **r}.get(f.name) for f in schema.fields) for r in records]
    warehouse.write(name, warehouse.spark.createDataFrame(values, warehouse_nullable(schema)), DAY)


def warehouse_nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def priced(code, last, volume=10):
    numbers = dict.fromkeys(("High", "Low", "Open", "Change", "Bid", "Offer", "DClose"), last)
    return {"Trade_Date": DAY, "Stock_Name": code + " Ltd", "Currency": "USD", "Last": last, "Volume": volume,
            "Market": "M", "Value": 1, "Stock_Code": code, **numbers}


def test_prices_financials_and_portfolio(warehouse, rows):
    put(warehouse, "primary_prices", priced("D05", 2.0), priced("U11", 3.0, 0))
    put(warehouse, "backup_prices", {"Ticker": "D05", "Close": 9.0}, {"Ticker": "X", "Close": 9.0, "Volume": 4})
    put(warehouse, "exchange_rates", {"Currency": "USD", "Rate": 1.5})
    daily.run_prices(warehouse, DAY)
    got = {r.Stock_Code: (r.Close, r.Volume) for r in warehouse.read("stock_prices", DAY).collect()}
    assert got == {"D05": (3.0, 10), "U11": (4.5, 0), "X": (None, 4)}

    text = {name: "1.5M" for name, kind in FINANCIALS if kind == "magnitude"}
    put(warehouse, "financials_raw", {"Ticker": "D05.SI", "Pricebook__mrq_": 1.2, **text}, {"Ticker": "Q.SI"})
    daily.run_financials(warehouse, DAY)
    mart = warehouse.spark.read.parquet(warehouse.path("mart_prices_financials"))
    got = {r.Stock_Code: (r.Close, r.EBITDA, r.Enterprise_valuerevenue) for r in mart.collect()}
    assert got["D05"] == (3.0, 1.5e6, 1.2) and got["Q.SI"] == (None, 0.0, None) and got["U11"] == (4.5, None, None)

    at = dt.datetime(2022, 4, 4, 10)
    entry = {"Analyst": 1, "Ticker": "D05", "Price": 2.0, "Amount": 10.0}
    put(warehouse, "ledger_raw", {**entry, "Txn_Type": "BUY", "Txn_Time": at},
        {**entry, "Txn_Type": "SELL", "Amount": 11.0, "Txn_Time": at + dt.timedelta(hours=1)})
    with pytest.raises(MissingDay, match="portfolio_snapshot 2022-04-03"):
        daily.run_ledger(warehouse, DAY)
    daily.run_ledger(warehouse, DAY, first_day=DAY)
    assert [r.Txn_Type for r in warehouse.read("ledger", DAY).collect()] == ["BUY"]
    people = rows("Employee_Id bigint, First_Name string, Last_Name string, Email string", (1, "Ann", "Lee", "a@b"))
    daily.run_portfolio(warehouse, DAY, people, intent=True, first_day=DAY)
    (held,) = warehouse.spark.read.parquet(warehouse.path("mart_portfolio")).collect()
    assert (held.First_Name, held.Amount, held.Unrealised_Gain) == ("Ann", 10.0, 10.0)


def test_posts_to_sentiment(warehouse, rows):
    at = dt.datetime(2022, 4, 4, 9)
    posts = rows(
        "keyword string, content string, created timestamp_ntz, seq bigint",
        ("DBS", "good, good!", at, 1),
        ("DBS", "good good", at, 2),
        *[("DBS", f"so so {i} bad", at + dt.timedelta(minutes=i), 10 + i) for i in range(1, 7)],
        ("DBS", "good", at - dt.timedelta(days=1), 3),
    )
    daily.ingest_social(warehouse, posts, DAY)
    kept = warehouse.read("social_posts", DAY).collect()
    assert len(kept) == 7 and {r.ticker for r in kept} == {"D05"}  # all of the day, equal ones once
    daily.ingest_social(warehouse, posts, DAY, newest=6)
    assert warehouse.read("social_posts", DAY).count() == 6

    put(warehouse, "news_items", dict(ticker="D05", title="t", source="s", description="good", url="u"))
    put(warehouse, "forum_posts", {"source": "Reddit: SGX", "title": "good bad"}, {"source": "Reddit: SGX", "title": "x"})
    put(warehouse, "stock_list", {"stock_code": "D05", "company_name": "DBS"})
    daily.run_sentiment(warehouse, DAY, {"good": 2.0, "bad": -1.0})
    (row,) = warehouse.read("sentiment_daily", DAY).collect()
    bad, good = -0.25, 0.4588
    assert (row.avg_twitter_score_ticker, row.avg_news_score_ticker) == (bad, good)
    assert row.combined_sentiment_score_ticker == round((bad + good) / 2, 5)
    assert (row.company_name, row.overall_sentiment_for_ticker) == ("DBS", "NEUTRAL")
    assert warehouse.spark.read.parquet(warehouse.path("mart_sentiment")).count() == 1


def test_a_row_of_another_day_fails(warehouse, rows):
    frame = rows("Currency string, Rate double, p_date date", ("USD", 1.0, DAY), ("USD", 1.0, DAY - dt.timedelta(days=1)))
    with pytest.raises(Exception, match="exchange_rates 2022-04-04: row of 2022-04-03"):
        warehouse.write("exchange_rates", frame, DAY)


def test_empty_day_and_absent_table(warehouse, rows):
    for absent in (None, DAY):
        with pytest.raises(MissingDay):
            warehouse.read("stock_prices", absent)
        assert warehouse.read("stock_prices", absent, allow_absent=True).count() == 0
    put(warehouse, "primary_prices", priced("D05", 2.0))
    with pytest.raises(MissingDay, match="backup_prices 2022-04-04, exchange_rates 2022-04-04"):
        daily.run_prices(warehouse, DAY)
    for name in ("primary_prices", "backup_prices", "exchange_rates"):  # written without rows: a day without trading
        put(warehouse, name)
    daily.run_prices(warehouse, DAY)
    assert warehouse.read("stock_prices", DAY).count() == 0
    assert warehouse.read("stock_prices", DAY).where(F.col("p_date").isNotNull()).count() == 0


def test_a_failing_load_leaves_the_day_as_it_was(warehouse, rows):
    ddl = "Currency string, Rate double, p_date date"
    warehouse.write("exchange_rates", rows(ddl, ("USD", 1.0, DAY), ("EUR", 2.0, DAY)), DAY)
    for bad in (rows(ddl, ("USD", 3.0, DAY), ("EUR", None, DAY)), rows(ddl, ("USD", 3.0, DAY - dt.timedelta(days=1)))):
        with pytest.raises(Exception):  # noqa: B017
            warehouse.write("exchange_rates", bad, DAY)
        assert sorted(r.Rate for r in warehouse.read("exchange_rates", DAY).collect()) == [1.0, 2.0]
    warehouse.write("exchange_rates", warehouse.read("exchange_rates", DAY).where("Rate > 1"), DAY)
    assert [r.Currency for r in warehouse.read("exchange_rates", DAY).collect()] == ["EUR"]


def test_one_day_from_landed_files_to_the_marts(warehouse, rows, tmp_path, spark):
    holidays = rows("holiday date")
    line = "2022-04-04;DBS Ltd;;USD;2.1;1.9;2.0;0;10;1.9;2.1;M;2.0;1;D05;2.0"
    (tmp_path / "prices.txt").write_text(line + "\n")
    daily.ingest_prices(warehouse, str(tmp_path / "prices.txt"), holidays, DAY)
    fields = ("Open", "High", "Low", "Close", "Adj Close", "Volume")
    wide = rows(", ".join(f"`X.SI|{f}` double" for f in fields), (1.0, 2.0, 0.5, 1.5, 1.5, 7.0))
    daily.ingest_backup_prices(warehouse, wide, ["X.SI"], holidays, DAY)
    rates = rows("c string, body string", ("USD", '{"rates": {"2022-04-04": {"SGD": 1.5}}}'), ("EUR", "gone"))
    daily.ingest_rates(warehouse, rates, "c", "body", DAY)
    rejects = lambda name: warehouse.spark.read.parquet(warehouse.path(name)).collect()
    assert [r.Currency for r in rejects("exchange_rates_rejects")] == ["EUR"]
    daily.run_prices(warehouse, DAY)

    page = "<table><tr><td>Market cap (intra-day)</td><td>1.5B</td></tr><tr><td>Mood</td><td>good</td></tr></table>"
    pages = rows("t string, h string", ("D05.SI", page), ("Q.SI", "<p>none</p>"))
    daily.ingest_financials(warehouse, pages, "t", "h", DAY)
    assert sorted((r["Ticker"], r["name"]) for r in rejects("financials_rejects")) == [("D05.SI", "Mood"), ("Q.SI", None)]
    daily.run_financials(warehouse, DAY)
    assert "D05" in {r.Stock_Code for r in rejects("mart_prices_financials")}

    at = dt.datetime(2022, 4, 4, 9)
    posts = rows("keyword string, content string, created timestamp_ntz, seq bigint", ("DBS", "good!", at, 1), ("Nobody", "x", at, 2))
    daily.ingest_social(warehouse, posts, DAY)
    assert [r.keyword for r in rejects("social_rejects")] == ["Nobody"]
    article = '<article class="stocknewsitem"><img alt="S"><div class="publisheddate">{}</div><div class="title">T</div><div class="description">bad news</div></article>'
    news = rows("page string, ticker string, url string", (article.format("2022-04-04 10:00:00") + article.format("?"), "D05", "u"))
    daily.ingest_news(warehouse, news, "page", "ticker", "url", DAY)
    assert warehouse.read("news_items", DAY).count() == 1 and [r.item_no for r in rejects("news_rejects")] == [1]
    seconds = int(dt.datetime(2022, 4, 4, 8, tzinfo=dt.timezone.utc).timestamp())
    forum = rows("forum string, title string, seconds bigint", ("SGX", "good", seconds), ("SGX", None, seconds))
    tagged = rows("content string, created timestamp_ntz", ("good!", at), ("fine", at))
    daily.ingest_forum(warehouse, forum, tagged, DAY)
    assert {(r.source, r.title) for r in warehouse.read("forum_posts", DAY).collect()} == {("Reddit: SGX", "good"), ("Twitter: #SGX", "fine")}
    assert len(rejects("forum_rejects")) == 1
    put(warehouse, "stock_list", {"stock_code": "D05", "company_name": "DBS"})
    daily.run_sentiment(warehouse, DAY, rows("token string, valence double", ("good", 2.0), ("bad", -1.0)))
    assert len(rejects("mart_sentiment")) == 1
