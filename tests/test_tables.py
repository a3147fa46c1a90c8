import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.views import Tables
from daymart.operators import calendar, checks, lookback, pick
from daymart.plans import financials, marts, prices, sentiment
from daymart.schemas import FINANCIAL_MEASURES, FINANCIALS, TABLE_NAMES, table_schema
from daymart.sinks import day_partitions, load
from daymart.sources import day_tables, html, landed_files, payloads

DAY = dt.date(2022, 4, 4)


def test_schemas_parse():
    sizes = {name: len(table_schema(name)) for name in TABLE_NAMES}
    assert sizes["primary_prices"] == 17 and sizes["intraday_chart"] == 26
    assert sizes["financials_raw"] == 62 and sizes["financials"] == 57
    assert len(FINANCIALS) == 60 and len(FINANCIAL_MEASURES) == 55


# ---- calendar -------------------------------------------------------------------------


def test_day_counts_match_numpy(spark, rows):
    days = [calendar.BASELINE_DAY + dt.timedelta(days=n) for n in range(-40, 60)]
    off = [dt.date(2022, 4, 15), dt.date(2022, 3, 10), dt.date(2022, 5, 1)]
    table = calendar.trading_calendar(rows("d date", *[(d,) for d in days]), "d", rows("holiday date", *[(h,) for h in off]))
    got = {r.day: (r.is_trading_day, r.day_count, r.file_number) for r in table.collect()}
    for day in days:
        assert got[day][0] == np.is_busday(day, holidays=off)
        if day >= calendar.BASELINE_DAY:
            count = int(np.busday_count(calendar.BASELINE_DAY, day + dt.timedelta(days=1), holidays=off))
            assert got[day][1:] == (count, 6188 + count - 1)
        else:
            assert got[day][1] == -sum(
                np.is_busday(d, holidays=off) for d in days if day < d < calendar.BASELINE_DAY
            )
    assert got[dt.date(2022, 4, 1)][2] == 6188 and got[dt.date(2022, 4, 4)][2] == 6189


def test_no_rows_on_days_without_trading(rows):
    frame = rows("p_date date, v int", (dt.date(2022, 4, 2), 1), (DAY, 2), (dt.date(2022, 4, 15), 3))
    kept = calendar.trading_days_only(frame, "p_date", rows("holiday date", (dt.date(2022, 4, 15),)))
    assert [r.v for r in kept.collect()] == [2]
    assert {f.name for f in kept.schema} == {"p_date", "v"}


# ---- prices ---------------------------------------------------------------------------

PRIMARY = "p_date date, Stock_Code string, Stock_Name string, Currency string, Last double, Open double, High double, Low double, Volume bigint"
BACKUP = "p_date date, Ticker string, Open double, High double, Low double, Close double, Adj_Close double, Volume bigint"
RATES = "Currency string, Rate double, p_date date"


def _daily(rows, primary, backup, rates, ds=DAY):
    frames = rows(PRIMARY, *primary), rows(BACKUP, *backup), rows(RATES, *rates)
    return {r.Stock_Code: r for r in prices.daily_prices(*frames, ds).collect()}


def test_untraded_and_missing_rates(rows):
    got = _daily(
        rows,
        [
            (DAY, "A", "Aco", "USD", 2.0, 0.0, 0.0, 0.0, 0),
            (DAY, "B", "Bco", "XXX", 2.0, 1.0, 3.0, 1.0, 7),
            (DAY, "C", "Cco", "XXX", 2.0, 1.0, 3.0, 1.0, 8),
            (dt.date(2022, 4, 1), "A", "old", "USD", 9.0, 9.0, 9.0, 9.0, 9),
        ],
        [(DAY, "C", 1.0, 1.0, 1.0, 1.0, 1.0, 5), (DAY, "D", 1.0, 1.0, 1.0, 1.0, 1.0, 6)],
        [("USD", 1.5, DAY), ("USD", 9.0, dt.date(2022, 4, 1))],
    )
    assert [got["A"][c] for c in ("Open", "High", "Low", "Close", "Volume")] == [3.0, 3.0, 3.0, 3.0, 0]
    for code, volume in (("B", 7), ("C", 8), ("D", 6)):
        assert got[code].Close is None and got[code].Volume == volume
    assert got["D"].Stock_Name == "D" and got["C"].Stock_Name == "Cco" and len(got) == 4


def test_backup_fills_what_the_primary_lacks(rows):
    got = _daily(
        rows,
        [(DAY, "A", "Aco", "USD", None, 1.0, 1.0, 1.0, 5)],
        [(DAY, "A", 2.0, 2.0, 2.0, 2.0, 2.0, 6)],
        [("USD", 2.0, DAY)],
    )
    assert (got["A"].Close, got["A"].Open, got["A"].Volume) == (4.0, 2.0, 5)


def test_wide_frame_without_a_ticker_has_no_row(rows):
    wide = rows("`D05|Open` double, `D05|Adj Close` double, `U11|Open` double, `U11|Adj Close` double", (1.0, 2.0, None, None))
    long = prices.wide_prices_to_long(wide, [], ["D05", "U11"], ["Open", "Adj Close"])
    assert [tuple(r) for r in long.collect()] == [("D05", 1.0, 2.0)] and long.columns == ["Ticker", "Open", "Adj_Close"]


def test_lookback_window(rows):
    closes = rows("Stock_Code string, p_date date, Close double", *[("A", DAY - dt.timedelta(days=n), float(n)) for n in (8, 7, 1, 0)])
    for ds in (DAY, None):
        literal = [r.Actual_Price for r in lookback.recent_prices(closes, ds).collect() if r.run_date == DAY]
        assert sorted(literal) == [0.0, 1.0, 7.0]
        latest = [r.Actual_Price for r in lookback.latest_price(closes, ds).collect() if r.run_date == DAY]
        assert latest == [0.0]


# ---- posts ----------------------------------------------------------------------------


def test_first_copy_stays(rows):
    frame = rows("k string, n int, v string", ("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"))
    assert sorted(r.v for r in pick.keep_first(frame, ["k"], ["n"]).collect()) == ["early", "only"]


@pytest.mark.parametrize("n", [1, 3, 5, 7, 100])
def test_newest_rows_across_time_slots(rows, n):
    stamps = [dt.datetime(2022, 4, 4, h, m) for h, m in ((9, 0), (9, 5), (9, 5), (10, 0), (10, 1), (10, 2), (12, 0))]
    frame = rows("k string, t timestamp_ntz, i int", *[(k, t, i) for k in "ab" for i, t in enumerate(stamps)])
    got = pick.newest_n(frame, ["k"], "t", "i", n).collect()
    order = sorted(range(len(stamps)), key=lambda i: (-stamps[i].timestamp(), i))[:n]
    assert sorted((r.k, r.i) for r in got) == sorted((k, i) for k in "ab" for i in order)


def test_group_limits_run_before_the_shuffle(rows, capsys):
    pick.keep_first(rows("k string, n int", ("a", 1)), ["k"], ["n"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2


def test_both_ways_to_score_agree(rows):
    words = {"good": 1.9, "bad": -2.5, "fine": 0.0005, "low": -0.0015, "unknown": None}
    lexicon = rows("token string, valence double", *words.items())
    posts = rows("id int, t string", (1, "good good bad"), (2, "none"), (3, "none"), (4, "fine GOOD"), (5, ""), (6, None))
    posts = posts.union(rows("id int, t string", (7, "fine fine fine low"), (8, "unknown good")))
    inline = sentiment.score_posts(posts, "t", words)
    joined = sentiment.score_posts(posts, "t", lexicon)
    assert sorted(inline.collect(), key=repr) == sorted(joined.select(inline.columns).collect(), key=repr)
    first = [sentiment.scored_posts(posts, "t", ["t"], "id", w, texts=("t",)) for w in (words, lexicon)]
    assert sorted(first[0].collect(), key=repr) == sorted(first[1].select(first[0].columns).collect(), key=repr)
    with pytest.raises(Exception, match="listed twice: good"):
        sentiment.score_posts(posts, "t", lexicon.union(rows("token string, valence double", ("good", 2.0)))).collect()


def test_no_text_is_hashed_or_sorted_in_a_shuffle(rows, capsys):
    posts = rows("seq bigint, content string, ticker string, p_date date", (1, "x", "A", DAY))
    words = rows("token string, valence double", ("good", 1.9))
    for frame in (
        sentiment.social_table(posts.withColumn("source", F.lit("s")), "seq"),
        sentiment.scored_posts(posts, "content", sentiment.SAME_SOCIAL, "seq", words),
        pick.keep_first(posts, ["content"], ["seq"]).select("seq"),
    ):
        frame.explain()
        plan = capsys.readouterr().out
        for line in plan.splitlines():
            if "Exchange hashpartitioning" in line or "Sort [" in line:
                assert "content#" not in line.split("),")[0], line


def test_no_token_is_shuffled_to_meet_a_small_lexicon(rows, capsys):
    posts = rows("seq bigint, content string, ticker string, p_date date", (1, "x", "A", DAY))
    words = rows("token string, valence double", ("good", 1.9))
    for frame in (
        sentiment.score_posts(posts, "content", words),
        sentiment.scored_posts(posts, "content", sentiment.SAME_SOCIAL, "seq", words),
    ):
        frame.explain()
        keys = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line]
        assert not [line for line in keys if "token#" in line and "_key#" in line], keys


def test_missing_values_are_no_texts(rows):
    words = rows("token string, valence double", ("a", 1.0), ("-", 2.0))
    posts = rows(
        "id int, t string, k string, n int",
        (1, None, "a", 1), (2, None, "a", 1), (3, "-", "a", 1), (4, "a", None, 1), (5, "a", "-", 1), (6, "a", "-", None),
        (7, "a,a", "", 1), (8, "a", "a,", 1), (9, "", "", 1), (10, "", "", 1), (11, "a a", "", 1),
    )
    for lexicon in (words, {"a": 1.0, "-": 2.0}):
        got = sentiment.scored_posts(posts, "t", ["t", "k", "n"], "id", lexicon, texts=("t",))
        scores = {r.id: r.NLTK_score for r in got.collect()}
        assert set(scores) == {1, 3, 4, 5, 6, 7, 8, 9, 11}
        assert (scores[1], scores[3], scores[4], scores[9], scores[11]) == (None, 0.4588, 0.25, 0.0, 0.4588)


def test_union_tolerates_missing_columns_and_empty_sources(spark, rows):
    empty = spark.createDataFrame([], "source string, title string")
    whole = sentiment.union_sources(empty, rows("title string, ticker string", ("x", "A")))
    assert [tuple(r) for r in whole.collect()] == [(None, "x", "A")]


def test_news_only_ticker(rows):
    scored = "p_date date, ticker string, NLTK_score double"
    social = rows(scored, (DAY, "A", 0.5), (DAY, "A", 0.1))
    news = rows(scored, (DAY, "A", 0.9), (DAY, "B", -0.9))
    forum = rows("p_date date, NLTK_SIA_compound_score double", (DAY, 0.2), (DAY, 0.4))
    master = rows("stock_code string, company_name string, p_date date", ("A", "Aco", DAY), ("B", "Bco", DAY))
    (literal,) = sentiment.sentiment_rollup(social, news, forum, master, DAY).collect()
    assert (literal.ticker, literal.avg_twitter_score_ticker, literal.combined_sentiment_score_ticker) == ("A", 0.3, 0.6)
    assert (literal.benchmark_score_for_today_market, literal.overall_sentiment_for_ticker) == (0.3, "POSITIVE")
    intent = {r.ticker: r for r in sentiment.sentiment_rollup_intent(social, news, forum, master, DAY).collect()}
    assert intent["B"].combined_sentiment_score_ticker == -0.9 and intent["B"].avg_twitter_score_ticker is None
    no_forum = sentiment.sentiment_rollup(social, news, forum.where("false"), master, DAY)
    assert no_forum.count() == 0


def test_keyword_tags(rows):
    tagged = sentiment.tag_by_keyword(rows("keyword string", ("OCBC",), ("unknown",)), "keyword").collect()
    assert [r.ticker for r in tagged] == ["O39", None] and tagged[0].source == "Twitter seachword: OCBC"


# ---- pages and payloads ---------------------------------------------------------------


def test_first_values_of_a_page(rows):
    page = (
        "<tr><td>a</td><td>1 &amp; <b>2</b> </td></tr><tr x='<'><th>a</th><td>late</td></tr><tr><td>b</td></tr>"
        "<tr><td>52 &lt;w&gt;</td><td></td></tr><tr><td>c</td><td>1</td><td>2</td></tr><tr><td>d</td><td>open"
    )
    pages = rows("html string", (page,), ("",), (None,))
    names = ["_52_<w>", "a", "b", "c", "d"]
    found = pages.select(html.first_values(html.key_values(F.col("html")), names).alias("values"))
    got = [tuple(r) for r in found.select(*html.wide(F.col("values"), names)).collect()]
    assert got == [("", "1 & 2", None, None, None), (None,) * 5, (None,) * 5]


def test_names_are_looked_up_in_one_expression(rows, capsys):
    found = rows("pairs array<struct<name: string, value: string>>", ([("n1", "x")],)).select(
        html.first_values(F.col("pairs"), [f"n{i}" for i in range(60)]).alias("values")
    )
    found.select(*html.wide(F.col("values"), [f"n{i}" for i in range(60)])).explain()
    assert capsys.readouterr().out.count("array_position") == 1


def test_pages_of_one_small_file_are_many_tasks(spark):
    pages = Tables(spark, "/root/testdata/sf0.001")["statistics_pages"]
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_news_page(rows):
    page = """<html><article class="stocknewsitem"><img src="a.png" alt="The Paper"/>
      <div class="publisheddate">2022-04-04 09:30:00</div><div class="title">Up &amp; <b>away</b></div>
      <div class="description">More to come</div></article>
      <article class="other">no</article>
      <article class="stocknewsitem"><img alt="Wire"><div class="publisheddate">2022-04-03 23:59:59</div>
      <div class="title">Old</div><div class="description">Gone</div></article></html>"""
    pages = rows("ticker string, url string, html string", ("D05", "u", page))
    news = html.news_items(pages, "html", "ticker", "url")
    today = day_tables.on_day(news, DAY).collect()
    assert [tuple(r) for r in today] == [(0, DAY, "D05", "Up & away", "The Paper", "More to come", "u")]
    assert news.count() == 2


def test_statistics_page(rows):
    page = "<table><tr><td>Market cap (intra-day)</td><td>1.5B</td></tr><tr><th>Trailing P/E</th><td> 7.5 </td></tr></table>" \
        "<p>x</p><table><tr><td>Short ratio 4</td><td>1.25</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"
    other = "<table><tr><td>Beta (5Y monthly)</td><td>0.9</td></tr></table>"
    pages = rows("t string, h string", ("D05.SI", page), ("X", other), ("Y", "<p>none</p>"), ("Z", None))
    raw = financials.financials_raw(pages, "t", "h", DAY)
    assert sorted(r.Ticker for r in financials.unreadable_pages(pages, "t", "h").collect()) == ["Y", "Z"]
    assert raw.count() == 2
    assert raw.schema.names == table_schema("financials_raw").names
    got = {r.Ticker: r for r in raw.collect()}
    assert got["D05.SI"].Market_cap__intra_day_ == "1.5B" and got["D05.SI"].Trailing_PE == 7.5
    assert got["D05.SI"].Short_ratio_4 == 1.25 and got["X"].EBITDA is None
    clean = {r.Ticker: r for r in financials.financials_clean(raw, DAY).collect()}
    assert clean["D05.SI"].Market_cap__intra_day_ == 1.5e9 and clean["D05.SI"].Short_ratio_4 is None
    assert clean["X"].EBITDA == 0.0 and clean["X"].Profit_margin is None


def test_payloads(spark, rows, tmp_path):
    for n, page in enumerate(([{"stock_code": "A", "year": 1}], [{"stock_code": "B", "year": 2}, {"stock_code": "C"}])):
        (tmp_path / f"page{n}.json").write_text(json.dumps({"meta": {"totalPages": 2}, "data": page}))
    pages = landed_files.read_pages(spark, str(tmp_path))
    record = T.StructType.fromDDL("stock_code string, year bigint")
    got = payloads.page_records(pages.withColumn("p_date", F.lit(DAY)), "payload", record, "p_date").collect()
    assert sorted((r.stock_code, r.year, r.p_date) for r in got if r.year) == [("A", 1, DAY), ("B", 2, DAY)] and len(got) == 3
    chart = rows("c string, body string", ("A", '{"data": {"intraday": [{"lt": 1.5}, {"lt": 2.5}]}}'))
    points = payloads.intraday_points(chart, "body", T.StructType.fromDDL("lt double"), "c").collect()
    assert [r.lt for r in points] == [1.5, 2.5]
    rate = rows("body string, d date", ('{"rates": {"2022-04-04": {"SGD": 1.36}}}', DAY), ('{"rates": {}}', DAY))
    assert [r[0] for r in rate.select(payloads.dated_rate(F.col("body"), F.col("d"))).collect()] == [1.36, None]


def test_price_file(spark, tmp_path):
    line = "2022-04-04;DBS GROUP   ; ;SGD ; 36.1;35.5;36;0.2; 1200;35.9;36;MAINBOARD ;35.6;43200;D05 ;35.8"
    (tmp_path / "prices.dat").write_text(line + "\n" + line.replace("D05", "U11") + ";\n")
    table = table_schema("primary_prices")
    frame = landed_files.read_price_file(spark, str(tmp_path / "prices.dat"), DAY, table)
    got, trailing = sorted(load.enforce(frame, table).collect(), key=lambda r: r.Stock_Code)
    assert (trailing.Stock_Code, trailing.DClose, trailing.Remarks) == ("U11", 35.8, "")
    assert (got.Stock_Name, got.Stock_Code, got.Currency, got.Volume) == ("DBS GROUP", "D05", "SGD", 1200)
    assert (got.p_date, got.Trade_Date, got.Last, got.High) == (DAY, DAY, 36.0, 36.1)


def test_a_bad_number_fails_the_load(spark, tmp_path):
    (tmp_path / "bad.dat").write_text("1;x\n2;1.5\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landed_files.read_delimited(spark, str(tmp_path / "bad.dat"), schema).collect()


# ---- loads ----------------------------------------------------------------------------


def test_required_fields(rows):
    schema = T.StructType.fromDDL("a BIGINT NOT NULL, b STRING")
    frame = rows("b string, a string", (None, "1"), ("x", None))
    assert load.required_violations(frame, schema).collect()[0].a == 1
    with pytest.raises(Exception, match="required field a is missing"):
        load.enforce(frame, schema).collect()
    complete, rejected = checks.split_rejects(frame, ["a"])
    assert [tuple(r) for r in load.enforce(complete, schema).collect()] == [(1, None)]
    assert [r.b for r in rejected.collect()] == ["x"]


def test_partitions_are_replaced(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    days = [DAY + dt.timedelta(days=n) for n in range(3)]
    frame = rows("v int, p_date date", *[(n, d) for n, d in enumerate(days)], (9, DAY - dt.timedelta(days=9)))
    day_partitions.overwrite_days(frame, table, days)
    read = lambda: sorted((r.p_date, r.v) for r in spark.read.parquet(table).collect())
    assert read() == [(d, n) for n, d in enumerate(days)]
    day_partitions.overwrite_day(frame.where("false"), table, days[1])
    assert read() == [(days[0], 0), (days[2], 2)]
    day_partitions.overwrite_days(rows("v int, p_date date", (7, days[0])), table, [days[0], days[2]])
    assert read() == [(days[0], 7)]


def test_missing_parts(rows):
    assert [r.k for r in checks.missing_keys(rows("k int", (1,), (2,)), rows("k int", (2,)), "k").collect()] == [1]
    days = [DAY + dt.timedelta(days=n) for n in range(3)]
    required = checks.required_days(rows("x int", (1,)).sparkSession, days[0], days[2])
    got = checks.missing_partitions(required, rows("p_date date", (days[1],)))
    assert sorted(r.p_date for r in got.collect()) == [days[0], days[2]]
    assert checks.off_partition_rows(rows("p_date date", (days[0],), (days[1],), (None,)), days[0]).count() == 2


def test_day_filter_prunes_partitions(spark, rows, tmp_path, capsys):
    day_partitions.overwrite_days(rows("v int, p_date date", (1, DAY)), str(tmp_path / "t"), [DAY])
    day_tables.on_day(spark.read.parquet(str(tmp_path / "t")), DAY).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(p_date" in plan


def test_stamp_filter_reaches_the_scan(spark, capsys):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    day_tables.on_stamp_day(events, "2024-01-15", "ts").select("value").explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_duplicate_prices_repeat_the_statistics(rows):
    stats = rows("p_date date, Ticker string, " + ", ".join(f"{n} double" for n in FINANCIAL_MEASURES),
                 (DAY, "A.SI", *[float(i) for i in range(55)]), (DAY, "B.SI", *[None] * 55))
    quotes = rows("p_date date, Stock_Code string, Stock_Name string, Open double, Close double, High double, Low double, Volume bigint",
                  (DAY, "A", "Aco", 1.0, 1.0, 1.0, 1.0, 1), (DAY, "A", "Aco", 2.0, 2.0, 2.0, 2.0, 2))
    mart = marts.mart_prices_financials(quotes, stats, DAY)
    assert mart.columns.count("Enterprise_valuerevenue") == 1 and "Pricebook__mrq_" not in mart.columns
    got = mart.collect()
    assert sorted(r.Stock_Code for r in got) == ["A", "A", "A", "A", "B.SI"]
    position = FINANCIAL_MEASURES.index("Pricebook__mrq_")
    assert {r.Enterprise_valuerevenue for r in got if r.Stock_Code == "A"} == {float(position)}
