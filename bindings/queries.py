"""Every operator as a query over the test tables: ``name -> f(spark, folder)``.

Numbers that depend on summation order are rounded to four decimals here, through DECIMAL;
the library itself returns them unrounded.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.views import LEXICON, PAGE_LABELS, Tables
from daymart import warehouse
from daymart.functions import dates, numbers, text
from daymart.operators import asof, calendar, checks, lookback, pick
from daymart.plans import feeds, financials, ledger, marts, portfolio, prices, sentiment
from daymart.schemas import schema_of, table_schema
from daymart.session import shared_dir
from daymart.sinks import commits, day_partitions, load
from daymart.sources import day_tables, html, landed_files, payloads

DS = dt.date(2024, 1, 15)
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
CALENDAR_START = dt.date(1998, 1, 1)

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _r4(name: str) -> Column:
    return F.round(F.col(name).cast("decimal(28,6)"), 4).cast("double").alias(name)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- prices ---------------------------------------------------------------------------


@query
def daily_prices(t: Tables) -> DataFrame:
    return prices.daily_prices(t["primary_prices"], t["backup_prices"], t["exchange_rates"])


@query
def fx_convert(t: Tables) -> DataFrame:
    rated = prices.with_rate(t["primary_prices"], t["exchange_rates"])
    return rated.select("p_date", "Stock_Code", "Currency", "Rate", (F.col("Last") * F.col("Rate")).alias("Close"))


@query
def priority_merge(t: Tables) -> DataFrame:
    first = t["primary_prices"].withColumnRenamed("Last", "Close")
    second = t["backup_prices"].withColumnRenamed("Ticker", "Stock_Code")
    return prices.priority_merge(
        first, second, ["p_date", "Stock_Code"], ["Open", "Close", "High", "Low", "Volume"]
    )


@query
def distinct_values(t: Tables) -> DataFrame:
    return prices.currencies_in_use(t["primary_prices"])


@query
def wide_to_long(t: Tables) -> DataFrame:
    wide = t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("A|Open"),
        F.col("l_extendedprice").alias("A|Adj Close"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("B|Open"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("B|Adj Close"),
    )
    return prices.wide_prices_to_long(wide, ["l_orderkey", "l_linenumber"], ["A", "B"], ["Open", "Adj Close"])


@query
def lookback_price_join(t: Tables) -> DataFrame:
    held = t["holdings"].select("Analyst", "Ticker", F.col("p_date").alias("run_date"))
    quotes = lookback.recent_prices(t["stock_prices"]).withColumnRenamed("Stock_Code", "Ticker")
    return held.join(quotes, ["run_date", "Ticker"], "left").select(
        "run_date", "Analyst", "Ticker", F.col("p_date").alias("price_date"), "Actual_Price"
    )


@query
def latest_price_asof(t: Tables) -> DataFrame:
    held = t["holdings"].select("Analyst", "Ticker", F.col("p_date").alias("run_date"))
    return lookback.with_latest_price(held, t["stock_prices"])


@query
def price_asof_hot(t: Tables) -> DataFrame:
    """The close that each entry's day knows, at most one day old; every second entry is one of a single code."""
    code = F.when(F.col("Txn_Id") % 2 == 0, "T1").otherwise(F.col("Ticker")).alias("Stock_Code")
    asked = t["ledger_raw"].select("Txn_Id", code, F.col("p_date").alias("run_date"))
    return asof.asof_merge(asked, t["stock_prices"], ["Stock_Code"], "run_date", "p_date", ["Close"], tolerance_days=1, block_days=7)


# ---- ledger and portfolio -------------------------------------------------------------


@query
def carry_forward_union(t: Tables) -> DataFrame:
    rows = ledger.carry_forward(t["ledger_raw"], t["holdings"])
    opening = F.col("Txn_Time") == dates.start_of_time()
    return rows.select(
        "run_date", "Analyst", "Ticker", "Price", "Txn_Type", "Amount", "p_date", opening.alias("is_opening"),
        F.when(~opening, F.col("Txn_Time")).alias("Txn_Time"),
    )


@query
def ledger_validate(t: Tables) -> DataFrame:
    return ledger.validated_ledger(t["ledger_raw"], t["holdings"])


@query
def running_position(t: Tables) -> DataFrame:
    events = t["ledger_raw"]
    running = portfolio.running_position(events, ["Analyst", "Ticker"], portfolio.buys_positive(), None)
    return running.select("Txn_Id", "Analyst", "Ticker", _r4("Running_Amount"), _r4("Running_Value"))


@query
def running_position_split(t: Tables) -> DataFrame:
    running = portfolio.running_position(t["ledger_raw"], ["Analyst", "Ticker"], portfolio.buys_positive(), "hour")
    return running.select("Txn_Id", "Analyst", "Ticker", _r4("Running_Amount"), _r4("Running_Value"))


@query
def ledger_validate_split(t: Tables) -> DataFrame:
    return ledger.validated_ledger(t["ledger_raw"], t["holdings"], chunk_rows=20)


@query
def ledger_validate_hovering(t: Tables) -> DataFrame:
    """One holding has a third of all entries and hovers around zero."""
    return ledger.validated_ledger(t["hovering_ledger"], t["holdings"], chunk_rows=100)


@query
def signed_balance(t: Tables) -> DataFrame:
    events = portfolio.holdings_events(t["ledger_raw"], t["holdings"])
    before = F.col("p_date") < F.col("run_date")
    return portfolio.signed_balance(events, portfolio.buys_positive(), before)


@query
def last_state(t: Tables) -> DataFrame:
    return pick.last_values(t["ledger_raw"], ["Analyst", "Ticker"], "Txn_Time", ["Txn_Type", "Amount", "Price"], ["Txn_Id"])


def _snapshot(rows: DataFrame) -> DataFrame:
    money = {"Amount", "Daily_Amount_Change", "Realised_Gain", "Unrealised_Gain", "Avg_Price"}
    return rows.select(*[_r4(c) if c in money else F.col(c) for c in rows.columns])


def _validated(t: Tables) -> DataFrame:
    return ledger.validated_ledger(t["ledger_raw"], t["holdings"])


def _literal_snapshot(t: Tables) -> DataFrame:
    return portfolio.portfolio_snapshot(_validated(t), t["holdings"], t["stock_prices"])


@query
def portfolio_snapshot(t: Tables) -> DataFrame:
    return _snapshot(_literal_snapshot(t))


@query
def portfolio_snapshot_intent(t: Tables) -> DataFrame:
    return _snapshot(portfolio.portfolio_snapshot_intent(_validated(t), t["holdings"], t["stock_prices"]))


@query
def portfolio_backfill(t: Tables) -> DataFrame:
    return _snapshot(portfolio.portfolio_history(t["ledger_raw"], t["stock_prices"], LAST_DAY))


@query
def mart_portfolio(t: Tables) -> DataFrame:
    return _snapshot(marts.mart_portfolio(_literal_snapshot(t), t["employees"]))


# ---- text and sentiment ---------------------------------------------------------------


@query
def clean_text(t: Tables) -> DataFrame:
    cleaned = text.clean_text(F.col("text"))
    return t["documents"].select("doc_id", cleaned.alias("cleaned"), text.one_line(cleaned).alias("line"))


@query
def dedup_keep_first(t: Tables) -> DataFrame:
    return pick.keep_first(t["documents"], ["text", "source"], ["doc_id"]).select("doc_id", "source", "lang")


@query
def clean_dedup_posts(t: Tables) -> DataFrame:
    whole = sentiment.union_sources(
        sentiment.social_table(t["social"], "seq").withColumn("kind", F.lit("social")),
        sentiment.news_table(t["news"], "seq").withColumn("kind", F.lit("news")),
        sentiment.forum_table(t["forum"], "seq").withColumn("kind", F.lit("forum")),
    )
    return whole.select("kind", "seq", "p_date", "ticker", "source", "title", "description", "content")


@query
def union_sources(t: Tables) -> DataFrame:
    forum = t["forum"].withColumn("source", F.concat(F.lit(sentiment.FORUM_SOURCE), "source"))
    tagged = t["social"].select(
        "seq", "p_date", F.lit(sentiment.HASHTAG_SOURCE).alias("source"), F.col("content").alias("title"), "ticker"
    )
    return sentiment.union_sources(forum, tagged).select("seq", "source", "title", "p_date", "ticker")


@query
def keyword_tag(t: Tables) -> DataFrame:
    return sentiment.tag_by_keyword(t["searched"], "keyword").select("doc_id", "keyword", "ticker", "source")


@query
def top_n_per_key(t: Tables) -> DataFrame:
    newest = sentiment.newest_per_keyword(t["ledger_raw"], ["Ticker", "p_date"], "Txn_Time", "Txn_Id", 6)
    return newest.select("Ticker", "p_date", "Txn_Id", "Txn_Time")


@query
def newest_per_forum(t: Tables) -> DataFrame:
    newest = sentiment.newest_per_forum(t["events"], "event_type", "ts", "event_id", 1500)
    return newest.select("event_type", "event_id", "ts")


def _lexicon(t: Tables) -> DataFrame:
    return t["lexicon"].select("token", (F.col("weight") / 1000.0).alias("valence"))


def _scored(t: Tables, words: sentiment.Lexicon = LEXICON) -> tuple[DataFrame, DataFrame, DataFrame]:
    scored = sentiment.scored_posts
    social, news, forum = (
        sentiment.clean_social(t["social"]),
        sentiment.clean_news(t["news"]),
        sentiment.clean_forum(t["forum"]),
    )
    return (
        scored(social, "content", sentiment.SAME_SOCIAL, "seq", words),
        scored(news, "description", sentiment.SAME_NEWS, "seq", words),
        scored(forum, "title", sentiment.SAME_FORUM, "seq", words, "NLTK_SIA_compound_score"),
    )


def _all_scores(social: DataFrame, news: DataFrame, forum: DataFrame) -> DataFrame:
    forum = forum.withColumnRenamed("NLTK_SIA_compound_score", "NLTK_score")
    parts = [
        part.select(F.lit(kind).alias("kind"), "seq", "NLTK_score", "NLTK_sentiment")
        for kind, part in (("social", social), ("news", news), ("forum", forum))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def lexicon_sentiment(t: Tables) -> DataFrame:
    return _all_scores(*_scored(t))


@query
def lexicon_sentiment_joined(t: Tables) -> DataFrame:
    return _all_scores(*_scored(t, _lexicon(t)))


@query
def sentiment_label(t: Tables) -> DataFrame:
    score = F.col("score")
    return t["scores"].select(
        "event_id", "score", text.post_label(score).alias("post"), text.ticker_label(score).alias("overall")
    )


@query
def combined_mean(t: Tables) -> DataFrame:
    first = numbers.mean_of_micros(F.col("first_sum") * 1000, F.col("first_n"))
    second = numbers.mean_of_micros(F.col("second_sum") * 1000, F.col("second_n"))
    return t["two_means"].select("user_id", "p_date", numbers.combined_mean(first, second).alias("combined"))


@query
def sentiment_rollup(t: Tables) -> DataFrame:
    return sentiment.sentiment_rollup(*_scored(t), t["master"])


@query
def sentiment_rollup_intent(t: Tables) -> DataFrame:
    return sentiment.sentiment_rollup_intent(*_scored(t), t["master"])


@query
def mart_sentiment(t: Tables) -> DataFrame:
    return marts.mart_sentiment(sentiment.sentiment_rollup(*_scored(t), t["master"]))


# ---- pages, payloads, names, dates ----------------------------------------------------

LINK = r'<a href="[^"]*">[^<]*</a>'
LINK_FIELDS = {"href": r'href="([^"]*)"', "label": r">([^<]*)<"}
PAGE_PARTS = {"article": r"(?s)<article>(.*?)</article>", "paragraph": r"(?s)<p>(.*?)(?:</p>|<br>)"}


@query
def html_extract(t: Tables) -> DataFrame:
    return html.items(t["pages"], "html", LINK, LINK_FIELDS, keep=("page_id",))


@query
def html_kv_pivot(t: Tables) -> DataFrame:
    names = list(PAGE_LABELS.values())
    return (
        t["statistics_pages"]
        .select("Ticker", html.key_values(F.col("html")).alias("pairs"))
        .select("Ticker", html.first_values(F.col("pairs"), names).alias("values"))
        .select("Ticker", *html.wide(F.col("values"), names))
    )


def _news_pages(t: Tables) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 30).cast("int"))
    published = F.when(F.col("p_partkey") % 7 != 0, F.concat(day.cast("string"), F.lit(" 10:00:00"))).otherwise(F.lit("soon"))
    article = F.format_string(
        '<article class="big stocknewsitem"><img src="x" alt="%s"><div class="publisheddate">%s</div>'
        '<div class="title wide">Part %s</div><div class="description">%s &amp; more</div></article>',
        F.col("p_brand"), published, F.col("p_partkey").cast("string"), F.col("p_type"),
    )
    return t["part"].select(
        F.concat(F.lit("T"), F.col("p_size").cast("string")).alias("ticker"), F.concat(F.lit("http://"), "p_brand").alias("url"), article.alias("page")
    )


@query
def news_items(t: Tables) -> DataFrame:
    return html.news_items(_news_pages(t), "page", "ticker", "url").where("p_date is not null")


@query
def news_rejects(t: Tables) -> DataFrame:
    return html.news_items(_news_pages(t), "page", "ticker", "url").where("p_date is null").drop("p_date")


def _landed_statistics(t: Tables) -> DataFrame:
    readable = F.length("Ticker") % 5 != 0
    more = F.replace(F.col("html"), F.lit("</table>"), F.lit("<tr><td>Colour</td><td>blue</td></tr></table>"))
    return t["statistics_pages"].select("Ticker", F.when(readable, more).otherwise(F.lit("<p>try later</p>")).alias("html"))


@query
def financials_raw(t: Tables) -> DataFrame:
    return financials.financials_raw(_landed_statistics(t), "Ticker", "html", DS)


@query
def financials_rejects(t: Tables) -> DataFrame:
    pages, none = _landed_statistics(t), F.lit(None).cast("string")
    unreadable = financials.unreadable_pages(pages, "Ticker", "html").select("Ticker", none.alias("name"), none.alias("value"))
    return unreadable.unionByName(financials.unknown_labels(pages, "Ticker", "html"))


@query
def pivot_kv(t: Tables) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return financials.pivot_key_values(t["events"], "user_id", "event_type", "value", kinds)


@query
def json_extract(t: Tables) -> DataFrame:
    payload = F.format_string('{"rates": {"%s": {"SGD": %s, "USD": 0.5}}}', F.to_date("ts").cast("string"), "value")
    rows = t["events"].withColumn("payload", payload)
    return rows.select(
        "event_id",
        payloads.number_at(F.col("props"), "k").alias("k"),
        payloads.dated_rate(F.col("payload"), F.to_date("ts")).alias("rate"),
    )


@query
def json_records(t: Tables) -> DataFrame:
    point = schema_of("k BIGINT")
    rows = t["events"].select(
        "event_id",
        F.format_string('{"data": [%s, %s]}', "props", "props").alias("page"),
        F.format_string('{"data": {"intraday": [%s]}}', "props").alias("chart"),
    )
    listed = payloads.page_records(rows, "page", point, "event_id").withColumn("kind", F.lit("page"))
    charted = payloads.intraday_points(rows, "chart", point, "event_id").withColumn("kind", F.lit("chart"))
    return listed.unionByName(charted)


@query
def variant_rates(t: Tables) -> DataFrame:
    """A number under a path that depends on the row; every seventh payload is no JSON, every fifth has a text in its place."""
    day, kind = F.to_date("ts").cast("string"), F.col("event_id")
    body = F.format_string('{"rates": {"%s": {"SGD": %s, "USD": 0.5}}}', day, F.when(kind % 5 == 0, '"none"').otherwise(F.col("value").cast("string")))
    rows = t["events"].withColumn("payload", F.when(kind % 7 == 0, "{broken").otherwise(body))
    path = F.concat(F.lit("$.rates['"), day, F.lit("'].SGD"))
    return rows.select("event_id", payloads.value_at(F.col("payload"), path, "double").alias("rate"))


@query
def unknown_fields(t: Tables) -> DataFrame:
    """Fields of landed records that the table does not name; they differ by the event's kind."""
    kind = F.col("event_type")
    record = F.concat(
        F.lit('{"k": 1, "id": '), F.col("event_id").cast("string"), F.lit(', "'), kind, F.lit('": '),
        F.when(kind == "view", F.lit('"seen"')).otherwise(F.lit("true")), F.lit("}"),
    )
    pages = t["events"].select(F.concat(F.lit('{"data": ['), record, F.lit(", 3, "), record, F.lit("]}")).alias("page"))
    return payloads.unknown_fields(pages, "page", schema_of("k BIGINT"))


@query
def page_gaps(t: Tables) -> DataFrame:
    """Pages that are missing among those landed, by list; numbers are those of orders, of which some were left out."""
    listed = t["orders"].select(
        F.col("o_orderstatus").alias("list_name"), F.col("o_orderkey").alias("page_number"), F.col("o_custkey").alias("c")
    )
    return landed_files.missing_pages(listed.where("c % 3 <> 0"), "list_name")


@query
def numbered_pages(t: Tables) -> DataFrame:
    """Page files with their numbers, written and read back; each holds the pages of one remainder."""
    path, name = _scratch(t.spark, "pages"), F.format_string("list-%s", F.col("page_id") % 32)
    t["pages"].select(name.alias("name"), F.regexp_replace("html", r"\n", "").alias("html")).repartition("name").write.partitionBy("name").text(path)
    pattern = r"/name=(list)-([0-9]+)/"
    read = landed_files.read_numbered_pages(t.spark, path, pattern, of_path=True)
    return read.select("list_name", "page_number", F.length(F.regexp_replace("payload", r"\n", "")).alias("n_chars"))


@query
def exchange_rate_table(t: Tables) -> DataFrame:
    used = prices.currencies_in_use(t["primary_prices"]).select("Currency").distinct()
    rate = F.concat(F.lit("1."), F.replace(F.col("Currency"), F.lit("Brand#"), F.lit("")))
    body = F.format_string('{"rates": {"2024-01-15": {"SGD": %s}}}', rate)
    return feeds.exchange_rates(used.withColumn("body", body), "Currency", "body", DS)


@query
def stock_list_table(t: Tables) -> DataFrame:
    fields = ["issuer", "yr", "nm", "rk", "adj", "base", "total", "code", "isin"]
    values = [
        F.col("c_mktsegment"), F.lit(2024), F.col("c_name"), F.col("c_custkey"), F.lit(0), F.col("c_acctbal"),
        F.col("c_acctbal") * 2, F.concat(F.lit("C"), F.col("c_custkey").cast("string")), F.lit(None).cast("string"),
    ]
    entry = F.struct(*[v.alias(n) for n, v in zip(fields, values)])
    pages = t["customer"].select(F.to_json(F.struct(F.array(entry).alias("data"))).alias("body"))
    return feeds.stock_list(pages, "body", fields, DS)


@query
def intraday_chart(t: Tables) -> DataFrame:
    fields = [f for f in table_schema("intraday_chart").fields if f.name != "p_date"]
    point = F.struct(
        *[
            (F.col("event_id") * (i + 1) if f.dataType.simpleString() == "double" else F.concat_ws(" ", F.lit(f.name), "event_type")).alias(f.name)
            for i, f in enumerate(fields)
        ]
    )
    body = F.to_json(F.struct(F.struct(F.array(point).alias("intraday")).alias("data")))
    return feeds.intraday_chart(t["events"].select(body.alias("body")), "body", DS)


@query
def strip_suffix(t: Tables) -> DataFrame:
    code = text.with_suffix(F.concat(F.lit("S"), F.col("p_partkey").cast("string")))
    return t["part"].select("p_partkey", code.alias("ticker"), text.strip_suffix(code).alias("code"))


@query
def normalise_names(t: Tables) -> DataFrame:
    label = F.format_string(
        "%s/%s (52-week) %% of %s & 5 year 200-day", F.col("p_type"), F.col("p_name"), F.col("p_size").cast("string")
    )
    return t["part"].select("p_partkey", text.normalise_name(label).alias("name"))


@query
def epoch_to_date(t: Tables) -> DataFrame:
    seconds = F.lit(1704067200) + F.col("event_id") * 37
    return t["events"].select(
        "event_id",
        dates.epoch_date(seconds).alias("day"),
        dates.epoch_millis_date(seconds * 1000 + F.col("event_id") % 1000).alias("day_from_millis"),
    )


@query
def date_parts(t: Tables) -> DataFrame:
    stamp = dates.parse_stamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    day = F.to_date(stamp)
    return t["orders"].select(
        "o_orderkey",
        day.alias("day"),
        dates.partition_label(day).alias("label"),
        F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 7).alias("week_before"),
    )


# ---- financial statistics -------------------------------------------------------------


@query
def parse_percent(t: Tables) -> DataFrame:
    value = numbers.parse_percent(F.col("percent_text"))
    return t["messy"].select("l_orderkey", "l_linenumber", "percent_text", value.alias("value"))


@query
def parse_magnitude(t: Tables) -> DataFrame:
    value = numbers.parse_magnitude(F.col("magnitude_text"))
    return t["messy"].select("l_orderkey", "l_linenumber", "magnitude_text", value.alias("value"))


@query
def parse_ratio(t: Tables) -> DataFrame:
    value = numbers.parse_ratio(F.col("ratio_text"))
    return t["messy"].select("l_orderkey", "l_linenumber", "ratio_text", value.alias("value"))


@query
def financials_clean(t: Tables) -> DataFrame:
    return financials.financials_clean(t["financials_raw"])


@query
def full_outer_using(t: Tables) -> DataFrame:
    requested = t["primary_prices"].select(text.with_suffix(F.col("Stock_Code")).alias("Ticker"), "Stock_Name")
    return financials.join_requested(requested, t["financials_raw"].select("Ticker", "Trailing_PE"))


@query
def mart_prices_financials(t: Tables) -> DataFrame:
    quotes = prices.daily_prices(t["primary_prices"], t["backup_prices"], t["exchange_rates"])
    return marts.mart_prices_financials(quotes, financials.financials_clean(t["financials_raw"]))


# ---- scans, joins, calendar, loads, checks --------------------------------------------


@query
def partition_scan(t: Tables) -> DataFrame:
    return day_tables.on_stamp_day(t["events"], DS, "ts").select("event_id", "user_id", "event_type", "value")


@query
def param_scan(t: Tables) -> DataFrame:
    return day_tables.query_day(
        t.spark,
        "SELECT event_id, user_id, value FROM {events} WHERE ts >= :ds AND ts < date_add(:ds, 1) AND value > 0",
        DS,
        events=t["events"],
    )


@query
def latest_partition_distinct(t: Tables) -> DataFrame:
    rows = t["ledger_raw"]
    table = _scratch(t.spark, "ledger")
    rows.write.partitionBy("p_date").parquet(table)
    return day_tables.latest_partition(t.spark, table, rows.schema).select("Ticker", "p_date").distinct()


@query
def left_join_dim(t: Tables) -> DataFrame:
    nation = t["nation"].join(t["region"], F.col("n_nationkey") == F.col("r_regionkey"), "left")
    return (
        t["customer"]
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "n_name", "r_name")
    )


@query
def business_day_count(t: Tables) -> DataFrame:
    days = t["orders"].select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    table = calendar.trading_calendar(days, "day", t["holidays"], baseline=CALENDAR_START)
    return days.join(table, "day").select("o_orderkey", "day", "is_trading_day", "day_count", "file_number")


@query
def business_days_by_country(t: Tables) -> DataFrame:
    country = F.concat(F.lit("C"), (F.col("o_custkey") % 4).cast("string")).alias("country")
    rows = t["orders"].select("o_orderkey", country, F.to_date("o_orderdate").alias("day"))
    return calendar.trading_day_numbers(rows, "day", "country", t["country_holidays"], baseline=CALENDAR_START)


@query
def trading_day_gate(t: Tables) -> DataFrame:
    rows = t["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return calendar.trading_days_only(rows, "day", t["holidays"]).select("o_orderkey", "day", "o_totalprice")


LOADED = schema_of(
    "l_orderkey BIGINT NOT NULL, l_shipdate DATE NOT NULL, l_quantity DOUBLE NOT NULL, "
    "l_linenumber BIGINT, l_returnflag STRING, l_tax DOUBLE"
)


@query
def schema_enforce(t: Tables) -> DataFrame:
    raw = t["lineitem"].select(
        F.col("l_orderkey").cast("string"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.col("l_quantity").cast("string"),
        "l_linenumber",
        F.format_string("  %s\t ", "l_returnflag").alias("l_returnflag"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).cast("string").alias("l_tax"),
    )
    return load.enforce(load.trimmed(raw, ["l_returnflag"]), LOADED)


@query
def delimited_read(t: Tables) -> DataFrame:
    path = _scratch(t.spark, "delimited")
    padded = t["part"].withColumn("p_name", F.format_string("%s  ", "p_name"))
    padded.write.option("sep", ";").option("header", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return landed_files.read_delimited(t.spark, path, t["part"].schema)


@query
def delimited_rejects(t: Tables) -> DataFrame:
    """Every fifth line ends in a delimiter; some are short, some long, some have a number that is none."""
    path = _scratch(t.spark, "damaged")
    key = F.col("p_partkey")
    size = F.concat(F.col("p_size").cast("string"), F.when(key % 13 == 0, "x").otherwise(""))
    tail = F.when(key % 7 == 0, "").when(key % 11 == 0, ";a;b").when(key % 5 == 0, ";a;").otherwise(";a ")
    t["part"].select(F.concat_ws(";", key.cast("string"), "p_brand", size).alias("line"), tail.alias("tail")).select(
        F.concat("line", "tail")
    ).write.text(path)
    read = landed_files.read_delimited_tolerant(t.spark, path, schema_of("p_partkey BIGINT, p_brand STRING, p_size BIGINT, mark STRING"))
    number = F.coalesce("p_partkey", F.split("bad_line", ";")[0].cast("long"))
    return read.select(number.alias("line_key"), "p_brand", "p_size", "mark", "bad_line", "reason")


@query
def partition_overwrite(t: Tables) -> DataFrame:
    """All days written at once, one day emptied, a load that fails, then that day written again."""
    rows = t["ledger_raw"].select("Txn_Id", "Analyst", "Ticker", "Amount", "p_date")
    table = _scratch(t.spark, "days")
    days = [FIRST_DAY + dt.timedelta(days=i) for i in range((LAST_DAY - FIRST_DAY).days + 1)]
    day_partitions.overwrite_days(rows, table, days)
    day_partitions.overwrite_day(rows.where(F.lit(False)), table, DS)
    broken = rows.withColumn("Ticker", F.raise_error(F.lit("a broken load")).cast("string"))
    try:
        day_partitions.overwrite_day(day_tables.on_day(broken, DS + dt.timedelta(days=1)), table, DS + dt.timedelta(days=1))
    except Exception as failure:
        if "a broken load" not in str(failure):
            raise
    day_partitions.overwrite_day(day_tables.on_day(rows, DS), table, DS)
    return day_tables.read_table(t.spark, table, rows.schema)


@query
def committed_days(t: Tables) -> DataFrame:
    """All days published at once, one replaced by nothing; then a replacement that fails and one that is not published."""
    rows = t["ledger_raw"].select("Txn_Id", "Analyst", "Ticker", "Amount", "p_date")
    store, schemas = commits.Commits(t.spark, _scratch(t.spark, "commits")), {"entries": rows.schema}
    days = [FIRST_DAY + dt.timedelta(days=i) for i in range((LAST_DAY - FIRST_DAY).days + 1)]
    store.publish(store.write(rows, schemas, days))
    store.publish(store.write(rows.where(F.lit(False)), schemas, [DS]))
    after = DS + dt.timedelta(days=1)
    broken = rows.withColumn("Ticker", F.when(F.col("Txn_Id") % 5 == 0, F.raise_error(F.lit("a broken load"))).otherwise(F.col("Ticker")))
    try:
        store.publish(store.write(day_tables.on_day(broken, after), schemas, [after]))
    except Exception as failure:
        if "a broken load" not in str(failure):
            raise
    store.write(rows.where(F.lit(False)), schemas, [after])
    return store.read(store.state(), "entries", None)


@query
def stale_days(t: Tables) -> DataFrame:
    """Entries of all days, totals of each day on top of the day before, and shares made from the entries alone.  Then every third day
    is written again, some without their largest entries, some with the same rows in another order."""
    rows = t["ledger_raw"].select("Txn_Id", "Ticker", "Amount", "p_date")
    store = commits.Commits(t.spark, _scratch(t.spark, "stale"))
    days = [FIRST_DAY + dt.timedelta(days=i) for i in range((LAST_DAY - FIRST_DAY).days + 1)]
    store.publish(store.write(rows, {"entries": rows.schema}, days))
    made = rows.groupBy("p_date", "Ticker").agg(F.sum("Amount").alias("Amount"))
    for name in ("totals", "shares"):
        for day, part in store.write(made, {name: made.schema}, days)[name]["days"].items():
            before = (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()
            read = [("entries", day), *([(name, before)] if name == "totals" else [])]
            state = store.state()
            written = {name: {"schema": made.schema.json(), "days": {day: part}}}
            store.publish(commits.with_inputs(written, {key: store.digest(state, *key) for key in read}))
    again = rows.where(~((F.dayofmonth("p_date") > 12) & (F.col("Amount") > 90))).repartition(3, "Txn_Id")
    store.publish(store.write(again, {"entries": rows.schema}, days[2::3]))
    found = [(table, dt.date.fromisoformat(day), direct) for (table, day), direct in store.stale(store.state()).items()]
    return t.spark.createDataFrame(found, "table_name string, p_date date, direct boolean")


@query
def routed_rows(t: Tables) -> DataFrame:
    """Entries of the day, small ones, and those of other days to three tables by one job; each row with the count observed for its table."""
    rows = t["ledger_raw"].select("Txn_Id", "Ticker", "Amount", F.col("p_date").alias("own_date"))
    route = F.when(F.col("own_date") != F.lit(DS), "other_days").when(F.col("Amount") < 10, "small").otherwise("entries")
    store, columns = warehouse.Warehouse(t.spark, _scratch(t.spark, "routed")), ["Txn_Id", "Ticker", "Amount", "own_date"]
    tables = dict.fromkeys(("entries", "small", "other_days"), columns)
    store.write_routed(rows.withColumn("route", route), tables, DS)
    parts = [store.read(n, DS).select(F.lit(n).alias("route"), "*", F.lit(store.rows_written(n, DS)).cast("long").alias("written")) for n in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def missing_keys(t: Tables) -> DataFrame:
    """Every customer ordered something, so the suppliers' numbers, negative, are requested too."""
    requested = t["customer"].select("c_custkey").unionAll(t["supplier"].select(-F.col("s_suppkey")))
    return checks.missing_keys(requested, t["orders"].withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query
def missing_partitions(t: Tables) -> DataFrame:
    required = t["ledger_raw"].select("p_date").distinct()
    return checks.missing_partitions(required, t["stock_prices"])


def bound() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Tables(spark, folder))

    return {name: bind(function) for name, function in QUERIES.items()}
