"""An independent SQL text per query, for the checking database.

Only the views are shared with the Spark side.  Where the Spark plan takes a different route
(averages before joins, windows instead of day by day, buckets instead of one window), the
text here takes the plain one.
"""

from __future__ import annotations

from bindings.views import PAGE_LABELS, with_views
from daymart.schemas import FINANCIALS, table_schema

DS = "DATE '2024-01-15'"
LAST = "DATE '2024-01-30'"
NOISE = r"@[A-Za-z0–9_]+|[^\x00-\x7F]|[^\w\s\x1c-\x1f]|http\S+"

ORACLES: dict[str, str] = {}


def _add(name: str, select: str, *views: str) -> None:
    ORACLES[name] = with_views(select, *views) if views else select.strip()


def _r4(value: str, name: str | None = None) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,6)), 4) AS DOUBLE) AS {name or value.split('.')[-1]}"


# ---- prices ---------------------------------------------------------------------------

# All keys first, then both sources next to each other; a row has one rate, so it is applied last.
DAILY_PRICES = """
known AS (SELECT p_date, Stock_Code FROM primary_prices UNION SELECT p_date, Ticker FROM backup_prices),
vendor AS (
  SELECT p_date, Ticker AS Stock_Code, Open AS o, High AS h, Low AS l, Close AS c, Volume AS v FROM backup_prices),
rated AS (SELECT * FROM primary_prices LEFT JOIN exchange_rates USING (p_date, Currency)),
daily AS (
  SELECT p_date, Stock_Code, ifnull(Stock_Name, Stock_Code) AS Stock_Name,
         Rate * ifnull(CASE Volume WHEN 0 THEN Last ELSE Open END, o) AS Open, Rate * ifnull(Last, c) AS Close,
         Rate * ifnull(CASE Volume WHEN 0 THEN Last ELSE High END, h) AS High,
         Rate * ifnull(CASE Volume WHEN 0 THEN Last ELSE Low END, l) AS Low, ifnull(Volume, v) AS Volume
  FROM known LEFT JOIN rated USING (p_date, Stock_Code) LEFT JOIN vendor USING (p_date, Stock_Code))"""
_PRICE_VIEWS = ("primary_prices", "backup_prices", "exchange_rates")

_add("daily_prices", f"WITH {DAILY_PRICES} SELECT * FROM daily", *_PRICE_VIEWS)
_add(
    "fx_convert",
    """SELECT p.p_date, Stock_Code, p.Currency, Rate, Last * Rate AS Close
    FROM primary_prices p LEFT JOIN exchange_rates f ON p.p_date = f.p_date AND p.Currency = f.Currency""",
    "primary_prices", "exchange_rates",
)
_add(
    "priority_merge",
    f"""WITH {DAILY_PRICES}
    SELECT p_date, Stock_Code, ifnull(Open, o) AS Open, ifnull(Last, c) AS Close, ifnull(High, h) AS High,
           ifnull(Low, l) AS Low, ifnull(Volume, v) AS Volume
    FROM known LEFT JOIN primary_prices USING (p_date, Stock_Code) LEFT JOIN vendor USING (p_date, Stock_Code)""",
    *_PRICE_VIEWS,
)
_add("distinct_values", "SELECT p_date, Currency FROM primary_prices GROUP BY ALL", "primary_prices")
_add(
    "wide_to_long",
    """SELECT l_orderkey, l_linenumber, 'A' AS Ticker, l_quantity AS Open, l_extendedprice AS Adj_Close FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'B', NULLIF(l_discount, 0), NULLIF(l_tax, 0) FROM lineitem
    WHERE l_discount <> 0 OR l_tax <> 0""",
)
_add(
    "lookback_price_join",
    """SELECT h.p_date AS run_date, Analyst, Ticker, q.p_date AS price_date, Close AS Actual_Price
    FROM holdings h LEFT JOIN stock_prices q ON h.Ticker = q.Stock_Code AND q.p_date BETWEEN h.p_date - 7 AND h.p_date""",
    "holdings", "stock_prices",
)
LATEST = """
latest AS (
  SELECT * FROM (
    SELECT d.run_date, q.Stock_Code, q.p_date, q.Close,
           ROW_NUMBER() OVER (PARTITION BY d.run_date, q.Stock_Code ORDER BY q.p_date DESC) AS age
    FROM (SELECT CAST(UNNEST(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS run_date) d
    JOIN stock_prices q ON q.p_date BETWEEN d.run_date - 7 AND d.run_date) AS aged
  WHERE age = 1)"""
_add(
    "latest_price_asof",
    f"""WITH {LATEST}
    SELECT h.p_date AS run_date, Analyst, Ticker, q.p_date AS price_date, Close AS Actual_Price
    FROM holdings h LEFT JOIN latest q ON h.Ticker = q.Stock_Code AND h.p_date = q.run_date""",
    "holdings", "stock_prices",
)

_add(
    "price_asof_hot",
    """SELECT Txn_Id, Stock_Code, run_date, CASE WHEN near THEN p_date END AS p_date, CASE WHEN near THEN Close END AS Close FROM (
      SELECT a.*, q.p_date, q.Close, a.run_date - q.p_date <= 1 AS near
      FROM (SELECT Txn_Id, CASE WHEN Txn_Id % 2 = 0 THEN 'T1' ELSE Ticker END AS Stock_Code, p_date AS run_date FROM ledger_raw) a
      ASOF LEFT JOIN stock_prices q ON a.Stock_Code = q.Stock_Code AND a.run_date >= q.p_date) AS found""",
    "ledger_raw", "stock_prices",
)

# ---- ledger and portfolio -------------------------------------------------------------

SIGNED = "CASE WHEN Txn_Type = 'BUY' THEN Amount ELSE -Amount END"
CARRIED = f"""
carried AS (
  SELECT p_date AS run_date, Analyst, Ticker, Price, Txn_Type, {SIGNED} AS Amount, p_date, FALSE AS is_opening, Txn_Time
  FROM ledger_raw
  UNION ALL
  SELECT CAST(p_date + 1 AS DATE), Analyst, Ticker, 0, 'Buy', Amount, p_date, TRUE, NULL FROM holdings)"""
VALID = f"""{CARRIED},
listed AS (
  SELECT *, list(Amount) OVER (PARTITION BY run_date, Analyst, Ticker ORDER BY Txn_Time NULLS FIRST, Txn_Type) AS so_far
  FROM carried),
valid AS (
  SELECT Analyst, Ticker, Price, Txn_Type, Amount, p_date, Txn_Time FROM listed
  WHERE p_date = run_date AND Amount + CASE WHEN len(so_far) = 1 THEN 0.0 ELSE
    list_reduce(so_far[1:len(so_far) - 1], lambda total, a: CASE WHEN total + a >= 0 THEN total + a ELSE total END,
                CAST(0 AS DOUBLE)) END >= 0)"""
_LEDGER_VIEWS = ("ledger_raw", "holdings")

_add("carry_forward_union", f"WITH {CARRIED} SELECT * FROM carried", *_LEDGER_VIEWS)
_add("ledger_validate", f"WITH {VALID} SELECT * FROM valid", *_LEDGER_VIEWS)
_add("ledger_validate_split", f"WITH {VALID} SELECT * FROM valid", *_LEDGER_VIEWS)
_add(
    "ledger_validate_hovering",
    f"WITH {VALID.replace('ledger_raw', 'hovering_ledger')} SELECT * FROM valid", "hovering_ledger", "holdings",
)
_add(
    "running_position",
    f"""SELECT Txn_Id, Analyst, Ticker, {_r4("Running_Amount")}, {_r4("Running_Value")} FROM (
    SELECT *, SUM({SIGNED}) OVER w AS Running_Amount, SUM(({SIGNED}) * Price) OVER w AS Running_Value
    FROM ledger_raw WINDOW w AS (PARTITION BY Analyst, Ticker ORDER BY Txn_Time)) AS run""",
    "ledger_raw",
)


def _events(ledger: str) -> str:
    return f"""
total AS (
  SELECT Analyst, Ticker, Amount, Txn_Type, Price, Txn_Time, p_date, p_date AS run_date FROM {ledger}
  UNION ALL
  SELECT Analyst, Ticker, Amount, 'BUY', Avg_Price, CAST(p_date AS TIMESTAMP), p_date, CAST(p_date + 1 AS DATE)
  FROM holdings)"""


_add(
    "signed_balance",
    f"""WITH {_events("ledger_raw")}
    SELECT run_date, Analyst, Ticker, SUM({SIGNED}) AS Amount,
           SUM(CASE WHEN p_date < run_date THEN {SIGNED} ELSE 0 END) AS Daily_Amount_Change
    FROM total GROUP BY ALL""",
    *_LEDGER_VIEWS,
)
_add(
    "last_state",
    """SELECT Analyst, Ticker, Txn_Time, Txn_Type, Amount, Price FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY Analyst, Ticker ORDER BY Txn_Time DESC) AS num FROM ledger_raw) AS r
    WHERE num = 1""",
    "ledger_raw",
)


def _snapshot(moved: str, sold: str, change: str, average: str, diff: str, quotes: str) -> str:
    return f"""{VALID}, {_events("valid")},
run AS (
  SELECT *, SUM(m) OVER w AS ra, SUM(m * Price) OVER w AS rv
  FROM (SELECT *, {moved} AS m, {sold} AS s, CAST({change} AS INT) AS counted FROM total) AS t
  WINDOW w AS (PARTITION BY run_date, Analyst, Ticker ORDER BY Txn_Time)),
held AS (
  SELECT run_date, Analyst, Ticker, SUM(m) AS Amount, SUM(m * counted) AS Daily_Amount_Change,
         SUM(CASE Txn_Type WHEN 'SELL' THEN s * (Price - rv / NULLIF(ra, 0)) ELSE 0 END) AS Realised_Gain,
         last({average} ORDER BY Txn_Time) AS Avg_Price
  FROM run GROUP BY ALL),
{quotes},
snapshot AS (
  SELECT Analyst, Ticker, Amount, Daily_Amount_Change, Realised_Gain, ({diff}) * Amount AS Unrealised_Gain,
         h.run_date AS p_date, Avg_Price
  FROM held h LEFT JOIN quotes q ON h.run_date = q.run_date AND h.Ticker = q.Stock_Code)"""


SNAPSHOT = _snapshot(
    SIGNED, "Amount", "p_date < run_date", "ra / NULLIF(rv, 0)", "Avg_Price - Actual_Price",
    """quotes AS (SELECT d.run_date, Stock_Code, Close AS Actual_Price
       FROM (SELECT DISTINCT run_date FROM total) d
       JOIN (SELECT DISTINCT Stock_Code, Close, p_date FROM stock_prices) p
         ON p.p_date BETWEEN d.run_date - 7 AND d.run_date)""",
)
SNAPSHOT_INTENT = _snapshot(
    "Amount", "-Amount", "p_date = run_date", "rv / NULLIF(ra, 0)", "Actual_Price - Avg_Price",
    LATEST + ", quotes AS (SELECT run_date, Stock_Code, Close AS Actual_Price FROM latest)",
)
SNAPSHOT_OUT = ", ".join(
    ["Analyst", "Ticker", "p_date"]
    + [_r4(c) for c in ("Amount", "Daily_Amount_Change", "Realised_Gain", "Unrealised_Gain", "Avg_Price")]
)
_SNAPSHOT_VIEWS = (*_LEDGER_VIEWS, "stock_prices")
_add("portfolio_snapshot", f"WITH {SNAPSHOT} SELECT {SNAPSHOT_OUT} FROM snapshot", *_SNAPSHOT_VIEWS)
_add("portfolio_snapshot_intent", f"WITH {SNAPSHOT_INTENT} SELECT {SNAPSHOT_OUT} FROM snapshot", *_SNAPSHOT_VIEWS)
_add(
    "mart_portfolio",
    f"""WITH {SNAPSHOT}
    SELECT Analyst, First_Name, Last_Name, Email, Ticker, p_date,
           {", ".join(_r4(c) for c in ("Amount", "Daily_Amount_Change", "Realised_Gain", "Unrealised_Gain"))}
    FROM snapshot LEFT JOIN employees ON Analyst = Employee_Id""",
    *_SNAPSHOT_VIEWS, "employees",
)

# Entry by entry and holding by holding: the day's opening value is carried unless the
# holding was empty.
_add(
    "portfolio_backfill",
    f"""WITH RECURSIVE
entry AS (
  SELECT *, {SIGNED} AS moved,
         ROW_NUMBER() OVER (PARTITION BY Analyst, Ticker ORDER BY p_date, Txn_Time, Txn_Type, Txn_Id) AS n
  FROM ledger_raw),
fold AS (
  SELECT Analyst, Ticker, n, p_date, Txn_Type, Price, moved, moved >= 0 AS ok,
         CASE WHEN moved >= 0 THEN moved ELSE 0 END AS ra, CASE WHEN moved >= 0 THEN moved * Price ELSE 0 END AS rv
  FROM entry WHERE n = 1
  UNION ALL
  SELECT Analyst, Ticker, n, p_date, Txn_Type, Price, moved, ra + moved >= 0,
         CASE WHEN ra + moved >= 0 THEN ra + moved ELSE ra END,
         CASE WHEN ra + moved >= 0 THEN rv_open + moved * Price ELSE rv_open END
  FROM (SELECT e.*, f.ra, CASE WHEN e.p_date <> f.p_date AND f.ra = 0 THEN 0 ELSE f.rv END AS rv_open
        FROM fold f JOIN entry e ON e.Analyst = f.Analyst AND e.Ticker = f.Ticker AND e.n = f.n + 1) AS step),
accepted AS (SELECT * FROM fold WHERE ok),
days AS (
  SELECT Analyst, Ticker, p_date, SUM(moved) AS day_change, arg_max(ra, n) AS ra, arg_max(rv, n) AS rv,
         SUM(CASE WHEN Txn_Type = 'SELL' THEN -moved * (Price - rv / NULLIF(ra, 0)) ELSE 0 END) AS gain
  FROM accepted GROUP BY Analyst, Ticker, p_date),
{LATEST},
spread AS (
  SELECT Analyst, Ticker, p_date, day_change, ra, rv, gain,
         CAST(UNNEST(generate_series(p_date, COALESCE(LEAD(p_date) OVER w - 1, {LAST}), INTERVAL 1 DAY)) AS DATE) AS run_date
  FROM days WINDOW w AS (PARTITION BY Analyst, Ticker ORDER BY p_date)),
snapshot AS (
  SELECT Analyst, Ticker, ra AS Amount, CASE WHEN s.run_date = s.p_date THEN day_change ELSE 0 END AS Daily_Amount_Change,
         CASE WHEN s.run_date = s.p_date THEN COALESCE(gain, 0) ELSE 0 END AS Realised_Gain,
         (Close - rv / NULLIF(ra, 0)) * ra AS Unrealised_Gain, s.run_date AS p_date, rv / NULLIF(ra, 0) AS Avg_Price
  FROM spread s LEFT JOIN latest q ON s.run_date = q.run_date AND s.Ticker = q.Stock_Code)
SELECT {SNAPSHOT_OUT} FROM snapshot""",
    "ledger_raw", "stock_prices",
)

# ---- text and sentiment ---------------------------------------------------------------


def _clean(column: str) -> str:
    return f"regexp_replace({column}, '{NOISE}', '', 'g')"


def _line(column: str) -> str:
    return f"replace({column}, chr(10), ' ')"


def _first(keys: str, rows: str, columns: str) -> str:
    return f"""(SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY seq) AS num
      FROM ({rows}) AS c) AS r WHERE num = 1)"""


CLEANED = f"""
social_clean AS {_first("content, ticker, p_date",
    f"SELECT seq, p_date, {_line('ticker')} AS ticker, {_line('source')} AS source, {_line(_clean('content'))} AS content FROM social",
    "seq, p_date, ticker, source, content")},
news_clean AS {_first("title, ticker",
    f"SELECT seq, p_date, ticker, source, {_clean('title')} AS title, {_clean('description')} AS description FROM news",
    "seq, p_date, ticker, source, title, description")},
forum_clean AS {_first("title, p_date",
    f"SELECT seq, source, {_clean('title')} AS title, p_date FROM forum", "seq, source, title, p_date")}"""
_POST_VIEWS = ("social", "news", "forum")


def _score(rows: str, column: str) -> str:
    return f"""(SELECT c.seq, ANY_VALUE(c.p_date) AS p_date, {"NULL" if rows == "forum_clean" else "ANY_VALUE(c.ticker)"} AS ticker,
      COALESCE(SUM(weight), 0) / 1000.0 AS v
      FROM (SELECT *, UNNEST(regexp_split_to_array(lower({column}), '\\s+')) AS token FROM {rows}) AS c
      LEFT JOIN lexicon ON c.token = lexicon.token GROUP BY c.seq)"""


def _compound(rows: str) -> str:
    return f"""(SELECT seq, p_date, ticker,
      CAST(ROUND(CAST(CAST(v AS DOUBLE) / sqrt(CAST(v AS DOUBLE) * CAST(v AS DOUBLE) + 15) AS DECIMAL(28,12)), 4) AS DOUBLE) AS score
      FROM {rows} AS sums)"""


SCORED = f"""{CLEANED},
social_scored AS {_compound(_score("social_clean", "content"))},
news_scored AS {_compound(_score("news_clean", "description"))},
forum_scored AS {_compound(_score("forum_clean", "title"))}"""
LABEL = "CASE WHEN score > 0.4 THEN 'positive' WHEN score < -0.4 THEN 'negative' ELSE 'neutral' END"
OVERALL = "CASE WHEN {0} > 0.3 THEN 'POSITIVE' WHEN {0} < -0.3 THEN 'NEGATIVE' ELSE 'NEUTRAL' END"

_add(
    "clean_text",
    f"SELECT doc_id, {_clean('text')} AS cleaned, {_line(_clean('text'))} AS line FROM documents",
)
_add(
    "dedup_keep_first",
    """SELECT d.doc_id, d.source, d.lang FROM documents d
    JOIN (SELECT text, source, MIN(doc_id) AS doc_id FROM documents GROUP BY text, source) k ON d.doc_id = k.doc_id""",
)
_add(
    "clean_dedup_posts",
    f"""WITH {CLEANED}
    SELECT 'social' AS kind, seq, p_date, ticker, source, NULL AS title, NULL AS description, content FROM social_clean
    UNION ALL SELECT 'news', seq, p_date, ticker, source, title, description, NULL FROM news_clean
    UNION ALL SELECT 'forum', seq, p_date, NULL, source, title, NULL, NULL FROM forum_clean""",
    *_POST_VIEWS,
)
_add(
    "union_sources",
    """SELECT seq, 'Reddit: ' || source AS source, title, p_date, NULL AS ticker FROM forum
    UNION ALL SELECT seq, 'Twitter: #SGX', content, p_date, ticker FROM social""",
    "forum", "social",
)
_add(
    "keyword_tag",
    """SELECT doc_id, s.keyword, code AS ticker, 'Twitter seachword: ' || s.keyword AS source
    FROM searched s JOIN keywords k ON s.keyword = k.keyword""",
    "searched", "keywords",
)
_add(
    "top_n_per_key",
    """SELECT Ticker, p_date, Txn_Id, Txn_Time FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY Ticker, p_date ORDER BY Txn_Time DESC, Txn_Id) AS num FROM ledger_raw) AS r
    WHERE num <= 6""",
    "ledger_raw",
)
_add(
    "newest_per_forum",
    """SELECT event_type, event_id, ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS num FROM events) AS r
    WHERE num <= 1500""",
)
_add(
    "lexicon_sentiment",
    f"""WITH {SCORED}
    SELECT 'social' AS kind, seq, score AS NLTK_score, {LABEL} AS NLTK_sentiment FROM social_scored
    UNION ALL SELECT 'news', seq, score, {LABEL} FROM news_scored
    UNION ALL SELECT 'forum', seq, score, {LABEL} FROM forum_scored""",
    *_POST_VIEWS, "lexicon",
)
_add("sentiment_label", f"SELECT event_id, score, {LABEL} AS post, {OVERALL.format('score')} AS overall FROM scores", "scores")
_add(
    "combined_mean",
    """SELECT user_id, p_date, CAST(ROUND(CAST(COALESCE((a + b) / 2, a, b)
    AS DECIMAL(28,12)), 5) AS DOUBLE) AS combined FROM (
    SELECT user_id, p_date, CAST(first_sum * 1000 AS DOUBLE) / NULLIF(first_n, 0) / 1000000 AS a,
           CAST(second_sum * 1000 AS DOUBLE) / NULLIF(second_n, 0) / 1000000 AS b FROM two_means) AS m""",
    "two_means",
)


def _mean(column: str) -> str:
    micros = f"CAST(ROUND({column} * 1000000) AS BIGINT)"
    return f"CAST(SUM({micros}) AS DOUBLE) / COUNT({micros}) / 1000000"


def _r5(value: str) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,12)), 5) AS DOUBLE)"


# Every combination of a day's social, news and forum rows of a listed ticker.
ROLLUP = f"""{SCORED},
combos AS (
  SELECT a.p_date, a.ticker, m.company_name, a.score AS a, b.score AS b, c.score AS c
  FROM social_scored a JOIN forum_scored c ON c.p_date = a.p_date
  JOIN master m ON m.stock_code = a.ticker AND m.p_date = a.p_date
  LEFT JOIN news_scored b ON b.p_date = a.p_date AND b.ticker = a.ticker),
means AS (
  SELECT p_date, ticker, company_name, {_mean("a")} AS a, {_mean("b")} AS b, {_mean("c")} AS c FROM combos GROUP BY ALL),
rounded AS (
  SELECT p_date, ticker, company_name, {_r5("a")} AS avg_twitter_score_ticker, {_r5("b")} AS avg_news_score_ticker,
         {_r5("ifnull((a + b) / 2, a)")} AS combined_sentiment_score_ticker,
         {_r5("c")} AS benchmark_score_for_today_market FROM means),
rollup_rows AS (
  SELECT *, {OVERALL.format("combined_sentiment_score_ticker")} AS overall_sentiment_for_ticker FROM rounded)"""
_SENTIMENT_VIEWS = (*_POST_VIEWS, "lexicon", "master")
_add("sentiment_rollup", f"WITH {ROLLUP} SELECT * FROM rollup_rows", *_SENTIMENT_VIEWS)
_add(
    "mart_sentiment",
    f"""WITH {ROLLUP} SELECT p_date, ticker, company_name, combined_sentiment_score_ticker,
    benchmark_score_for_today_market, overall_sentiment_for_ticker FROM rollup_rows""",
    *_SENTIMENT_VIEWS,
)
_add(
    "sentiment_rollup_intent",
    f"""WITH {SCORED},
either AS (SELECT p_date, ticker FROM social_scored UNION SELECT p_date, ticker FROM news_scored),
means AS (
  SELECT p_date, ticker,
    (SELECT {_mean("s.score")} FROM social_scored s WHERE s.p_date = e.p_date AND s.ticker = e.ticker) AS a,
    (SELECT {_mean("n.score")} FROM news_scored n WHERE n.p_date = e.p_date AND n.ticker = e.ticker) AS b,
    (SELECT {_mean("f.score")} FROM forum_scored f WHERE f.p_date = e.p_date) AS c
  FROM either e),
rounded AS (
  SELECT p_date, ticker, {_r5("a")} AS avg_twitter_score_ticker, {_r5("b")} AS avg_news_score_ticker,
         {_r5("COALESCE((a + b) / 2, a, b)")} AS combined_sentiment_score_ticker,
         {_r5("c")} AS benchmark_score_for_today_market FROM means)
SELECT t.*, m.company_name, {OVERALL.format("combined_sentiment_score_ticker")} AS overall_sentiment_for_ticker
FROM rounded t LEFT JOIN master m ON t.ticker = m.stock_code AND m.p_date = t.p_date""",
    *_SENTIMENT_VIEWS,
)

# ---- pages, payloads, names, dates ----------------------------------------------------

_add(
    "html_extract",
    """SELECT page_id, CAST(item_no - 1 AS INT) AS item_no, regexp_extract(link, 'href="([^"]*)"', 1) AS href,
    regexp_extract(link, '>([^<]*)<', 1) AS label FROM (
    SELECT page_id, UNNEST(links) AS link, UNNEST(range(1, len(links) + 1)) AS item_no FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS links FROM pages) AS p) AS l""",
)
_add(
    "html_kv_pivot",
    "SELECT Ticker, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PAGE_LABELS.values()) + " FROM financials_raw",
    "financials_raw",
)
_add(
    "pivot_kv",
    "SELECT user_id, "
    + ", ".join(
        f"MIN(value) FILTER (WHERE event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
)
_K = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)"""
_add("json_extract", f"SELECT event_id, {_K} AS k, value AS rate FROM events")
_add("variant_rates", "SELECT event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN value END AS rate FROM events")
_add(
    "unknown_fields",
    """SELECT field, kind, 2 * count(*) AS n_records FROM (
      SELECT 'id' AS field, 'BIGINT' AS kind FROM events
      UNION ALL SELECT event_type, CASE event_type WHEN 'view' THEN 'STRING' ELSE 'BOOLEAN' END FROM events) AS f
    GROUP BY field, kind""",
)
_add(
    "page_gaps",
    """WITH landed AS (SELECT DISTINCT o_orderstatus AS list_name, o_orderkey AS n FROM orders WHERE o_custkey % 3 <> 0),
    wanted AS (SELECT list_name, unnest(range(0, max(n))) AS n FROM landed GROUP BY list_name),
    absent AS (SELECT list_name, n FROM wanted EXCEPT SELECT list_name, n FROM landed),
    runs AS (SELECT list_name, n, n - row_number() OVER (PARTITION BY list_name ORDER BY n) AS island FROM absent)
    SELECT list_name, min(n) AS from_page, max(n) AS to_page FROM runs GROUP BY list_name, island""",
)
_add(
    "numbered_pages",
    """SELECT 'list' AS list_name, page_id % 32 AS page_number, CAST(sum(length(replace(html, chr(10), ''))) AS INT) AS n_chars
    FROM pages GROUP BY page_id % 32""",
)
_add(
    "json_records",
    f"""SELECT event_id, {_K} AS k, 'page' AS kind FROM events UNION ALL SELECT event_id, {_K}, 'page' FROM events
    UNION ALL SELECT event_id, {_K}, 'chart' FROM events""",
)
_add(
    "exchange_rate_table",
    f"""SELECT Currency, CAST('1.' || replace(Currency, 'Brand#', '') AS DOUBLE) AS Rate, {DS} AS p_date
    FROM (SELECT DISTINCT Currency FROM primary_prices) AS c""",
    "primary_prices",
)
_add(
    "stock_list_table",
    f"""SELECT c_mktsegment AS issue, CAST(2024 AS BIGINT) AS "year", c_name AS company_name, c_custkey AS "rank",
    CAST(0 AS BIGINT) AS adjustment, c_acctbal AS base_score, c_acctbal * 2 AS total_score,
    'C' || c_custkey AS stock_code, CAST(NULL AS VARCHAR) AS isin_code, {DS} AS p_date FROM customer""",
)
_add(
    "intraday_chart",
    "SELECT "
    + ", ".join(
        f"CAST(event_id * {i + 1} AS DOUBLE) AS {f.name}" if f.dataType.simpleString() == "double" else f"'{f.name} ' || event_type AS {f.name}"
        for i, f in enumerate(f for f in table_schema("intraday_chart").fields if f.name != "p_date")
    )
    + f", {DS} AS p_date FROM events",
)
_add(
    "strip_suffix",
    "SELECT p_partkey, 'S' || p_partkey || '.SI' AS ticker, split_part('S' || p_partkey || '.SI', '.', 1) AS code FROM part",
)
_add(
    "normalise_names",
    """SELECT p_partkey, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    p_type || '/' || p_name || ' (52-week) % of ' || p_size || ' & 5 year 200-day',
    '/', ''), ' ', '_'), '(', '_'), ')', '_'), '-', '_'), '%', 'percent'), '&', 'n'), '52', '_52'), '50', '_50'),
    '200', '_200'), '5_year', '_5_year') AS name FROM part""",
)
_add(
    "epoch_to_date",
    """SELECT event_id, CAST(to_timestamp(1704067200 + event_id * 37) AT TIME ZONE 'UTC' AS DATE) AS day,
    CAST(epoch_ms((1704067200 + event_id * 37) * 1000 + event_id % 1000) AS DATE) AS day_from_millis FROM events""",
)
_add(
    "date_parts",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m%d') AS label,
    CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day, CAST(CAST(o_orderdate AS DATE) - 7 AS DATE) AS week_before
    FROM orders""",
)

# ---- financial statistics -------------------------------------------------------------


def _percent(c: str) -> str:
    return f"CAST(rtrim(replace({c}, ',', ''), '%') AS DOUBLE) / 100.0"


def _magnitude(c: str) -> str:
    cut = f"CAST(left({c}, len({c}) - 1) AS DOUBLE)"
    return f"""CASE WHEN {c} IS NULL THEN 0.0 WHEN suffix({c}, 'k') THEN {cut} * 1000.0
      WHEN suffix({c}, 'M') THEN {cut} * 1000000.0 WHEN suffix({c}, 'B') THEN {cut} * 1000000000.0
      ELSE CAST({c} AS DOUBLE) END"""


def _ratio(c: str) -> str:
    return f"""CASE WHEN len(string_split({c}, ':')) = 2
      THEN CAST(split_part({c}, ':', 1) AS DOUBLE) / CAST(split_part({c}, ':', 2) AS DOUBLE) END"""


for _name, _column, _parse in (
    ("parse_percent", "percent_text", _percent),
    ("parse_magnitude", "magnitude_text", _magnitude),
    ("parse_ratio", "ratio_text", _ratio),
):
    _add(_name, f"SELECT l_orderkey, l_linenumber, {_column}, {_parse(_column)} AS value FROM messy", "messy")

_PARSERS = {
    "number": lambda c: c, "text_number": lambda c: f"CAST({c} AS DOUBLE)", "percent": _percent,
    "magnitude": _magnitude, "ratio": _ratio, "number_ratio": lambda c: "CAST(NULL AS DOUBLE)",
}
CLEAN_FINANCIALS = "financials AS (SELECT p_date, Ticker, {} FROM financials_raw)".format(
    ", ".join(f"{_PARSERS[k](n)} AS {n}" for n, k in FINANCIALS if k != "dropped")
)
_add("financials_clean", f"WITH {CLEAN_FINANCIALS} SELECT * FROM financials", "financials_raw")
_add(
    "full_outer_using",
    """SELECT COALESCE(p.Ticker, f.Ticker) AS Ticker, Stock_Name, Trailing_PE
    FROM (SELECT Stock_Code || '.SI' AS Ticker, Stock_Name FROM primary_prices) p
    FULL OUTER JOIN financials_raw f ON p.Ticker = f.Ticker""",
    "primary_prices", "financials_raw",
)
_MEASURES = [
    ("Pricebook__mrq_ AS Enterprise_valuerevenue" if n == "Pricebook__mrq_" else n)
    for n, k in FINANCIALS
    if k != "dropped" and n != "Enterprise_valuerevenue"
]
# Statistics with their prices if any, then the prices that have no statistics.
_add(
    "mart_prices_financials",
    f"""WITH {DAILY_PRICES}, {CLEAN_FINANCIALS},
listed AS (SELECT *, Stock_Code || '.SI' AS Ticker FROM daily)
SELECT p_date, ifnull(Stock_Code, Ticker) AS Stock_Code, ifnull(Stock_Name, Ticker) AS Stock_Name,
       Open, Close, High, Low, Volume, {", ".join(_MEASURES)}
FROM financials LEFT JOIN listed USING (p_date, Ticker)
UNION ALL
SELECT p_date, Stock_Code, Stock_Name, Open, Close, High, Low, Volume, {", ".join("NULL" for _ in _MEASURES)}
FROM listed ANTI JOIN financials USING (p_date, Ticker)""",
    *_PRICE_VIEWS, "financials_raw",
)

# ---- scans, joins, calendar, loads, checks --------------------------------------------

_add("partition_scan", f"SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = {DS}")
_add("param_scan", f"SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = {DS} AND value > 0")
_add(
    "latest_partition_distinct",
    "SELECT DISTINCT Ticker, p_date FROM ledger_raw WHERE p_date = (SELECT MAX(p_date) FROM ledger_raw)",
    "ledger_raw",
)
_add(
    "left_join_dim",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_nationkey = r_regionkey""",
)
_add(
    "business_day_count",
    """WITH span AS (
  SELECT CAST(UNNEST(generate_series(DATE '1990-01-01', DATE '2005-12-31', INTERVAL 1 DAY)) AS DATE) AS day),
trading AS (
  SELECT day FROM span WHERE isodow(day) <= 5 AND day NOT IN (SELECT holiday FROM holidays)),
counted AS (
  SELECT d.day, (SELECT COUNT(*) FROM trading x WHERE x.day >= DATE '1998-01-01' AND x.day <= d.day)
              - (SELECT COUNT(*) FROM trading x WHERE x.day < DATE '1998-01-01' AND x.day > d.day) AS n
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) d)
SELECT o_orderkey, day, isodow(day) <= 5 AND day NOT IN (SELECT holiday FROM holidays) AS is_trading_day,
       n AS day_count, 6187 + n AS file_number
FROM orders JOIN counted ON CAST(o_orderdate AS DATE) = day""",
    "holidays",
)
_add(
    "business_days_by_country",
    """WITH placed AS (
  SELECT o_orderkey, 'C' || CAST(o_custkey % 4 AS STRING) AS country, CAST(o_orderdate AS DATE) AS day FROM orders),
trading AS (
  SELECT c.country, s.day
  FROM (SELECT DISTINCT country FROM placed) c,
       (SELECT CAST(UNNEST(generate_series(DATE '1990-01-01', DATE '2005-12-31', INTERVAL 1 DAY)) AS DATE) AS day) s
  WHERE isodow(s.day) <= 5 AND NOT EXISTS (SELECT 1 FROM country_holidays h WHERE h.country = c.country AND h.holiday = s.day)),
counted AS (
  SELECT d.country, d.day, SUM(CASE WHEN x.day >= DATE '1998-01-01' AND x.day <= d.day THEN 1
                                    WHEN x.day < DATE '1998-01-01' AND x.day > d.day THEN -1 ELSE 0 END) AS n,
         COUNT(CASE WHEN x.day = d.day THEN 1 END) > 0 AS open
  FROM (SELECT DISTINCT country, day FROM placed) d JOIN trading x ON x.country = d.country
  GROUP BY d.country, d.day)
SELECT p.o_orderkey, p.country, p.day, c.open AS is_trading_day, CAST(c.n AS BIGINT) AS day_count, CAST(6187 + c.n AS BIGINT) AS file_number
FROM placed p JOIN counted c ON c.country = p.country AND c.day = p.day""",
    "country_holidays",
)
_add(
    "trading_day_gate",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
    WHERE isodow(o_orderdate) <= 5 AND CAST(o_orderdate AS DATE) NOT IN (SELECT holiday FROM holidays)""",
    "holidays",
)
_add(
    "schema_enforce",
    """SELECT l_orderkey, CAST(l_shipdate AS DATE) AS l_shipdate, l_quantity,
    CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, NULLIF(l_tax, 0) AS l_tax FROM lineitem""",
)
_add("delimited_read", "SELECT * FROM part")
_add(
    "delimited_rejects",
    """SELECT p_partkey AS line_key, CASE WHEN reason IS NULL THEN p_brand END AS p_brand,
       CASE WHEN reason IS NULL THEN CAST(p_size AS BIGINT) END AS p_size, CASE WHEN reason IS NULL THEN 'a' END AS mark,
       CASE WHEN reason IS NOT NULL THEN concat_ws(';', p_partkey, p_brand, CAST(p_size AS STRING) || CASE WHEN p_partkey % 13 = 0 THEN 'x' ELSE '' END)
            || CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN ';a;b' WHEN p_partkey % 5 = 0 THEN ';a;' ELSE ';a ' END END AS bad_line,
       reason
FROM (SELECT *, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN 'fields' WHEN p_partkey % 13 = 0 THEN 'p_size' END AS reason FROM part) AS p""",
)
_add("partition_overwrite", "SELECT Txn_Id, Analyst, Ticker, Amount, p_date FROM ledger_raw", "ledger_raw")
_add("committed_days", "SELECT Txn_Id, Analyst, Ticker, Amount, p_date FROM ledger_raw WHERE p_date <> DATE '2024-01-15'", "ledger_raw")
_add(
    "stale_days",
    """WITH changed AS (
      SELECT DISTINCT p_date FROM ledger_raw
      WHERE p_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-30' AND day(p_date) % 3 = 0 AND Amount > 90),
    days AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS p_date)
    SELECT 'shares' AS table_name, p_date, TRUE AS direct FROM changed
    UNION ALL
    SELECT 'totals', p_date, p_date IN (SELECT p_date FROM changed) FROM days WHERE p_date >= (SELECT min(p_date) FROM changed)""",
    "ledger_raw",
)
_add(
    "routed_rows",
    """SELECT *, count(*) OVER (PARTITION BY route) AS written FROM (
    SELECT CASE WHEN p_date <> DATE '2024-01-15' THEN 'other_days' WHEN Amount < 10 THEN 'small' ELSE 'entries' END AS route,
           Txn_Id, Ticker, Amount, p_date AS own_date, DATE '2024-01-15' AS p_date FROM ledger_raw) AS r""",
    "ledger_raw",
)
_add(
    "missing_keys",
    """SELECT DISTINCT c_custkey FROM (SELECT c_custkey FROM customer UNION ALL SELECT -s_suppkey FROM supplier) c
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
)
_add(
    "missing_partitions",
    """SELECT DISTINCT p_date FROM ledger_raw l
    WHERE NOT EXISTS (SELECT 1 FROM stock_prices s WHERE s.p_date = l.p_date)""",
    "ledger_raw", "stock_prices",
)

# The same result by another route.
ORACLES["running_position_split"] = ORACLES["running_position"]
ORACLES["lexicon_sentiment_joined"] = ORACLES["lexicon_sentiment"]

# Pages: every seventh article has a date that cannot be read, every eleventh page has no statistics.
_NEWS = """'Part ' || CAST(p_partkey AS VARCHAR) AS title, p_brand AS source, p_type || ' & more' AS description,
    'T' || CAST(p_size AS VARCHAR) AS ticker, 'http://' || p_brand AS url"""
_add("news_items", f"SELECT 0 AS item_no, DATE '2024-01-01' + CAST(p_partkey % 30 AS INT) AS p_date, {_NEWS} FROM part WHERE p_partkey % 7 <> 0")
_add("news_rejects", f"SELECT 0 AS item_no, {_NEWS} FROM part WHERE p_partkey % 7 = 0")
_add(
    "financials_raw",
    f"SELECT {DS} AS p_date, Ticker, " + ", ".join(name for name, _ in FINANCIALS) + " FROM financials_raw WHERE length(Ticker) % 5 <> 0",
    "financials_raw",
)
_add(
    "financials_rejects",
    """SELECT Ticker, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS value FROM financials_raw WHERE length(Ticker) % 5 = 0
    UNION ALL SELECT Ticker, 'Colour', 'blue' FROM financials_raw WHERE length(Ticker) % 5 <> 0""",
    "financials_raw",
)
