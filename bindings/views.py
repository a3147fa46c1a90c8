"""Market-data shaped views over the test tables.

Each text runs unchanged in Spark SQL and in the checking database (but for the name of the
weekday function); ``{name}`` refers to a table or another view.  Every view reads its
whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from daymart.plans.sentiment import TICKER_OF_KEYWORD
from daymart.schemas import FINANCIALS

BASE_TABLES = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
}

# A small fixed lexicon of words that occur in the test texts: token, valence.
LEXICON = {
    "the": 0.1, "of": -0.3, "and": 0.2, "to": -0.2, "in": 0.3, "is": 0.9, "that": -0.7, "for": 1.1,
    "it": -0.5, "was": -1.3, "on": 0.6, "with": 1.5, "be": -0.4, "as": 0.8, "by": -0.9, "this": 1.2,
    "are": -1.1, "de": -0.2, "la": 0.3, "les": 0.7, "der": -0.6, "und": 0.5, "que": 0.2, "en": -0.1,
}


def _raw_statistic(i: int, name: str, kind: str) -> str:
    n = f"n{i}"
    digits = f"CAST({n} % 1000 AS STRING)"
    text = {
        "number": f"CAST({n} AS DOUBLE) / 100",
        "number_ratio": f"CAST({n} AS DOUBLE) / 100",
        "text_number": f"CAST({n} AS STRING) || '.5'",
        "dropped": f"'on day ' || {digits}",
        "percent": f"CAST({n} % 9 AS STRING) || ',' || lpad({digits}, 3, '0') || '.' || CAST({n} % 10 AS STRING) || '%'",
        "magnitude": f"{digits} || '.' || CAST({n} % 100 AS STRING) || "
        f"CASE {n} % 4 WHEN 0 THEN 'k' WHEN 1 THEN 'M' WHEN 2 THEN 'B' ELSE '' END",
        "ratio": f"CASE {n} % 3 WHEN 0 THEN {digits} || ':' || CAST(1 + {n} % 5 AS STRING) WHEN 1 THEN {digits} "
        f"ELSE '1:2:' || {digits} END",
    }[kind]
    return f"CASE WHEN {n} % 11 = 0 THEN NULL ELSE {text} END AS {name}"


# Labels as a statistics page prints them, and the column each becomes.
_PRINTED = {
    "Market_cap__intra_day_": "Market cap (intra-day)",
    "Pricebook__mrq_": "Pricebook (mrq)",
    "SnP_500__52_week_change_3": "S&amp;P500 52-week change 3",
    "percent_held_by_insiders_1": "% held by insiders 1",
    "Fiscal_year_ends": "Fiscal year ends",
}


def _printed(name: str) -> str:
    """The other labels: the column's name without the underscore that it got for a leading number."""
    for number in ("52", "50", "200", "5_year"):
        name = name.replace(f"_{number}", number)
    return name


PAGE_LABELS = {_PRINTED.get(name) or _printed(name): name for name, _ in FINANCIALS}

_DAY = "DATE '2024-01-01' + CAST({} AS INT)"

VIEWS: dict[str, str] = {
    # analysts' ledger
    "ledger_raw": """
        SELECT CAST(user_id % 13 AS BIGINT) AS Analyst,
               'T' || CAST(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 20 AS STRING) AS Ticker,
               CASE WHEN event_type IN ('purchase', 'click', 'signup') THEN 'BUY' ELSE 'SELL' END AS Txn_Type,
               CAST(1 + event_id % 100 AS DOUBLE) AS Amount, value AS Price, ts AS Txn_Time,
               CAST(ts AS DATE) AS p_date, event_id AS Txn_Id
        FROM {events}""",
    # Half of the entries once more, as those of one holding on one day, buys and sells in equal measure.
    "hovering_ledger": """
        SELECT Analyst, Ticker, Txn_Type, Amount, Price, Txn_Time, p_date, Txn_Id FROM {ledger_raw}
        UNION ALL
        SELECT CAST(99 AS BIGINT), 'HOT', CASE WHEN (Txn_Id * 7919) % 101 < 50 THEN 'BUY' ELSE 'SELL' END, Amount, Price,
               Txn_Time + Txn_Id * INTERVAL '1' DAY, DATE '2024-01-15', Txn_Id
        FROM {ledger_raw} WHERE Txn_Id % 2 = 0""",
    "holdings": """
        SELECT Analyst, Ticker, p_date, SUM(CASE WHEN Txn_Type = 'BUY' THEN Amount ELSE 0 END) AS Amount,
               MAX(Price) AS Avg_Price
        FROM {ledger_raw} GROUP BY Analyst, Ticker, p_date""",
    "employees": """
        SELECT c_custkey AS Employee_Id, c_mktsegment AS First_Name, c_name AS Last_Name,
               lower(c_name) || '@example.com' AS Email
        FROM {customer}""",
    # prices; no rows on weekends
    "stock_prices": f"""
        SELECT Stock_Code, p_date, MAX(price) AS Close
        FROM (SELECT 'T' || CAST(l_suppkey % 20 AS STRING) AS Stock_Code, l_extendedprice AS price,
                     {_DAY.format("(year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate)) % 30")} AS p_date
              FROM {{lineitem}}) AS sold
        WHERE isodow(p_date) <= 5
        GROUP BY Stock_Code, p_date""",
    "primary_prices": f"""
        SELECT {_DAY.format("p_partkey % 30")} AS p_date, 'S' || CAST(p_partkey AS STRING) AS Stock_Code,
               p_name AS Stock_Name, p_brand AS Currency, p_retailprice AS Last, p_retailprice * 0.98 AS Open,
               p_retailprice * 1.05 AS High, p_retailprice * 0.95 AS Low, CAST(p_size % 7 AS BIGINT) AS Volume
        FROM {{part}}
        UNION ALL
        SELECT DATE '2024-01-03', 'S0', 'Without a rate', 'Brand#99', 1.0, 1.0, 1.0, 1.0, CAST(1 AS BIGINT)
        FROM {{region}} WHERE r_regionkey = 0""",
    "backup_prices": f"""
        SELECT {_DAY.format("(2 * p_partkey) % 30")} AS p_date, 'S' || CAST(2 * p_partkey AS STRING) AS Ticker,
               p_retailprice * 0.97 AS Open, p_retailprice * 1.01 AS Close, p_retailprice * 1.06 AS High,
               p_retailprice * 0.94 AS Low, CAST(p_size AS BIGINT) AS Volume
        FROM {{part}}""",
    "exchange_rates": """
        SELECT DISTINCT p_date, Currency,
               CAST(500 + 50 * CAST(replace(Currency, 'Brand#', '') AS INT) + day(p_date) AS DOUBLE) / 1000 AS Rate
        FROM {primary_prices} WHERE Currency <> 'Brand#99'""",
    "holidays": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS holiday FROM {orders}
        WHERE (month(o_orderdate) = 1 AND day(o_orderdate) = 1) OR (month(o_orderdate) = 8 AND day(o_orderdate) = 9)
           OR (month(o_orderdate) = 12 AND day(o_orderdate) = 25)""",
    # Three countries keep some of them each, a fourth keeps none; some lines stand twice.
    "country_holidays": """
        SELECT 'C' || CAST(n.n_nationkey AS STRING) AS country, h.holiday
        FROM {holidays} h JOIN {nation} n ON n.n_nationkey < 3 AND (month(h.holiday) + n.n_nationkey) % 3 <> 0
        UNION ALL
        SELECT 'C1', holiday FROM {holidays} WHERE month(holiday) = 12""",
    # financial statistics
    "wide_part": "SELECT p_partkey, p_size FROM {part}",
    "financials_raw": f"""
        SELECT {_DAY.format("(2 * p_partkey) % 30")} AS p_date,
               'S' || CAST(2 * p_partkey AS STRING) || '.SI' AS Ticker,
               {", ".join(_raw_statistic(i, n, k) for i, (n, k) in enumerate(FINANCIALS))}
        FROM (SELECT p_partkey, {", ".join(
            f"(p_partkey * {17 + i} + p_size * 13 + {i * 101}) % 9973 AS n{i}" for i in range(len(FINANCIALS))
        )} FROM {{wide_part}}) AS numbered""",
    "statistics_pages": """
        SELECT Ticker, '<html><body><table>' || {} || '</table><p>end</p></body></html>' AS html
        FROM {{financials_raw}}""".format(
        " || ".join(
            f"coalesce('<tr><td>{label}</td><td class=\"v\">' || CAST({name} AS STRING) || '</td></tr>', '')"
            for label, name in PAGE_LABELS.items()
        )
    ),
    "messy": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CAST(l_linenumber AS STRING) || ',' || lpad(CAST(l_orderkey % 1000 AS STRING), 3, '0') || '.'
                   || CAST(CAST(round(l_discount * 100) AS BIGINT) AS STRING) || '%' AS percent_text,
               CASE WHEN l_linenumber = 7 THEN NULL
                    ELSE CAST(l_partkey AS STRING) || '.' || CAST(l_linenumber AS STRING)
                         || CASE l_returnflag WHEN 'A' THEN 'k' WHEN 'N' THEN 'M' WHEN 'R' THEN 'B' ELSE '' END
               END AS magnitude_text,
               CASE l_linestatus WHEN 'O' THEN CAST(l_linenumber AS STRING) || ':' || CAST(1 + l_partkey % 9 AS STRING)
                    ELSE CAST(l_linenumber AS STRING) END AS ratio_text
        FROM {lineitem}""",
    # posts, news and forum
    "social": f"""
        SELECT doc_id AS seq, {_DAY.format("n_chars % 30")} AS p_date, source AS ticker, lang AS source,
               text AS content
        FROM {{documents}}""",
    "news": f"""
        SELECT doc_id AS seq, {_DAY.format("n_chars % 30")} AS p_date, source AS ticker,
               text AS title, lang AS source, text AS description
        FROM {{documents}}""",
    "forum": f"""
        SELECT conv_id * 1000 + turn AS seq, role AS source, text AS title,
               {_DAY.format("conv_id % 7")} AS p_date
        FROM {{conversations}}""",
    "master": f"""
        SELECT DISTINCT 'src' || CAST(c_custkey % 19 AS STRING) AS stock_code,
               'Company ' || CAST(c_custkey % 19 AS STRING) AS company_name, {_DAY.format("c_custkey % 30")} AS p_date
        FROM {{customer}}""",
    "searched": """
        SELECT doc_id, keyword, text AS content
        FROM {documents} JOIN {keywords} ON CAST(replace(source, 'src', '') AS INT) = n""",
    "keywords": "SELECT * FROM (VALUES {}) AS k(n, keyword, code)".format(
        ", ".join(f"({i}, '{k}', '{c}')" for i, (k, c) in enumerate(TICKER_OF_KEYWORD.items()))
    ),
    "lexicon": "SELECT * FROM (VALUES {}) AS w(token, weight)".format(
        ", ".join(f"('{t}', {round(v * 1000)})" for t, v in LEXICON.items())
    ),
    "scores": """
        SELECT event_id, CAST(event_id % 201 - 100 AS DOUBLE) / 100 AS score FROM {events}""",
    "two_means": """
        SELECT user_id, CAST(ts AS DATE) AS p_date,
               SUM(CASE WHEN event_type IN ('view', 'signup', 'error') THEN event_id % 1000 END) AS first_sum,
               COUNT(CASE WHEN event_type IN ('view', 'signup', 'error') THEN 1 END) AS first_n,
               SUM(CASE WHEN event_type NOT IN ('view', 'signup', 'error') THEN -(event_id % 700) END) AS second_sum,
               COUNT(CASE WHEN event_type NOT IN ('view', 'signup', 'error') THEN 1 END) AS second_n
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
}

# Few bytes a row, of which other views make pages of kilobytes: dealt out, as one small file would be one task.
DEALT = {"wide_part"}

_HOLE = re.compile(r"\{(\w+)\}")


def needs(name: str) -> list[str]:
    """Tables and views a view reads."""
    return list(dict.fromkeys(_HOLE.findall(VIEWS[name])))


class Tables:
    """Test tables and views of one scale folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in BASE_TABLES:
                rows = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                text = VIEWS[name].replace("isodow(", "1 + weekday(")
                rows = self.spark.sql(text, **{n: self[n] for n in needs(name)})
            if name in DEALT:
                rows = rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            self._known[name] = rows
        return self._known[name]


def with_views(select: str, *names: str) -> str:
    """``select`` preceded by the views it reads, for the checking database."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in BASE_TABLES and name not in ordered:
            for other in needs(name):
                visit(other)
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({VIEWS[n].format(**{m: m for m in needs(n)})})" for n in ordered]
    text = select.strip()
    recursive = text.upper().startswith("WITH RECURSIVE")
    if text.upper().startswith("WITH"):
        text = text[len("WITH RECURSIVE" if recursive else "WITH") :].strip()
        return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([*parts, text])
    return "WITH " + ",\n".join(parts) + "\n" + text
