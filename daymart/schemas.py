"""Column names, types and required fields of every warehouse table.

``NOT NULL`` marks a required field.  Spark does not enforce it when reading files, so
``sinks.load.enforce`` checks it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types users of the warehouse already query by.
_TABLES = {
    "primary_prices": """
        Trade_Date DATE NOT NULL, Stock_Name STRING NOT NULL, Remarks STRING, Currency STRING NOT NULL,
        High DOUBLE NOT NULL, Low DOUBLE NOT NULL, Last DOUBLE NOT NULL, Change DOUBLE NOT NULL,
        Volume BIGINT NOT NULL, Bid DOUBLE NOT NULL, Offer DOUBLE NOT NULL, Market STRING NOT NULL,
        Open DOUBLE NOT NULL, Value BIGINT NOT NULL, Stock_Code STRING NOT NULL, DClose DOUBLE NOT NULL,
        p_date DATE NOT NULL""",
    "backup_prices": """
        p_date DATE NOT NULL, Ticker STRING NOT NULL, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE,
        Adj_Close DOUBLE, Volume BIGINT""",
    "exchange_rates": "Currency STRING NOT NULL, Rate DOUBLE NOT NULL, p_date DATE NOT NULL",
    "stock_prices": """
        p_date DATE, Stock_Code STRING, Stock_Name STRING, Open DOUBLE, Close DOUBLE, High DOUBLE, Low DOUBLE,
        Volume BIGINT""",
    "ledger_raw": """
        p_date DATE NOT NULL, Analyst BIGINT NOT NULL, Txn_Type STRING NOT NULL, Ticker STRING NOT NULL,
        Price DOUBLE NOT NULL, Amount DOUBLE NOT NULL, Txn_Time TIMESTAMP_NTZ NOT NULL""",
    "ledger": """
        Analyst BIGINT, Ticker STRING, Price DOUBLE, Txn_Type STRING, Amount DOUBLE, p_date DATE,
        Txn_Time TIMESTAMP_NTZ""",
    "portfolio_snapshot": """
        Analyst BIGINT, Ticker STRING, Amount DOUBLE, Daily_Amount_Change DOUBLE, Realised_Gain DOUBLE,
        Unrealised_Gain DOUBLE, p_date DATE, Avg_Price DOUBLE""",
    "employees": "Employee_Id BIGINT, First_Name STRING, Last_Name STRING, Email STRING",
    "stock_list": """
        issue STRING, year BIGINT, company_name STRING, rank BIGINT, adjustment BIGINT, base_score DOUBLE,
        total_score DOUBLE, stock_code STRING NOT NULL, isin_code STRING, p_date DATE NOT NULL""",
    "intraday_chart": """
        cur STRING, pv DOUBLE, bond_dirty_price STRING, lt DOUBLE, trading_time STRING, type STRING,
        dp STRING, du STRING, dpc STRING, ig STRING, bond_clean_price STRING, ed STRING,
        change_vs_pc_percentage STRING, ptd STRING, h DOUBLE, l DOUBLE, n STRING, o DOUBLE,
        change_vs_pc STRING, bond_accrued_interest STRING, nc STRING, v DOUBLE, vl DOUBLE, lf STRING,
        bond_date STRING, p_date DATE""",
    "social_posts": "p_date DATE NOT NULL, ticker STRING NOT NULL, source STRING NOT NULL, content STRING NOT NULL",
    "social_scored": """
        p_date DATE NOT NULL, ticker STRING NOT NULL, source STRING NOT NULL, content STRING NOT NULL,
        NLTK_score DOUBLE NOT NULL, NLTK_sentiment STRING NOT NULL""",
    "news_items": """
        p_date DATE NOT NULL, ticker STRING NOT NULL, title STRING NOT NULL, source STRING NOT NULL,
        description STRING NOT NULL, url STRING NOT NULL""",
    "news_scored": """
        p_date DATE NOT NULL, ticker STRING NOT NULL, title STRING NOT NULL, source STRING NOT NULL,
        description STRING NOT NULL, url STRING NOT NULL, NLTK_score DOUBLE NOT NULL,
        NLTK_sentiment STRING NOT NULL""",
    "forum_posts": "source STRING NOT NULL, title STRING NOT NULL, p_date DATE NOT NULL",
    "forum_scored": """
        source STRING NOT NULL, title STRING NOT NULL, p_date DATE NOT NULL,
        NLTK_SIA_compound_score DOUBLE NOT NULL, NLTK_sentiment STRING NOT NULL""",
    "sentiment_daily": """
        p_date DATE, ticker STRING, avg_twitter_score_ticker DOUBLE, avg_news_score_ticker DOUBLE,
        combined_sentiment_score_ticker DOUBLE, benchmark_score_for_today_market DOUBLE, company_name STRING,
        overall_sentiment_for_ticker STRING""",
}

# The financial statistics in load order.  The second word says how the
# raw column turns into a number: number (already one), text_number (a cast), magnitude
# ('1.5B'), percent ('12%'), ratio ('3:2'), dropped (a date that is not kept).
_FINANCIALS = """
    Market_cap__intra_day_ magnitude
    Enterprise_value magnitude
    Trailing_PE number
    Forward_PE number
    PEG_Ratio__5_yr_expected_ number
    Pricesales__ttm_ number
    Pricebook__mrq_ number
    Enterprise_valuerevenue number
    Enterprise_valueEBITDA number
    Beta__5Y_monthly_ number
    _52_week_change_3 percent
    SnP_500__52_week_change_3 percent
    _52_week_high_3 number
    _52_week_low_3 number
    _50_day_moving_average_3 number
    _200_day_moving_average_3 number
    Avg_vol__3_month__3 magnitude
    Avg_vol__10_day__3 magnitude
    Shares_outstanding_5 magnitude
    Implied_shares_outstanding_6 magnitude
    Float_8 magnitude
    percent_held_by_insiders_1 percent
    percent_held_by_institutions_1 percent
    Shares_short_4 magnitude
    Short_ratio_4 number_ratio
    Short_percent_of_float_4 percent
    Short_percent_of_shares_outstanding_4 percent
    Shares_short__prior_month___4 magnitude
    Forward_annual_dividend_rate_4 number
    Forward_annual_dividend_yield_4 percent
    Trailing_annual_dividend_rate_3 number
    Trailing_annual_dividend_yield_3 percent
    _5_year_average_dividend_yield_4 number
    Payout_ratio_4 percent
    Dividend_date_3 dropped
    Ex_dividend_date_4 dropped
    Last_split_factor_2 ratio
    Last_split_date_3 dropped
    Fiscal_year_ends dropped
    Most_recent_quarter__mrq_ dropped
    Profit_margin percent
    Operating_margin__ttm_ percent
    Return_on_assets__ttm_ percent
    Return_on_equity__ttm_ percent
    Revenue__ttm_ magnitude
    Revenue_per_share__ttm_ number
    Quarterly_revenue_growth__yoy_ percent
    Gross_profit__ttm_ magnitude
    EBITDA magnitude
    Net_income_avi_to_common__ttm_ magnitude
    Diluted_EPS__ttm_ number
    Quarterly_earnings_growth__yoy_ percent
    Total_cash__mrq_ magnitude
    Total_cash_per_share__mrq_ text_number
    Total_debt__mrq_ magnitude
    Total_debtequity__mrq_ number
    Current_ratio__mrq_ number
    Book_value_per_share__mrq_ number
    Operating_cash_flow__ttm_ magnitude
    Levered_free_cash_flow__ttm_ magnitude
"""
FINANCIALS: list[tuple[str, str]] = [tuple(line.split()) for line in _FINANCIALS.split("\n") if line.strip()]
FINANCIAL_MEASURES: list[str] = [name for name, kind in FINANCIALS if kind != "dropped"]


_TYPES = {
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def schema_of(text: str) -> T.StructType:
    """``"a BIGINT NOT NULL, b STRING"`` as a schema; needs no running session."""
    fields = []
    for column in text.split(","):
        name, kind, *required = column.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=not required))
    return T.StructType(fields)


def _financials(kept: list[str], kinds: dict[str, str]) -> T.StructType:
    columns = [f"{name} {kinds.get(name, 'DOUBLE')}" for name in kept]
    return schema_of(", ".join(["p_date DATE NOT NULL", "Ticker STRING NOT NULL", *columns]))


def table_schema(name: str) -> T.StructType:
    if name == "financials_raw":
        texts = {c: "STRING" for c, kind in FINANCIALS if not kind.startswith("number")}
        return _financials([c for c, _ in FINANCIALS], texts)
    if name == "financials":
        return _financials(FINANCIAL_MEASURES, {})
    return schema_of(_TABLES[name])


TABLE_NAMES = [*_TABLES, "financials_raw", "financials"]
