"""Trading days: weekdays that are not in the holiday table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The day and number from which the exchange's daily files are counted.
BASELINE_DAY = dt.date(2022, 4, 1)
BASELINE_NUMBER = 6188


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def trading_days_only(rows: DataFrame, day: str, holidays: DataFrame, holiday: str = "holiday") -> DataFrame:
    """Rows that fall on trading days; on any other day the result is empty but typed."""
    off = holidays.select(F.col(holiday).alias(day)).distinct()
    return rows.where(is_weekday(F.col(day))).join(off, day, "left_anti")


def trading_calendar(
    days: DataFrame,
    day: str,
    holidays: DataFrame,
    holiday: str = "holiday",
    baseline: dt.date = BASELINE_DAY,
    number: int = BASELINE_NUMBER,
) -> DataFrame:
    """``day, is_trading_day, day_count, file_number`` for every calendar day from the
    earlier to the later of ``days`` and ``baseline``.

    ``day_count`` counts trading days from the baseline up to and including the day, and is
    negative before it.  The table has one row per calendar day, whatever the size of ``days``.
    """
    base = F.lit(baseline)
    span = days.agg(F.least(F.min(day), base).alias("lo"), F.greatest(F.max(day), base).alias("hi"))
    every = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    off = holidays.select(F.col(holiday).alias("day")).distinct().withColumn("_off", F.lit(True))
    marked = every.join(off, "day", "left").withColumn(
        "is_trading_day", is_weekday(F.col("day")) & F.col("_off").isNull()
    )
    one = F.col("is_trading_day").cast("long")
    upto = Window.orderBy("day")
    total = marked.withColumns(
        {"_upto": F.sum(one).over(upto), "_base": F.sum(F.when(F.col("day") < base, one).otherwise(0)).over(
            Window.partitionBy())}
    )
    return total.select(
        "day",
        "is_trading_day",
        (F.col("_upto") - F.col("_base")).alias("day_count"),
        (F.lit(number) + F.col("_upto") - F.col("_base") - 1).alias("file_number"),
    )


# ---- several calendars, by arithmetic ---------------------------------------------------


def weekdays_through(day: Column) -> Column:
    """Mondays to Fridays from Monday, 29 December 1969 up to and including ``day``; negative before."""
    days = F.unix_date(day) + 3
    return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)) + 1, F.lit(5))


def holiday_index(holidays: DataFrame, country: str = "country", holiday: str = "holiday") -> DataFrame:
    """``country, calendar``, one row per country: its holidays on weekdays by year, and how many come before each year.

    Repeated holidays count once, rows without a country or a day not at all.  The rows grow with the years, not with the data.
    """
    listed = holidays.select(F.col(country).alias("country"), F.col(holiday).alias("day")).where(
        F.col("country").isNotNull() & is_weekday(F.col("day"))
    )
    days = F.array_sort("days")
    first, last = F.year(F.array_min("days")), F.year(F.array_max("days"))
    years = F.sequence(first, last)
    return (
        listed.groupBy("country")
        .agg(F.collect_set("day").alias("days"))
        .select("country", days.alias("days"))
        .select(
            "country",
            F.struct(
                first.alias("first"),
                F.transform(years, lambda y: F.size(F.filter("days", lambda d: F.year(d) < y))).alias("before"),
                F.transform(years, lambda y: F.filter("days", lambda d: F.year(d) == y)).alias("days"),
                F.size("days").alias("total"),
            ).alias("calendar"),
        )
    )


def trading_days_through(day: Column, calendar: Column) -> Column:
    """Trading days from the day ``weekdays_through`` counts from; differences of two such counts are what has a meaning.

    A country without a calendar has no holidays.
    """
    at = F.year(day) - calendar["first"]
    in_year = F.get(calendar["days"], at)
    off = (
        F.when(at < 0, F.lit(0))
        .when(at >= F.size(calendar["days"]), calendar["total"])
        .otherwise(F.get(calendar["before"], at) + F.size(F.filter(in_year, lambda d: d <= day)))
    )
    return weekdays_through(day) - F.when(calendar.isNull() | day.isNull(), F.lit(0)).otherwise(off)


def trading_day_numbers(
    rows: DataFrame,
    day: str,
    country: str,
    holidays: DataFrame,
    baseline: dt.date = BASELINE_DAY,
    number: int = BASELINE_NUMBER,
    holiday: str = "holiday",
    holiday_country: str = "country",
) -> DataFrame:
    """``rows`` with ``is_trading_day, day_count, file_number`` by the calendar of each row's country.

    As ``trading_calendar`` counts them, but row by row: no calendar table, no window; one join with a row per country.  A missing day
    has no figures, a missing or unknown country has no holidays.
    """
    index = holiday_index(holidays, holiday_country, holiday).select(F.col("country").alias("_country"), F.col("calendar").alias("_calendar"))
    upto = trading_days_through(F.col(day), F.col("_calendar"))
    eve = trading_days_through(F.lit(baseline - dt.timedelta(days=1)), F.col("_calendar"))
    yesterday = trading_days_through(F.date_sub(F.col(day), 1), F.col("_calendar"))
    return (
        rows.join(index, rows[country] == index["_country"], "left")
        .withColumns({"is_trading_day": upto > yesterday, "day_count": (upto - eve).cast("long")})
        .withColumn("file_number", F.col("day_count") + F.lit(number) - 1)
        .drop("_country", "_calendar")
    )
