"""Business days of several countries by arithmetic, against a day-by-day count by numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymart.operators import calendar

BASE = dt.date(2022, 4, 1)


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(3)
    some = lambda first, years, n: [dt.date(first, 1, 1) + dt.timedelta(days=draw.randrange(365 * years)) for _ in range(n)]
    # The second has years without holidays between, the third has holidays on weekends only.
    return {"SG": some(2015, 12, 90), "US": [*some(2010, 1, 9), *some(2024, 1, 9)], "XX": [dt.date(2022, 1, 1), dt.date(2022, 5, 1)]}


def test_counts_against_numpy(rows, planted):
    holidays = rows("country string, holiday date", *[(c, d) for c, days in planted.items() for d in days + days[:2]], (None, BASE), ("SG", None))
    days = [dt.date(1960, 1, 1) + dt.timedelta(days=k) for k in range(0, 29_000, 11)] + [BASE, BASE - dt.timedelta(days=1)]
    days += [d for listed in planted.values() for d in listed]
    given = rows("country string, day date", *[(c, d) for c in [*planted, "unknown", None] for d in days])
    result = calendar.trading_day_numbers(given, "day", "country", holidays, baseline=BASE)
    assert "Window" not in result._jdf.queryExecution().optimizedPlan().toString()
    got = result.collect()
    assert len(got) == 5 * len(days)
    for r in got:
        off = np.array(planted.get(r["country"], []), dtype="datetime64[D]")
        want = int(np.busday_count(BASE, r["day"] + dt.timedelta(days=1), holidays=off)) if r["day"] >= BASE else -int(
            np.busday_count(r["day"] + dt.timedelta(days=1), BASE, holidays=off)
        )
        assert (r["day_count"], r["file_number"]) == (want, calendar.BASELINE_NUMBER + want - 1), r
        assert r["is_trading_day"] == bool(np.is_busday(r["day"], holidays=off)), r


def test_missing_days_and_empty_tables(rows):
    none = rows("country string, holiday date")
    got = calendar.trading_day_numbers(rows("country string, day date", ("SG", None), ("SG", BASE)), "day", "country", none, baseline=BASE)
    assert {(r["day"], r["is_trading_day"], r["day_count"]) for r in got.collect()} == {(None, None, None), (BASE, True, 1)}
    assert calendar.trading_day_numbers(rows("country string, day date"), "day", "country", none).count() == 0


def test_same_as_the_calendar_table(rows):
    off = rows("country string, holiday date", ("SG", dt.date(2022, 4, 15)), ("SG", dt.date(2022, 3, 14)))
    days = rows("day date", *[(dt.date(2022, 3, 1) + dt.timedelta(days=k),) for k in range(70)])
    table = calendar.trading_calendar(days, "day", off)
    numbers = calendar.trading_day_numbers(days.withColumn("country", F.lit("SG")), "day", "country", off).drop("country")
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, numbers.select(table.columns).collect()))
