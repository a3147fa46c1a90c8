"""Days that are made again because something they were made from has changed."""

import datetime as dt

import pytest

from daymart.plans import daily
from daymart.schemas import table_schema
from daymart.warehouse import Warehouse

DAYS = [dt.date(2022, 4, 4) + dt.timedelta(days=i) for i in range(4)]
ENTRY = "Price double, Analyst bigint, Ticker string, Txn_Type string, Amount double, Txn_Time timestamp_ntz, p_date date"


def entry(day, amount, kind="BUY", hour=9, ticker="T1"):
    return (2.0, 1, ticker, kind, float(amount), dt.datetime.combine(day, dt.time(hour)), day)


@pytest.fixture
def warehouse(spark, rows, tmp_path):
    found = Warehouse(spark, str(tmp_path / "warehouse"))
    for day in DAYS:
        found.write("ledger_raw", rows(ENTRY, entry(day, 10), entry(day, 4, "SELL", 10)), day)
    return found


def steps(warehouse):
    return {
        "ledger": lambda ds: daily.run_ledger(warehouse, ds, DAYS[0]),
        "portfolio_snapshot": lambda ds: daily.run_portfolio(warehouse, ds, intent=True, first_day=DAYS[0]),
    }


def held(warehouse, day):
    return {r.Ticker: r.Amount for r in warehouse.read("portfolio_snapshot", day).collect()}


def test_a_change_reruns_later_days_and_no_earlier_ones(warehouse, rows):
    both = ("ledger", "portfolio_snapshot")
    assert daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse)) == [(t, d) for d in DAYS for t in both]
    assert warehouse.stale() == {} and daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse)) == []
    assert held(warehouse, DAYS[3]) == {"T1": 24.0}

    same = rows(ENTRY, entry(DAYS[1], 4, "SELL", 10), entry(DAYS[1], 10)).repartition(3)
    warehouse.write("ledger_raw", same, DAYS[1])  # another order and other files, the same rows
    assert warehouse.stale() == {}

    warehouse.write("ledger_raw", rows(ENTRY, entry(DAYS[2], 50)), DAYS[2])
    assert warehouse.stale() == {
        ("ledger", "2022-04-06"): True, ("portfolio_snapshot", "2022-04-06"): False,
        ("ledger", "2022-04-07"): False, ("portfolio_snapshot", "2022-04-07"): False,
    }
    done = daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse))
    assert done == [(t, d) for d in DAYS[2:] for t in both]
    assert held(warehouse, DAYS[3]) == {"T1": 68.0} and held(warehouse, DAYS[1]) == {"T1": 12.0}
    assert warehouse.stale() == {}


def test_a_change_without_effect_goes_no_further(warehouse, rows):
    daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse))
    rejected = entry(DAYS[1], 5, "SELL", 11, "T9")  # nothing is held of it
    warehouse.write("ledger_raw", rows(ENTRY, entry(DAYS[1], 10), entry(DAYS[1], 4, "SELL", 10), rejected), DAYS[1])
    assert daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse)) == [("ledger", DAYS[1])]
    assert warehouse.stale() == {}


def test_prices_of_the_last_days_count_and_later_ones_do_not(warehouse, rows):
    schema = table_schema("stock_prices")
    given = {"Stock_Code": "T1", "Close": 3.0, "p_date": DAYS[2]}
    price = rows(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields), tuple(given.get(n) for n in schema.names))

    daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse))
    warehouse.write("stock_prices", price, DAYS[2])
    done = daily.run_stale(warehouse, DAYS[0], DAYS[-1], steps(warehouse))
    assert [d for t, d in done if t == "portfolio_snapshot"] == DAYS[2:]

