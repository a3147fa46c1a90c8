import datetime as dt
import json

import pytest

from daymart.plans import feeds
from daymart.schemas import table_schema

DAY, SUNDAY = dt.date(2022, 4, 4), dt.date(2022, 4, 3)


@pytest.fixture
def holidays(rows):
    return rows("holiday date", (dt.date(2022, 4, 15),))


def test_backup_prices(rows, holidays):
    names = [f"{t}|{f}" for t in ("D05.SI", "U11.SI") for f in feeds.VENDOR_FIELDS]
    wide = rows(", ".join(f"`{n}` double" for n in names), (1.0, 2.0, 0.5, 1.5, 1.4, 100.0, *[None] * 6))
    got = feeds.backup_prices(wide, ["D05.SI", "U11.SI"], DAY, holidays)
    assert got.schema.names == table_schema("backup_prices").names
    assert [tuple(r) for r in got.collect()] == [(DAY, "D05", 1.0, 2.0, 0.5, 1.5, 1.4, 100)]
    weekend = feeds.backup_prices(wide, ["D05.SI", "U11.SI"], SUNDAY, holidays)
    assert weekend.count() == 0 and weekend.schema == got.schema


def test_exchange_rates(rows):
    payloads = rows("c string, body string", ("USD", '{"rates": {"2022-04-04": {"SGD": 1.36}}}'))
    assert [tuple(r) for r in feeds.exchange_rates(payloads, "c", "body", DAY).collect()] == [("USD", 1.36, DAY)]
    with pytest.raises(Exception, match="required field Rate is missing"):
        feeds.exchange_rates(payloads, "c", "body", SUNDAY).collect()


def test_stock_list(rows):
    fields = ["issue", "yr", "name", "rk", "adj", "base", "total", "code", "isin"]
    page = {"data": [dict(zip(fields, ["i", 2022, "DBS", 1, 0, 90.5, 91, "D05", None]))]}
    got = feeds.stock_list(rows("body string", (json.dumps(page),)), "body", fields, DAY).collect()
    assert [tuple(r) for r in got] == [("i", 2022, "DBS", 1, 0, 90.5, 91.0, "D05", None, DAY)]


def test_intraday_chart(rows):
    body = {"data": {"intraday": [{"lt": 1.5, "nc": "D05", "trading_time": "090000"}, {"lt": 1.6}]}}
    got = feeds.intraday_chart(rows("body string", (json.dumps(body),)), "body", DAY).collect()
    assert [(r.lt, r.nc, r.p_date) for r in got] == [(1.5, "D05", DAY), (1.6, None, DAY)]


def test_forum_posts(rows):
    posts = rows("sub string, t string, s bigint", ("SGX", "hello", 1649030399), ("SGX", "later", 1649030400))
    got = feeds.forum_posts(posts, "sub", "t", "s").collect()
    assert [tuple(r) for r in got] == [("Reddit: SGX", "hello", SUNDAY), ("Reddit: SGX", "later", DAY)]
