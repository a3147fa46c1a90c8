import datetime as dt

from daymart.schemas import schema_of
from daymart.sources import landed_files


def test_bad_lines_beside_good_ones(spark, tmp_path):
    lines = ["2022-04-04;D05 ;1.5", "2022-04-04;;", "2022-04-05;U11;2;", "2022-04-06;U11", "2022-04-06;U11;1;2", "x;U11;1", "2022-04-07;U11;-", "", "  ", '2022-04-08;"a;b";3', "2022-04-09;"]
    (tmp_path / "prices.txt").write_text("\n".join(lines) + "\n")
    schema = schema_of("day DATE, code STRING, price DOUBLE")
    got = landed_files.read_delimited_tolerant(spark, str(tmp_path), schema).collect()
    good = [tuple(r)[:3] for r in got if r["reason"] is None]
    assert good == [
        (dt.date(2022, 4, 4), "D05", 1.5), (dt.date(2022, 4, 4), None, None), (dt.date(2022, 4, 5), "U11", 2.0), (dt.date(2022, 4, 8), "a;b", 3.0),
    ]
    assert all(r["bad_line"] is None for r in got if r["reason"] is None)
    bad = {r["bad_line"]: r["reason"] for r in got if r["reason"] is not None}
    assert bad == {lines[3]: "fields", lines[4]: "fields", lines[5]: "day", lines[6]: "price", lines[10]: "fields"}
    assert all(r["day"] is None and r["code"] is None for r in got if r["reason"] is not None)


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert landed_files.read_delimited_tolerant(spark, str(tmp_path), schema_of("value BIGINT, b STRING")).count() == 0
