"""Committed versions of days, steps over several tables, and routed writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymart.plans import daily
from daymart.sinks import commits
from daymart.warehouse import MissingDay, Warehouse

DAY = dt.date(2022, 4, 4)
NEXT = DAY + dt.timedelta(days=1)
DDL = "Currency string, Rate double, p_date date"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def rates(warehouse, day=DAY):
    return sorted((r.Currency, r.Rate) for r in warehouse.read("exchange_rates", day).collect())


def test_a_replaced_day_is_seen_whole_or_not(warehouse, rows, spark):
    warehouse.write("exchange_rates", rows(DDL, ("USD", 1.0, DAY), ("EUR", 2.0, DAY)), DAY)
    other = Warehouse(spark, warehouse.root)
    before = other.read("exchange_rates", DAY)
    with pytest.raises(Exception, match="broken"):
        broken = rows(DDL, *[("USD", float(i), DAY) for i in range(40)]).repartition(8)
        warehouse.write("exchange_rates", broken.withColumn("Rate", F.when(F.col("Rate") == 39, F.raise_error(F.lit("broken"))).otherwise(F.col("Rate"))), DAY)
    assert rates(other) == [("EUR", 2.0), ("USD", 1.0)]
    warehouse.write("exchange_rates", rows(DDL, ("GBP", 3.0, DAY)), DAY)
    assert rates(other) == [("GBP", 3.0)] and warehouse.rows_written("exchange_rates", DAY) == 1
    assert before.count() == 2  # a reader that began before goes on with its version


def test_an_emptied_day_is_an_entry_of_the_same_write(warehouse, rows, spark):
    both = {"Currency": "USD", "Rate": 1.0}
    for day in (DAY, NEXT):
        warehouse.write("exchange_rates", rows(DDL, (*both.values(), day)), day)
    schema = warehouse.read("exchange_rates").schema
    changes = warehouse.commits.write(rows(DDL, ("EUR", 4.0, NEXT)), {"exchange_rates": schema}, [DAY, NEXT])
    assert rates(warehouse) == rates(warehouse, NEXT) == [("USD", 1.0)]  # written, not yet published
    warehouse.commits.publish(changes)
    assert rates(warehouse) == [] and rates(warehouse, NEXT) == [("EUR", 4.0)]
    assert changes["exchange_rates"]["days"][DAY.isoformat()] == {"v": None, "rows": 0}
    assert warehouse.has("exchange_rates", DAY) and warehouse.read("exchange_rates").count() == 1


def test_tables_of_a_step_appear_together(warehouse, rows, spark):
    other = Warehouse(spark, warehouse.root)
    with warehouse.step():
        warehouse.write("exchange_rates", rows(DDL, ("USD", 1.0, DAY)), DAY)
        assert rates(warehouse) == [("USD", 1.0)] and not other.has("exchange_rates", DAY)
        warehouse.write_mart("report", rows("n int, p_date date", (1, DAY)), DAY)
    assert other.has("exchange_rates", DAY) and other.read("report", DAY).collect() == [(1, DAY)]
    with pytest.raises(RuntimeError):
        with warehouse.step():
            warehouse.write("exchange_rates", rows(DDL), DAY)
            raise RuntimeError
    assert rates(other) == rates(warehouse) == [("USD", 1.0)]


def test_two_writers_and_a_whole_record(warehouse, rows, spark, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_EVERY", 3)
    other = Warehouse(spark, warehouse.root)
    for i, writer in enumerate([warehouse, other] * 3):
        writer.commits.publish({"t": {"schema": None, "days": {f"2022-04-{i + 1:02d}": {"v": None, "rows": i}}}})
    # A writer that believes a number free which is taken goes on to the next.
    late = Warehouse(spark, warehouse.root)
    late.commits._numbers = lambda real=late.commits._numbers, told=[]: real() if told or told.append(1) else real()[:-1]
    late.commits.publish({"t": {"schema": None, "days": {"2022-05-01": {"v": None, "rows": 9}}}})
    fresh = Warehouse(spark, warehouse.root)
    assert {d: e["rows"] for d, e in fresh.commits.state()["t"]["days"].items()} == {f"2022-04-{i + 1:02d}": i for i in range(6)} | {"2022-05-01": 9}


def test_days_written_without_versions_stay_readable(warehouse, rows):
    rows(DDL, ("USD", 1.0, DAY), ("USD", 2.0, NEXT)).write.partitionBy("p_date").parquet(warehouse.path("exchange_rates"))
    assert warehouse.has("exchange_rates", DAY) and rates(warehouse) == [("USD", 1.0)]
    warehouse.write("exchange_rates", rows(DDL, ("EUR", 5.0, DAY)), DAY)
    assert rates(warehouse) == [("EUR", 5.0)] and rates(warehouse, NEXT) == [("USD", 2.0)]
    assert sorted(r.Rate for r in warehouse.read("exchange_rates").collect()) == [2.0, 5.0]


def _scans(spark, work):
    """How many records the scans of ``work`` read, from the plans that ran."""
    read = spark.sparkContext.accumulator(0)
    work(lambda frame: frame.where(_counting(read)(F.lit(1)) == 1))
    return read.value


def _counting(read):
    @F.udf("int")
    def seen(one):
        read.add(1)
        return one

    return seen.asNondeterministic()


def test_routed_rows_come_from_one_pass(warehouse, rows, spark):
    at = dt.datetime(2022, 4, 4, 9)
    posts = [("DBS", "good!", at, 1), ("DBS", "good!", at, 2), ("Nobody", "x", at, 3), ("DBS", "late", at + dt.timedelta(days=1), 4), ("DBS", None, at, 5)]
    posts = rows("keyword string, content string, created timestamp_ntz, seq bigint", *posts)
    assert _scans(spark, lambda watched: daily.ingest_social(warehouse, watched(posts), DAY)) == 5
    assert [(r.content, r.ticker) for r in warehouse.read("social_posts", DAY).collect()] == [("good", "D05")]
    assert sorted((r.keyword, r.content) for r in warehouse.read("social_rejects", DAY).collect()) == [("DBS", None), ("Nobody", "x")]
    assert [(r.content, r.own_date) for r in warehouse.read("social_other_days", DAY).collect()] == [("late", NEXT)]
    for table, n in (("social_posts", 1), ("social_rejects", 2), ("social_other_days", 1)):
        assert warehouse.rows_written(table, DAY) == n == warehouse.read(table, DAY).count()


def test_unknown_routes_and_missing_values_fail_all_tables(warehouse, rows):
    tables = {"exchange_rates": None, "exchange_rates_rejects": ["payload"]}
    ddl = "Currency string, Rate double, payload string, route string"
    warehouse.write_routed(rows(ddl, ("USD", 1.0, "p", "exchange_rates"), (None, None, "q", "exchange_rates_rejects")), tables, DAY)
    for bad in (("EUR", None, "", "exchange_rates"), ("EUR", 1.0, "", "elsewhere"), ("EUR", 1.0, "", None)):
        with pytest.raises(Exception):  # noqa: B017
            warehouse.write_routed(rows(ddl, bad), tables, DAY)
    assert rates(warehouse) == [("USD", 1.0)] and [r.payload for r in warehouse.read("exchange_rates_rejects", DAY).collect()] == ["q"]
    with pytest.raises(MissingDay):
        warehouse.read("exchange_rates_rejects", NEXT)
