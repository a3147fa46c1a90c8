import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymart.operators import ledger_fold
from daymart.operators.running import running_sums
from daymart.plans import daily, ledger, portfolio
from daymart.schemas import table_schema
from daymart.sinks import day_partitions, load
from daymart.warehouse import Warehouse

RAW = "p_date date, Analyst bigint, Txn_Type string, Ticker string, Price double, Amount double, Txn_Time timestamp_ntz, Txn_Id bigint"
SNAPSHOT = (
    "Analyst bigint, Ticker string, Amount double, Daily_Amount_Change double, Realised_Gain double, "
    "Unrealised_Gain double, p_date date, Avg_Price double"
)
PRICES = "Stock_Code string, p_date date, Close double"
DAY = dt.date(2024, 1, 15)


def at(minute, day=DAY):
    return dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=minute)


def fold(amounts):
    total, accepted = 0.0, []
    for amount in amounts:
        accepted.append(total + amount >= 0)
        if accepted[-1]:
            total += amount
    return accepted


def flags(rows, amounts, key="k", chunk_rows=10**6):
    frame = rows(
        "k string, t timestamp_ntz, n bigint, amount double",
        *[(key, at(i), i, float(a)) for i, a in enumerate(amounts)],
    ).repartition(3)
    marked = ledger_fold.accept_flags(frame, ["k"], ["t", "n"], "amount", "t", chunk_rows=chunk_rows)
    return [r.Is_Valid for r in sorted(marked.collect(), key=lambda r: r.n)]


def test_rejected_amounts_do_not_count(rows):
    assert flags(rows, [5, -9, 3, -8, -1]) == [True, False, True, True, False]


@pytest.mark.parametrize("drift", [0, 30, -30])
@pytest.mark.parametrize("chunk_rows", [12, 25])
def test_a_split_key_gives_the_sequential_result(rows, drift, chunk_rows):
    generator = random.Random(drift * 100 + chunk_rows)
    amounts = [generator.randint(-100, 100) + drift for _ in range(80)]
    assert flags(rows, amounts, chunk_rows=chunk_rows) == fold(amounts)


def test_a_split_key_with_fractions(rows):
    generator = random.Random(7)
    amounts = [round(generator.uniform(-1, 1), 2) for _ in range(40)]
    assert flags(rows, amounts, chunk_rows=9) == fold(amounts)


def _counted(monkeypatch):
    """How often maps are computed."""
    rounds, maps = [], ledger_fold._maps
    monkeypatch.setattr(ledger_fold, "_maps", lambda *a: rounds.append(1) or maps(*a))
    return rounds


@pytest.mark.parametrize("chunks", [16, 64])
def test_a_hovering_key_takes_one_round(rows, monkeypatch, chunks):
    generator = random.Random(chunks)
    amounts = [round(generator.uniform(-1, 1), 2) for _ in range(4 * chunks)]
    rounds = _counted(monkeypatch)
    assert flags(rows, amounts, chunk_rows=4) == fold(amounts)
    assert len(rounds) == 1


def test_shortened_maps_take_more_rounds_and_give_the_same(rows, monkeypatch):
    generator = random.Random(11)
    amounts = [generator.randint(-50, 50) for _ in range(300)]
    rounds = _counted(monkeypatch)
    frame = rows("k string, t timestamp_ntz, n bigint, amount double", *[("k", at(i), i, float(a)) for i, a in enumerate(amounts)])
    marked = ledger_fold.accept_flags(frame, ["k"], ["t", "n"], "amount", "t", chunk_rows=60, max_pieces=6).collect()
    assert [r.Is_Valid for r in sorted(marked, key=lambda r: r.n)] == fold(amounts)
    assert 1 < len(rounds) <= 6


def test_the_map_of_a_chunk_holds_for_every_opening(rows):
    """Breakpoints against runs from every opening, whole and shortened ones."""
    generator = random.Random(4)
    for pieces in (4096, 8):
        amounts = [generator.randint(-20, 18) for _ in range(60)]
        frame = rows(
            "k string, _chunk bigint, n bigint, amount double, _start double", *[("k", 0, i, float(a), 7.0) for i, a in enumerate(amounts)]
        )
        (found,) = ledger_fold._maps(frame, ["k"], ["n"], "amount", pieces).collect()
        known = 0
        for opening in range(0, 700):
            total = float(opening)
            for amount in amounts:
                total = total + amount if total + amount >= 0 else total
            place = max(i for i, low in enumerate(found["_low"]) if low <= opening)
            shift = found["_shift"][place]
            assert shift != shift or opening + shift == total
            known += shift == shift
        assert len(found["_low"]) <= pieces + 2 and known >= (700 if pieces > 8 else 1)
        at_guess = max(i for i, low in enumerate(found["_low"]) if low <= 7.0)
        assert found["_shift"][at_guess] == found["_shift"][at_guess]


def test_no_stream_is_longer_than_a_chunk(rows):
    """The rows of a large key reach the fold under as many parts as there are chunks."""
    generator = random.Random(12)
    frame = rows(
        "k string, t timestamp_ntz, n bigint, amount double", *[("k", at(i), i, float(generator.randint(-9, 9))) for i in range(200)]
    )
    hot = ledger_fold._chunked(frame, ["k"], ["t", "n"], "t", 25, "second")
    sizes = [r["count"] for r in hot.groupBy("k", "_chunk").count().collect()]
    assert sorted(sizes) == [25] * 8
    openings = ledger_fold._settle(hot, ["k"], ["t", "n"], "amount", 4096).collect()
    assert sorted(r["_chunk"] for r in openings) == list(range(8))


def test_one_second_is_cut_as_well(rows):
    generator = random.Random(9)
    amounts = [generator.randint(-9, 10) for _ in range(60)]
    frame = rows("k string, t timestamp_ntz, n bigint, amount double", *[("k", at(0), i, float(a)) for i, a in enumerate(amounts)])
    marked = ledger_fold.accept_flags(frame, ["k"], ["t", "n"], "amount", "t", chunk_rows=7).collect()
    assert [r.Is_Valid for r in sorted(marked, key=lambda r: r.n)] == fold(amounts)


def test_running_sums_are_the_same_to_the_last_bit(rows):
    generator = random.Random(2)
    data = [("k", at(generator.randint(0, 9000)), generator.uniform(-100, 100)) for _ in range(400)]
    frame = rows("k string, t timestamp_ntz, v double", *data)
    first, *others = (
        sorted((r.t, r.s) for r in running_sums(frame, ["k"], "t", {"s": F.col("v")}, b).collect()) for b in (None, "second", "hour")
    )
    assert all(other == first for other in others)


def test_hot_and_ordinary_keys_together(rows):
    generator = random.Random(3)
    data = {"hot": 200, "a": 3, "b": 17, "c": 1}
    series = {k: [float(generator.randint(-50, 50)) for _ in range(n)] for k, n in data.items()}
    frame = rows(
        "k string, t timestamp_ntz, n bigint, amount double",
        *[(k, at(i), i, a) for k, s in series.items() for i, a in enumerate(s)],
    )
    marked = ledger_fold.accept_flags(frame, ["k"], ["t", "n"], "amount", "t", chunk_rows=20).collect()
    assert len(marked) == sum(data.values())
    for k, amounts in series.items():
        got = [r.Is_Valid for r in sorted((r for r in marked if r.k == k), key=lambda r: r.n)]
        assert got == fold(amounts)


def test_opening_balance_comes_first_and_is_not_emitted(rows):
    raw = rows(
        RAW,
        (DAY, 1, "SELL", "T", 1.0, 4.0, at(1), 1),
        (DAY, 1, "SELL", "T", 1.0, 7.0, at(2), 2),
        (DAY, 1, "BUY", "T", 1.0, 1.0, at(3), 3),
    )
    snapshot = rows(SNAPSHOT, (1, "T", 10.0, 0.0, 0.0, 0.0, DAY - dt.timedelta(days=1), 2.0))
    got = ledger.validated_ledger(raw, snapshot, DAY).collect()
    assert sorted((r.Txn_Type, r.Amount) for r in got) == [("BUY", 1.0), ("SELL", -4.0)]
    every_day = ledger.validated_ledger(raw, snapshot).collect()
    assert sorted(every_day) == sorted(got)


@pytest.mark.parametrize("bucket", [None, "second", "minute", "hour"])
def test_running_sums_share_ties_and_cross_buckets(rows, bucket):
    frame = rows(
        "k string, t timestamp_ntz, v double",
        ("a", at(1), 5.0), ("a", at(2), -9.0), ("a", at(3), -2.0), ("a", at(3), 4.0), ("a", at(200), 1.0),
        ("a", at(900), None), ("b", at(5), None), ("b", at(70), 2.0),
    )
    got = running_sums(frame, ["k"], "t", {"s": F.col("v")}, bucket).collect()
    assert sorted(((r.k, r.t, r.s) for r in got), key=repr) == sorted(
        [
            ("a", at(1), 5.0), ("a", at(2), -4.0), ("a", at(3), -2.0), ("a", at(3), -2.0), ("a", at(200), -1.0),
            ("a", at(900), -1.0), ("b", at(5), None), ("b", at(70), 2.0),
        ],
        key=repr,
    )


def _validated(rows):
    return rows(
        "Analyst bigint, Ticker string, Price double, Txn_Type string, Amount double, p_date date, Txn_Time timestamp_ntz",
        (1, "T", 2.0, "BUY", 10.0, DAY, at(1)),
        (1, "T", 3.0, "SELL", -4.0, DAY, at(2)),
    )


@pytest.mark.parametrize("bucket", [None, "second"])
def test_published_figures_keep_their_oddities(rows, spark, bucket):
    prices = rows(PRICES, *[("T", DAY - dt.timedelta(days=n), c) for n, c in ((8, 9.0), (7, 1.0), (1, 2.0), (0, 4.0))])
    empty = spark.createDataFrame([], SNAPSHOT)
    got = portfolio.portfolio_snapshot(_validated(rows), empty, prices, DAY, bucket).collect()
    assert len(got) == 3  # one per close of the last eight days
    assert {r.Amount for r in got} == {14.0}  # the sell was added
    assert {r.Daily_Amount_Change for r in got} == {0.0}
    assert {r.Avg_Price for r in got} == {14.0 / 32.0}
    assert {r.Realised_Gain for r in got} == {-4.0 * (3.0 - 32.0 / 14.0)}
    assert sorted(r.Unrealised_Gain for r in got) == sorted((14.0 / 32.0 - c) * 14.0 for c in (1.0, 2.0, 4.0))


def test_intended_figures(rows, spark):
    prices = rows(PRICES, ("T", DAY - dt.timedelta(days=2), 1.0), ("T", DAY - dt.timedelta(days=1), 5.0))
    empty = spark.createDataFrame([], SNAPSHOT)
    (got,) = portfolio.portfolio_snapshot_intent(_validated(rows), empty, prices, DAY).collect()
    average = (20.0 - 12.0) / 6.0
    assert (got.Amount, got.Daily_Amount_Change, got.Avg_Price) == (6.0, 6.0, average)
    assert got.Realised_Gain == 4.0 * (3.0 - average)
    assert got.Unrealised_Gain == (5.0 - average) * 6.0


def test_an_emptied_holding_does_not_fail_the_day(rows, spark):
    validated = rows(
        "Analyst bigint, Ticker string, Price double, Txn_Type string, Amount double, p_date date, Txn_Time timestamp_ntz",
        (1, "T", 2.0, "BUY", 5.0, DAY, at(1)),
        (1, "T", 3.0, "SELL", -5.0, DAY, at(2)),
    )
    empty, prices = spark.createDataFrame([], SNAPSHOT), spark.createDataFrame([], PRICES)
    (got,) = portfolio.portfolio_snapshot_intent(validated, empty, prices, DAY).collect()
    assert (got.Amount, got.Realised_Gain, got.Avg_Price, got.Unrealised_Gain) == (0.0, 0.0, None, None)


def _replay(raw, prices, folder, first, last, intent):
    warehouse = Warehouse(raw.sparkSession, str(folder / "w"))
    names = {f.name for f in table_schema("stock_prices")}
    quotes = prices.withColumns({n: F.lit(None) for n in names - set(prices.columns)})
    day_partitions.overwrite_days(
        load.enforce(quotes, table_schema("stock_prices")),
        warehouse.path("stock_prices"),
        [r.p_date for r in prices.select("p_date").distinct().collect()],
    )
    daily.run_range(
        first,
        last,
        lambda ds: warehouse.write("ledger_raw", raw.where(F.col("p_date") == F.lit(ds)), ds),
        lambda ds: daily.run_ledger(warehouse, ds, first),
        lambda ds: daily.run_portfolio(warehouse, ds, intent=intent, first_day=first),
    )
    return warehouse


def test_published_figures_replayed_over_days(rows, tmp_path):
    """Two days by hand: the second opens with one row per close of the first."""
    next_day = DAY + dt.timedelta(days=1)
    raw = rows(
        RAW,
        (DAY, 1, "BUY", "T", 2.0, 10.0, at(1), 1),
        (next_day, 1, "SELL", "T", 3.0, 4.0, at(1, next_day), 2),
        (next_day, 1, "SELL", "T", 3.0, 99.0, at(2, next_day), 3),
    )
    prices = rows(PRICES, ("T", DAY - dt.timedelta(days=1), 1.0), ("T", DAY, 2.0))
    table = _replay(raw, prices, tmp_path, DAY, next_day, intent=False).read("portfolio_snapshot")
    first = table.where(F.col("p_date") == F.lit(DAY)).collect()
    assert len(first) == 2 and {(r.Amount, r.Avg_Price) for r in first} == {(10.0, 0.5)}
    second = table.where(F.col("p_date") == F.lit(next_day)).collect()
    # Opening rows of 10 each, and the accepted sell of 4 added once more.
    assert len(second) == 2 and {(r.Amount, r.Daily_Amount_Change) for r in second} == {(24.0, 20.0)}
    assert {r.Avg_Price for r in second} == {24.0 / (2 * 10.0 * 0.5 + 4.0 * 3.0)}
    assert {r.Realised_Gain for r in second} == {-4.0 * (3.0 - 22.0 / 24.0)}


def _random_ledger(rows, days, seed):
    generator = random.Random(seed)
    entries = []
    for d in range(days):
        day = DAY + dt.timedelta(days=d)
        for minute in sorted(generator.sample(range(1440), generator.choice([0, 8, 15]))):
            entries.append(
                (day, generator.randint(1, 2), generator.choice(["BUY", "SELL"]), generator.choice(["T", "U"]),
                 float(generator.randint(1, 9)), float(generator.randint(1, 6)), at(minute, day), len(entries))
            )
    return rows(RAW, *entries)


def _figures(frame):
    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    columns = portfolio.SNAPSHOT_COLUMNS
    return sorted(([plain(r[c]) for c in columns] for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_the_daily_runs(spark, rows, tmp_path, seed):
    days = 5
    raw = _random_ledger(rows, days, seed)
    prices = rows(PRICES, *[(c, DAY + dt.timedelta(days=n), 2.0 + n) for c in ("T", "U") for n in (-3, 0, 2)])
    last = DAY + dt.timedelta(days=days - 1)
    warehouse = _replay(raw, prices, tmp_path, DAY, last, intent=True)
    once = _figures(warehouse.read("portfolio_snapshot"))
    assert once and once == _figures(portfolio.portfolio_history(raw, prices, last))
    assert once == _figures(portfolio.portfolio_history(raw, prices, last, 3, "second"))
    daily.run_ledger(warehouse, last)  # rerunning a day changes nothing
    daily.run_portfolio(warehouse, last, intent=True)
    assert _figures(warehouse.read("portfolio_snapshot")) == once
