"""The as-of merge against a row-by-row search."""

import datetime as dt
import random

from daymart.operators.asof import asof_merge

START = dt.date(2022, 1, 1)


def day(n):
    return None if n is None else START + dt.timedelta(days=n)


def brute(asked, known, tolerance):
    for code, at, n in asked:
        seen = [(d, v) for c, d, v in known if c is not None and c == code and d is not None and at is not None and d <= at]
        best = max(seen, key=lambda s: (s[0], s[1] is not None, s[1] or 0), default=None)
        yield (code, day(at), n, *((day(best[0]), best[1]) if best and (tolerance is None or at - best[0] <= tolerance) else (None, None)))


def test_every_row_finds_the_latest_value(rows):
    draw = random.Random(4)
    asked = [(draw.choice("AAAAAB") if i % 9 else None, draw.randrange(300) if i % 7 else None, i) for i in range(200)]
    known = [(draw.choice(["A", "B", None]), draw.choice([*range(0, 300, 5), None]), draw.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)]
    left = rows("code string, at date, n int", *[(c, day(a), n) for c, a, n in asked])
    right = rows("code string, known date, Close double", *[(c, day(d), v) for c, d, v in known])
    for tolerance in (None, 0, 3, 40):
        for block in (1, 7, 10_000):
            found = asof_merge(left, right, ["code"], "at", "known", ["Close"], tolerance, block)
            assert found.columns == ["code", "at", "n", "known", "Close"]
            assert sorted(found.collect(), key=lambda r: r.n) == sorted(brute(asked, known, tolerance), key=lambda r: r[2])


def test_stamps_repeated_rows_and_empty_sides(rows):
    left = rows("code string, at timestamp_ntz", *[("A", dt.datetime(2022, 1, 3, h)) for h in (8, 8, 12)])
    right = rows("code string, known timestamp_ntz, Close double", ("A", dt.datetime(2022, 1, 3, 9), 5.0), ("A", dt.datetime(2022, 1, 1), 4.0))
    merged = lambda a, b: sorted(r.Close for r in asof_merge(a, b, ["code"], "at", "known", ["Close"]).collect())
    assert merged(left, right) == [4.0, 4.0, 5.0]
    assert merged(left.where("false"), right) == []
    assert [r.Close for r in asof_merge(left, right.where("false"), ["code"], "at", "known", ["Close"]).collect()] == [None] * 3


def test_no_value_is_copied(rows):
    left, right = rows("code string, at date"), rows("code string, known date, Close double")
    plan = asof_merge(left, right, ["code"], "at", "known", ["Close"], 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
