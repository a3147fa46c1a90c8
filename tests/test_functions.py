import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymart.functions import dates, numbers, text


def values(frame):
    return [row[0] for row in frame.collect()]


@pytest.mark.parametrize(
    ("parse", "cases"),
    [
        (numbers.parse_percent, [("1,234.5%", 12.345), ("12%", 0.12), ("-3.5%", -0.035), (None, None)]),
        (numbers.parse_magnitude, [("1.5B", 1.5e9), ("20M", 2e7), ("3k", 3000.0), ("7", 7.0), ("-2.5M", -2.5e6),
                                   (None, 0.0)]),
        (numbers.parse_ratio, [("3:2", 1.5), ("3", None), ("1:2:3", None), ("a:2", None), ("1:0", None), (None, None)]),
        (text.strip_suffix, [("D05.SI", "D05"), ("D05", "D05"), (None, None)]),
        (text.normalise_name, [
            ("Pricebook (mrq)", "Pricebook__mrq_"),
            ("52-week high 3", "_52_week_high_3"),
            ("200-day moving average 3", "_200_day_moving_average_3"),
            ("5 year average dividend yield 4", "_5_year_average_dividend_yield_4"),
            ("% held by insiders 1", "percent_held_by_insiders_1"),
            ("S&P500 52-week change 3", "SnP_500__52_week_change_3"),
            ("S&P 500 52-week change 3", "SnP__500__52_week_change_3"),
        ]),
        (text.clean_text, [
            ("@user123 hi http://x.co/ab @foo–bar, é!\n$5", "123 hi   \n5"),
            ("plain", "plain"),
            ("tab\tand\x1cfile\x1f", "tab\tand\x1cfile\x1f"),
            ("a\x85b\xa0c\u2028d\U0001f600e\x00f\x0bg", "abcdef\x0bg"),
            ("@@user @é @ https http:// (http://a b)", "      b"),
        ]),
        (text.one_line, [("a\nb\n", "a b ")]),
    ],
)
def test_text_to_value(rows, parse, cases):
    for given, expected in cases:
        assert values(rows("x string", (given,)).select(parse(F.col("x")))) == [expected], given


def test_names_follow_the_same_rule_as_values():
    assert text.normalise_column_names(["Adj Close", "52-week high 3"]) == ["Adj_Close", "_52_week_high_3"]


def test_labels_at_the_bounds(rows):
    posts = rows("s double", (0.4,), (-0.4,), (0.41,), (-0.41,))
    assert values(posts.select(text.post_label(F.col("s")))) == ["neutral", "neutral", "positive", "negative"]
    means = rows("s double", (0.3,), (-0.3,), (0.31,), (-0.31,), (None,))
    expected = ["NEUTRAL", "NEUTRAL", "POSITIVE", "NEGATIVE", "NEUTRAL"]
    assert values(means.select(text.ticker_label(F.col("s")))) == expected


def test_combined_mean(rows):
    pairs = rows("a double, b double", (0.2, None), (None, -0.4), (0.1, 0.2), (None, None))
    assert values(pairs.select(numbers.combined_mean(F.col("a"), F.col("b")))) == [0.2, -0.4, 0.15, None]


def test_rounding_a_tie(rows):
    ties = rows("x double", (-0.160625,), (0.000005,), (0.000015,))
    assert values(ties.select(numbers.round_half_up(F.col("x"), 5))) == [-0.16063, 0.00001, 0.00002]


def test_score_is_symmetric_and_bounded(rows):
    lexicon = {"good": 1.9, "great": 3.1, "bad": -2.5}
    texts = rows("t string", ("Good good GREAT",), ("bad",), ("nothing here",), ("good bad",), ("",), (None,))
    got = values(texts.select(text.compound(text.valence_sum("t", lexicon))))
    assert got == [0.872, -0.5423, 0.0, -0.1531, 0.0, None]


def test_words_with_quotes_and_backslashes(rows):
    lexicon = {"can't": -1.0, "a\\b": 2.0, "x": 0.5, "`": 0.1}
    got = values(rows("t string", ("can't a\\b x",)).select(text.valence_sum("t", lexicon)))
    assert got == [1.5]


def test_score_with_an_empty_lexicon(rows):
    assert values(rows("t string", ("good",)).select(text.compound(text.valence_sum("t", {})))) == [0.0]


def test_opening_stamp_sorts_first(rows):
    got = rows("x int", (1,)).select(dates.start_of_time() < F.lit("1900-01-01").cast("timestamp_ntz"))
    assert values(got) == [True]


def test_time_slots_are_monotone(rows):
    stamps = [dt.datetime(2024, 3, 10, h, m) for h in (0, 1, 2, 3) for m in (0, 30, 59)]
    frame = rows("t timestamp_ntz", *[(s,) for s in stamps])
    slots = values(frame.select(dates.time_slot(F.col("t"), "minute")))
    assert slots == sorted(slots) and len(set(slots)) == len(stamps)
    assert len(set(values(frame.select(dates.time_slot(F.col("t")))))) == 4
    assert values(frame.select(dates.time_slot(F.col("t"), "second"))) == [s * 60 for s in slots]
