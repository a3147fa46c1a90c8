"""Numbers that arrive as text, and averages that do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_percent(text: Column) -> Column:
    """``'1,234.5%'`` -> 12.345; NULL stays NULL."""
    digits = F.rtrim(F.translate(text, ",", ""), F.lit("%"))
    return digits.try_cast("double") / F.lit(100.0)


def parse_magnitude(text: Column) -> Column:
    """``'1.5B'`` -> 1.5e9 with case-sensitive k, M and B; a missing value is 0.0."""
    unit = F.right(text, F.lit(1))
    scale = F.when(unit == "k", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9)
    number = F.when(scale.isNull(), text).otherwise(F.left(text, F.length(text) - 1)).try_cast("double")
    return F.when(text.isNull(), F.lit(0.0)).otherwise(number * F.coalesce(scale, F.lit(1.0)))


def parse_ratio(text: Column) -> Column:
    """``'3:2'`` -> 1.5; anything that is not two whole numbers is NULL."""
    parts = F.split(text, ":")
    top, bottom = F.get(parts, F.lit(0)).try_cast("bigint"), F.get(parts, F.lit(1)).try_cast("bigint")
    return F.when(F.size(parts) == 2, F.try_divide(top.cast("double"), bottom.cast("double")))


def micros(score: Column) -> Column:
    """A score in whole millionths, so that sums are exact in any order."""
    return F.round(score * F.lit(1e6)).cast("bigint")


def mean_of_micros(total: Column, count: Column) -> Column:
    """Unrounded mean from an exact sum of millionths; NULL for an empty group."""
    return F.try_divide(total.cast("double"), count) / F.lit(1e6)


def round_half_up(value: Column, digits: int) -> Column:
    """Round through DECIMAL, where a tie is a tie."""
    return F.round(value.cast("decimal(28,12)"), digits).cast("double")


def combined_mean(first: Column, second: Column, digits: int = 5) -> Column:
    """Mean of two means, or the one that exists."""
    return (
        F.when(first.isNull(), round_half_up(second, digits))
        .when(second.isNull(), round_half_up(first, digits))
        .otherwise(round_half_up((first + second) / F.lit(2.0), digits))
    )
