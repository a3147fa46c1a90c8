"""Text and name cleaning, sentiment scores and labels."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the cleaner removes - handles (the dash in the class is U+2013 and the
# class therefore holds only the digits 0 and 9), anything that is neither an ASCII word
# character nor white space, and links.  The separators \x1c to \x1f count as white space;
# a look-ahead spares them because the JVM is several times slower if they join the class.
NOISE = r"@[A-Za-z0–9_]+|(?![\x1c-\x1f])[^\w\s]|http\S+"

# Replaces that turn a statistic's label into a column name, in this order.
NAME_REPLACES = [
    ("/", ""), (" ", "_"), ("(", "_"), (")", "_"), ("-", "_"), ("%", "percent"), ("&", "n"),
    ("52", "_52"), ("50", "_50"), ("200", "_200"), ("5_year", "_5_year"),
]

# Fixed value: the normalisation constant of the compound score (Hutto & Gilbert, 2014).
COMPOUND_ALPHA = 15.0


def clean_text(text: Column) -> Column:
    return F.regexp_replace(text, NOISE, "")


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, "\n", " ")


def normalise_name(name: Column) -> Column:
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), NAME_REPLACES, name)


def normalise_column_names(names: list[str]) -> list[str]:
    """The same rule for the names of a frame, e.g. ``df.toDF(*normalise_column_names(df.columns))``."""
    return [reduce(lambda c, r: c.replace(*r), NAME_REPLACES, name) for name in names]


def strip_suffix(code: Column) -> Column:
    """``'D05.SI'`` -> ``'D05'``."""
    return F.substring_index(code, ".", 1)


def with_suffix(code: Column, suffix: str = ".SI") -> Column:
    return F.concat(code, F.lit(suffix))


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), r"\s+")


def compound(valence: Column) -> Column:
    """Summed valence squeezed into [-1, 1], to four decimals."""
    raw = valence / F.sqrt(valence * valence + F.lit(COMPOUND_ALPHA))
    return F.round(raw.cast("decimal(28,12)"), 4).cast("double")


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def valence_sum(text: str, lexicon: Mapping[str, float]) -> Column:
    """Sum of the valences of all tokens of the column ``text``, row by row, without a shuffle.

    Tokens of equal valence share one hashed ``IN`` set, so a token costs one lookup unless
    it is in the lexicon.  Sums are kept in thousandths, halves rounded away from zero, and are
    therefore exact; a word without a valence counts nothing.
    """
    lexicon = {word: valence for word, valence in lexicon.items() if valence is not None}
    if not lexicon:
        return F.when(F.col(text).isNotNull(), F.lit(0.0))
    by_valence: dict[int, list[str]] = {}
    for word, valence in lexicon.items():
        thousandths = (Decimal(repr(float(valence))) * 1000).quantize(Decimal(1), ROUND_HALF_UP)
        by_valence.setdefault(int(thousandths), []).append(word)
    weight = " ".join(f"WHEN t IN ({_quoted(words)}) THEN {w}L" for w, words in by_valence.items())
    hits = f"filter(split(lower(`{text}`), r'\\s+'), t -> t IN ({_quoted(list(lexicon))}))"
    return F.expr(f"aggregate({hits}, 0L, (total, t) -> total + CASE {weight} ELSE 0L END)") / F.lit(1000.0)


def post_label(score: Column) -> Column:
    """Label of one text; the bounds themselves are neutral."""
    return F.when(score > 0.4, "positive").when(score < -0.4, "negative").otherwise("neutral")


def ticker_label(score: Column) -> Column:
    """Label of an averaged score; no score is neutral too."""
    return F.when(score > 0.3, "POSITIVE").when(score < -0.3, "NEGATIVE").otherwise("NEUTRAL")
