import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import prose  # noqa: E402

#: Names that clash with results and temporary columns.
DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, line string, score double, "
    "_key string, _gone_lines string, _places string, _measures string, _gone string, kept string"
)


@pytest.fixture(scope="session")
def make(spark):
    """``make([(doc_id, text, lang, source), ...])`` -> documents with clashing extra columns."""
    return lambda rows: spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * 2, 0.5, *["x"] * 6) for r in rows], DDL)


@pytest.fixture(scope="session")
def messy():
    """Nulls in every column, empty and blank texts, a very long text, a repeated row."""
    return [
        (1, prose(1), "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \n\t ", "de", "b"),
        (5, prose(5, 30_000), "en", None),
        (6, prose(6), None, "b"),
        (6, prose(6), None, "b"),
        (None, prose(7), "en", "c"),
        (8, prose(1), "en", "c"),
        (9, "é" * 5_000, "fr", "c"),
    ]
