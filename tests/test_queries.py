"""Every query against its SQL text on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from bindings.oracles import ORACLES  # noqa: E402
from bindings.queries import bound  # noqa: E402
from compare import database, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_query_has_a_text():
    assert set(bound()) == set(ORACLES)
    assert set(bound()) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(bound()))
def test_query(spark, connection, name):
    assert difference(connection, queries()[name](spark, FOLDER), oracle_sql()[name]) is None
