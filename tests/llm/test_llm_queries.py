"""Registered queries: columns of the contracts, and the SQL texts."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import database, difference  # noqa: E402

from daymart.llm.oracles import ORACLES  # noqa: E402
from daymart.llm.queries import bound  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op6": "doc_id held_out lang_pred score",
    "op7": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op10": "doc_id n_shingles component_id kept",
    "op11": "query_id rank vec_id score",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}
#: The table and the column whose values a query returns, where they aren't the documents.
ROWS = {"op11": ("embeddings", "query_id", "vec_id % 20 = 0"), "op12": ("embeddings", "vec_id", "true")}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in bound()) == list(range(1, 14))
    assert set(ORACLES) <= set(bound())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(database(FOLDER), bound()[name](spark, FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(bound()) - set(ORACLES)))
def test_rows(spark, name):
    frame = bound()[name](spark, FOLDER)
    assert set(COLUMNS.get(name.split("_")[0], "doc_id").split()) <= set(frame.columns)
    table, key, those = ROWS.get(name.split("_")[0], ("documents", "doc_id", "true"))
    given = spark.read.parquet(f"{FOLDER}/{table}.parquet").where(those)
    ids = {r[0] for r in frame.select(key).collect()}
    assert ids == {r[0] for r in given.select("vec_id" if table == "embeddings" else key).collect()}
