"""From raw documents to packed sequences: quality rules, line de-duplication, near-duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and read
again as the documents of the next one; a stage first removes
the intermediate tables of the stage before it, whose result has been written by then.  The first four return the columns of ``documents``; ``n_chars``, where there is one,
is the number of code points of the text as it stands after the stage.

Defined results follow the operators: NULL and blank texts fail the quality rules, so later stages see texts with words only, until line
or passage removal empties one; such a document stays with an empty text and is packed as its end token.  Rows that
repeat an id and a text are kept or dropped alike.  Other columns, whatever their names, are passed through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm import chunk_dedup, line_spread, minhash_join, quality_rules, slack_packing
from daymart.llm.tables import drop_written, recorded, table, written


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


#: Intermediate tables of the stage that ran last.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_written(spark, _left, docs)
        with recorded() as paths:
            result = function(spark, docs, sf_dir)
        _left[:] = paths
        return result

    return stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_spread.cleaned(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_join.unique_documents(docs, size=5, percent=80)


@_stage
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(chunk_dedup.deduplicated(docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return slack_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_spread", lines),
    ("minhash_join", near_duplicates),
    ("chunk_dedup", passages),
    ("slack_packing", packing),
]

#: Expectation-maximisation, signatures and the tokenizer have no SQL form; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
