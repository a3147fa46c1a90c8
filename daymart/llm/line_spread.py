"""Boilerplate lines by the number of distinct sites they occur on, in built-in functions only.

Every line (trimmed, by a 128-bit digest) gets a HyperLogLog sketch of its sites; sketches merge by aggregation, so the most
frequent line costs one sketch per task.  A line far below the threshold is settled by its estimate; lines
within ``margin`` of it or above get an exact distinct count, from (line, site) pairs.  A line on at least ``min_sites`` sites
is boilerplate and goes from every document, with two exceptions that keep content:

* lines of fewer than ``min_words`` words stay: short lines repeat by chance;
* a document of which boilerplate lines hold more than ``max_share`` of the words stays as it is: it is a copy of another document,
  which is for document-level de-duplication to judge, and not a page around which boilerplate stands.

Only digests, sites and ids are shuffled for counting; texts are shuffled once, with the digests to drop, unless these are few
enough for Spark to broadcast by size.

Defined results: a NULL text stays NULL and an empty one empty; a NULL site counts as no site; rows that repeat an id are cleaned each
for itself; rows with a NULL id are cleaned like others; lines keep their order and spelling; a cleaned text is joined by line feeds; other
columns are passed through untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import fresh, written

SPACE = " \t\n\x0b\x0c\r"
GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_trimmed(line)))


def _n_words(line: Column) -> Column:
    words = F.split(_trimmed(line), GAP)
    return F.when(F.element_at(words, 1) == "", F.lit(0)).otherwise(F.size(words))


def lines_of(docs: DataFrame, id: str, text: str, site: str, min_words: int) -> DataFrame:
    """``id``, ``site`` and ``line`` (digest) of every line with enough words, written out: three steps read it."""
    lines = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{site}`").cast("string").alias("site"), F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line")
    )
    enough = GAP.join([WORD] * max(min_words, 1))  # looks no further than these words
    return written(lines.filter(F.col("line").rlike(enough)).withColumn("line", _digest(F.col("line"))))


def spread_lines(lines: DataFrame, min_sites: int, precision: int = 12, margin: float = 0.1) -> DataFrame:
    """Digests of the lines on at least ``min_sites`` sites, with the exact number of ``sites``.

    The standard error of a sketch is about ``1.04 / sqrt(2 ** precision)``; ``margin`` is over six times that, so that no line
    at the threshold is lost to its estimate.
    """
    assert margin > 6 * 1.04 / math.sqrt(2**precision)
    placed = lines.filter(F.col("site").isNotNull())
    sketched = placed.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(precision)).alias("sketch"))
    near = sketched.filter(F.hll_sketch_estimate("sketch") >= math.floor(min_sites * (1 - margin))).select("line")
    # One row for each line and site before the join, however often the line stands there.
    pairs = placed.select("line", "site").distinct()
    exact = pairs.join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("sites"))
    return exact.filter(F.col("sites") >= min_sites)


def cleaned(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 8,
    min_words: int = 3,
    max_share: float = 0.5,
    report: bool = False,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; with ``report`` also ``n_lines`` and ``n_removed``."""
    key, gone_lines, outcome = (fresh(docs, name) for name in ("_key", "_gone_lines", "_outcome"))
    lines = lines_of(docs, id, text, site, min_words)
    drop = (
        lines.select("id", "line")
        .join(written(spread_lines(lines, min_sites).select("line")), "line")
        .groupBy("id")
        .agg(F.collect_set("line").alias("line"))
        .select(F.col("id").alias(key), F.col("line").alias(gone_lines))
    )
    joined = docs.join(drop, docs[f"`{id}`"].eqNullSafe(drop[key]), "left").drop(key)
    raw = F.split(F.col(f"`{text}`"), "\n")

    def marked(lines: Column) -> Column:
        return F.transform(
            lines,
            lambda line: F.struct(
                line.alias("line"), _n_words(line).alias("words"), F.array_contains(gone_lines, _digest(line)).alias("known")
            ),
        )

    def judged(lines: Column) -> Column:
        gone = F.filter(lines, lambda x: x["known"] & (x["words"] >= min_words))
        total = F.aggregate(lines, F.lit(0), lambda a, x: a + x["words"])
        removed = F.aggregate(gone, F.lit(0), lambda a, x: a + x["words"])
        kept = F.filter(lines, lambda x: ~(x["known"] & (x["words"] >= min_words)))
        copy = removed > max_share * total
        return F.struct(
            F.when(~copy, F.array_join(F.transform(kept, lambda x: x["line"]), "\n")).alias("text"),
            F.when(~copy, F.size(gone)).otherwise(0).alias("removed"),
        )

    result = F.when(
        F.col(gone_lines).isNotNull(), F.element_at(F.transform(F.array(marked(raw)), judged), 1)
    )
    frame = joined.withColumn(outcome, F.explode(F.array(result)))
    clean = F.coalesce(F.col(outcome)["text"], F.col(f"`{text}`"))
    columns = [clean.alias(text) if name == text else F.col(f"`{name}`") for name in docs.columns]
    if report:
        columns += [
            F.coalesce(F.size(raw), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.col(outcome)["removed"], F.lit(0)).cast("long").alias("n_removed"),
        ]
    return frame.select(*columns)
