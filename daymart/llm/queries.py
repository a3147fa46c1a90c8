"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm import (
    byte_bpe,
    chunk_dedup,
    code_search,
    language,
    line_spread,
    minhash_join,
    notices,
    pairwise_quality,
    quality_rules,
    slack_packing,
    spotsigs,
    turn_repair,
    whitening,
)
from daymart.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    taught = table(spark, folder, "labels").filter(_fold(3) != 1).select("doc_id", F.col("quality").alias("label"))
    model = pairwise_quality.fit(docs, taught)
    return pairwise_quality.scored(docs, model).select("doc_id", (_fold(3) == 1).alias("held_out"), "score", "predicted")


def op2_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return line_spread.cleaned(docs, report=True).select("doc_id", "text", "n_lines", "n_removed")


def op3_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chunk_dedup.deduplicated(docs, report=True)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    m = F.col("m")
    return quality_rules.judged(table(spark, folder, "documents"), "text", "m", keep=["doc_id"]).select(
        "doc_id",
        *[m[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")],
    )


def op5_notices(spark: SparkSession, folder: str) -> DataFrame:
    return notices.scanned(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(_fold(4) != 2))
    return language.identified(docs, model).select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encoded(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op8_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return slack_packing.packed(table(spark, folder, "documents"), path, with_ids=False)


def op9_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    # Once for each text: the next document's signatures are taken over, those of the edited text differ from a place on only.
    rows = spotsigs.with_next(table(spark, folder, "documents"), derive=lambda text: spotsigs.placed_signatures(spotsigs.words_of(text)))
    new = spotsigs.edited_places(F.col("text"), F.col("next_text"), F.col("derived"))
    marked = rows.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(spotsigs.edited(F.col("text"), F.col("next_text")), 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.col("derived").alias("own"), new.alias("new"), F.col("next_derived").alias("next")))).alias("p"),
    )
    s, p = F.col("s"), F.col("p")
    sets = F.struct(*[spotsigs.as_set(p[k]["chains"], p[k]["windows"]).alias(k) for k in ("own", "new", "next")])
    return marked.withColumn("s", F.explode(F.array(sets))).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spotsigs.fingerprint(s["own"]).alias("fingerprint"),
        spotsigs.fingerprint(s["new"]).alias("edited_fingerprint"),
        spotsigs.likeness(s["own"], s["new"]).alias("near_edited"),
        spotsigs.likeness(s["own"], s["next"]).alias("near_next"),
    )


def op10_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_join.grouped(table(spark, folder, "documents"), size=3, percent=85)


def op11_code_search(spark: SparkSession, folder: str) -> DataFrame:
    return code_search.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"), components=16, scale=64, shift=1_000_000)


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of sentence ends, repeated or given to the user by a digest of conversation and turn."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    harm, role, text = F.crc32(name) % 20, F.coalesce("role", space), F.coalesce("text", space)
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), harm.alias("harm"))
        .where("harm <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    found = turn_repair.summary(turn_repair.repaired(damaged_turns(given)))
    every = given.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def bound() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()}
