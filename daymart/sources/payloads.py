"""Rows out of JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def page_records(pages: DataFrame, payload: str, record: T.StructType, *keep: str) -> DataFrame:
    """``{"data": [{...}, ...]}`` -> one row per object."""
    shape = T.StructType([T.StructField("data", T.ArrayType(record))])
    parsed = F.from_json(F.col(payload), shape)["data"]
    return pages.select(*keep, F.explode(parsed).alias("_r")).select(*keep, "_r.*")


def intraday_points(payloads: DataFrame, payload: str, point: T.StructType, *keep: str) -> DataFrame:
    """``{"data": {"intraday": [{...}, ...]}}`` -> one row per point."""
    shape = T.StructType(
        [T.StructField("data", T.StructType([T.StructField("intraday", T.ArrayType(point))]))]
    )
    parsed = F.from_json(F.col(payload), shape)["data"]["intraday"]
    return payloads.select(*keep, F.explode(parsed).alias("_r")).select(*keep, "_r.*")


def dated_rate(payload: Column, day: Column, currency: str = "SGD") -> Column:
    """The number under ``rates.<day>.<currency>``, whose path depends on the row."""
    rates = F.from_json(payload, "struct<rates: map<string, map<string, double>>>")["rates"]
    return F.try_element_at(F.try_element_at(rates, day.cast("string")), F.lit(currency))


def number_at(payload: Column, name: str) -> Column:
    return F.from_json(payload, f"struct<{name}: bigint>")[name]


def value_at(payload: Column, path: Column, kind: str) -> Column:
    """The value of a JSON text under a path that may depend on the row; NULL where the text is no JSON, the path leads nowhere, or
    what lies there is no ``kind``.  One parse and no intermediate maps."""
    return F.try_variant_get(F.try_parse_json(payload), path, kind)


def unknown_fields(pages: DataFrame, payload: str, record: T.StructType, path: str = "$.data") -> DataFrame:
    """Fields of the objects listed under ``path`` that ``record`` does not name: ``field, kind, n_records``.

    ``kind`` is the type that holds all values of the field.  Sums are taken before the shuffle, so one field of all rows does no harm.
    Pages that are no JSON, or hold no objects there, name no field.
    """
    listed = F.try_variant_get(F.try_parse_json(F.col(payload)), F.lit(path), "array<variant>")
    one = pages.select(F.explode(listed).alias("_record")).where(F.startswith(F.schema_of_variant("_record"), F.lit("OBJECT")))
    values = one.select(F.explode(F.col("_record").cast("map<string, variant>")).alias("field", "_value"))
    return (
        values.where(~F.col("field").isin(record.names))
        .groupBy("field")
        .agg(F.schema_of_variant_agg("_value").alias("kind"), F.count("*").alias("n_records"))
    )
