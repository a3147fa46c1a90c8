"""Typed load: cast to the table's types and insist on its required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trimmed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Strip white space at both ends; a missing string stays missing."""
    return rows.withColumns({n: F.regexp_replace(F.col(n), r"^\s+|\s+$", "") for n in names})


def enforce(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Select, order and cast the schema's columns; a NULL in a required one fails the job.

    The check rides on the projection, so it costs no extra pass.
    """

    def typed(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            failure = F.raise_error(F.lit(f"required field {field.name} is missing")).cast(field.dataType)
            value = F.coalesce(value, failure)
        return value.alias(field.name)

    return rows.select(*[typed(f) for f in schema.fields])


def required_violations(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """One row with the number of missing values per required field."""
    required = [f.name for f in schema.fields if not f.nullable]
    return rows.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in required])
