"""Landed files: delimited exchange files and paged JSON."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import as_date
from daymart.sinks.load import trimmed

# The fields of the exchange's daily price file, in file order.
PRICE_FILE_FIELDS = [
    "Trade_Date", "Stock_Name", "Remarks", "Currency", "High", "Low", "Last", "Change",
    "Volume", "Bid", "Offer", "Market", "Open", "Value", "Stock_Code", "DClose",
]


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Headerless delimited text with a given schema.

    Padding is stripped, a delimiter at the end of a line is tolerated, and a number or date
    that cannot be read fails the job.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = trimmed(spark.read.schema(as_text).option("sep", sep).csv(path), as_text.names)

    def typed(field: T.StructField) -> Column:
        value = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            value = F.nullif(value, F.lit("")).cast(field.dataType)
        return value.alias(field.name)

    return rows.select(*[typed(f) for f in schema.fields])


def read_delimited_tolerant(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """As ``read_delimited``, but a line that cannot be used costs only itself; the schema's columns, ``bad_line`` and ``reason``.

    A good line has NULL in both.  A bad one has NULL in the schema's columns, its text, and as reason ``fields`` for too few or too many
    of them, or the name of the first column whose text is no value of its type.  Blank lines are skipped.  One pass, no shuffle.
    """
    names = [f.name for f in schema.fields]
    parsed = ", ".join(f"`{n}` string" for n in [*names, "_unreadable"])
    options = {"sep": sep, "columnNameOfCorruptRecord": "_unreadable"}
    line = F.col("_line")
    # A delimiter at the end is tolerated where the line has a field too many with it.
    whole = F.from_csv(line, parsed, options)
    shorter = F.from_csv(F.regexp_replace(line, rf"\Q{sep}\E\s*$", ""), parsed, options)
    lines = spark.read.text(path).toDF("_line").where(F.trim(line) != "").withColumn("_whole", whole)
    rows = lines.withColumn("_row", F.when(F.col("_whole._unreadable").isNull(), F.col("_whole")).otherwise(shorter))
    texts = trimmed(rows.select("_line", "_row.*"), names)

    def typed(field: T.StructField) -> Column:
        text = F.col(field.name)
        return text if isinstance(field.dataType, T.StringType) else F.nullif(text, F.lit("")).try_cast(field.dataType)

    wrong = [
        F.when((F.col(f.name) != "") & typed(f).isNull(), F.lit(f.name)) for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    reason = F.coalesce(F.when(F.col("_unreadable").isNotNull(), F.lit("fields")), *wrong, F.lit(None).cast("string"))
    judged = texts.withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    return judged.select(
        *[F.when(good, typed(f)).alias(f.name) for f in schema.fields],
        F.when(~good, line).alias("bad_line"),
        F.col("_reason").alias("reason"),
    )


def read_price_file(spark: SparkSession, path: str, ds: dt.date | str, table: T.StructType) -> DataFrame:
    """One daily price file, stamped with its run date."""
    schema = T.StructType([T.StructField(n, table[n].dataType) for n in PRICE_FILE_FIELDS])
    return read_delimited(spark, path, schema).withColumn("p_date", F.lit(as_date(ds)))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every landed page file as one row of raw text (``payload``)."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def read_numbered_pages(spark: SparkSession, path: str, pattern: str = r"^(.+?)[-_]?([0-9]+)\.[^.]*$", of_path: bool = False) -> DataFrame:
    """Landed page files as ``list_name, page_number, file, payload``: the file name without its number, and the number.

    ``pattern`` has a group for each and is held against the file's name, or with ``of_path`` its whole path; a file that it does not
    fit has NULL in both.  ``path`` may hold ``p_date=...`` folders; a
    filter on that column leaves the folders of other days unlisted.
    """
    file = F.col("_metadata.file_path" if of_path else "_metadata.file_name")
    fits = file.rlike(pattern)
    pages = spark.read.text(path, wholetext=True, recursiveFileLookup=False)
    folders = [c for c in pages.columns if c != "value"]
    return pages.select(
        F.when(fits, F.regexp_extract(file, pattern, 1)).alias("list_name"),
        F.when(fits, F.regexp_extract(file, pattern, 2).try_cast("bigint")).alias("page_number"),
        file.alias("file"),
        F.col("value").alias("payload"),
        *folders,
    )


def missing_pages(pages: DataFrame, *lists: str, number: str = "page_number", first: int = 0) -> DataFrame:
    """Gaps in the page numbers of each list, as runs ``from_page`` to ``to_page``; the first page of a list is ``first``.

    Pages behind the last landed one cannot be told from their numbers.  Repeated pages are one, pages without a number none.
    """
    landed = pages.where(F.col(number) >= first).select(*lists, F.col(number).alias("_n")).distinct()
    earlier = F.coalesce(F.lag("_n").over(Window.partitionBy(*lists).orderBy("_n")), F.lit(first - 1))
    gaps = landed.select(*lists, (earlier + 1).alias("from_page"), (F.col("_n") - 1).alias("to_page"))
    return gaps.where("from_page <= to_page")
