"""Validated ledger: entries that the holdings could cover."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.functions.dates import start_of_time
from daymart.operators import ledger_fold
from daymart.sources.day_tables import on_day

LEDGER_COLUMNS = ["Analyst", "Ticker", "Price", "Txn_Type", "Amount", "p_date", "Txn_Time"]
_KEYS = ["run_date", "Analyst", "Ticker"]


def _entry_id(raw: DataFrame):
    """Breaks ties of time and type; without an id, amount and price do, so only equal entries tie."""
    return F.col("Txn_Id").cast("bigint") if "Txn_Id" in raw.columns else F.lit(None).cast("bigint")


def signed_entries(raw: DataFrame) -> DataFrame:
    """Raw entries with sells as negative amounts."""
    signed = F.when(F.col("Txn_Type") == "BUY", F.col("Amount")).otherwise(-F.col("Amount"))
    return raw.select(
        "Analyst", "Ticker", "Price", "Txn_Type", signed.alias("Amount"), "p_date", "Txn_Time",
        _entry_id(raw).alias("Txn_Id"),
    )


def carry_forward(raw: DataFrame, snapshot: DataFrame, ds: dt.date | None = None) -> DataFrame:
    """Each run date's entries plus the previous day's holdings as opening entries that sort
    before everything else."""
    entries = signed_entries(on_day(raw, ds)).withColumn("run_date", F.col("p_date"))
    previous = on_day(snapshot, None if ds is None else ds - dt.timedelta(days=1))
    opening = previous.select(
        "Analyst",
        "Ticker",
        F.lit(0.0).alias("Price"),
        F.lit("Buy").alias("Txn_Type"),
        "Amount",
        "p_date",
        start_of_time().alias("Txn_Time"),
        F.lit(None).cast("bigint").alias("Txn_Id"),
        F.date_add("p_date", 1).alias("run_date"),
    )
    return entries.unionByName(opening)


def validated_ledger(
    raw: DataFrame,
    snapshot: DataFrame,
    ds: dt.date | None = None,
    chunk_rows: int | None = ledger_fold.CHUNK_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Entries of the run date that never take a holding below zero, amounts signed."""
    flagged = ledger_fold.accept_flags(
        carry_forward(raw, snapshot, ds),
        _KEYS,
        ["Txn_Time", "Txn_Type", "Txn_Id", "Amount", "Price"],
        "Amount",
        "Txn_Time",
        chunk_rows=chunk_rows,
    )
    return flagged.where(F.col("Is_Valid") & (F.col("p_date") == F.col("run_date"))).select(*LEDGER_COLUMNS, *keep)
