"""The load log: which reports were loaded, and with what result.

The log is append-only; replacing a row means appending a newer one, so a
crash can never leave it half written. The newest row is found by a grouped
maximum, which is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.schema import LEDGER_COLUMNS, LEDGER_SCHEMA, STATUS_SUCCESS

_ORDER = ["ingested_at", "seq"]
_VALUES = [c for c in LEDGER_SCHEMA.names if c not in ["file_name", *_ORDER]]


def current_ledger(log: DataFrame) -> DataFrame:
    """One row per file: the newest by time, then by sequence number."""
    newest = F.max(F.struct(*_ORDER, *_VALUES)).alias("newest")
    return log.groupBy("file_name").agg(newest).select("file_name", "newest.*").select(*LEDGER_COLUMNS)


def upsert(log: DataFrame, new: DataFrame) -> DataFrame:
    """Current rows after ``new`` replaced the rows of the same files."""
    return current_ledger(log.unionByName(new))


def insert_if_absent(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` whose file the ledger does not know yet."""
    return new.join(ledger.select("file_name"), "file_name", "left_anti")


def loaded_files(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == STATUS_SUCCESS).select("file_name")


def already_loaded(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    return candidates.join(loaded_files(ledger), "file_name", "left_semi")


def pending(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates without a successful load; a failed load does not block a retry."""
    return candidates.join(loaded_files(ledger), "file_name", "left_anti")


def without_lost_success(results: DataFrame, ledger: DataFrame) -> DataFrame:
    """Results without the failures of files whose earlier load is still in the table."""
    kept = loaded_files(ledger).withColumn("kept", F.lit(True))
    joined = results.join(kept, "file_name", "left")
    return joined.where((F.col("status") == STATUS_SUCCESS) | F.col("kept").isNull()).drop("kept")


def load_plan(expected: DataFrame, listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(file_name, year, month, path, loaded)`` per expected report.

    ``path`` is NULL if there is no such report yet; a report that lies in
    several places has a row for each.
    """
    loaded = loaded_files(ledger).withColumn("loaded", F.lit(True))
    return (
        expected.join(listed.select("file_name", "path"), "file_name", "left")
        .join(loaded, "file_name", "left")
        .fillna(False, "loaded")
    )


def is_loaded(ledger: DataFrame, file_name: str) -> bool:
    hit = (F.col("file_name") == file_name) & (F.col("status") == STATUS_SUCCESS)
    return not ledger.where(hit).isEmpty()


def log_rows(results: DataFrame, ingested_at: Column) -> DataFrame:
    """Log rows from ``(file_name, year, month, n_rows, status)``; time to the second, in UTC."""
    return results.select(
        "file_name",
        "year",
        "month",
        F.date_trunc("second", ingested_at).alias("ingested_at"),
        F.col("n_rows").cast("long").alias("n_rows"),
        "status",
        F.unix_micros(ingested_at).alias("seq"),
    )


def time_text(at: Column) -> Column:
    """A time of the log as text, to the second, in UTC whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def file_row_counts(flights: DataFrame) -> DataFrame:
    return flights.groupBy("source_file").agg(F.count("*").alias("n_rows"))
