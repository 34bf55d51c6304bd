"""Month arithmetic and the naming of monthly reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The naming convention of reports and archives.
REPORT_NAME_FORMAT = "%d_%02d_Report.csv"
REPORT_PATH_PATTERN = r"^(.*?[/=]((\d{4})_(\d{2})_Report\.csv))(?:/|$)"
ARCHIVE_PATH_PATTERN = r"(\d{4})_(\d{1,2})\.zip$"


def report_name(year: Column, month: Column) -> Column:
    return F.format_string(REPORT_NAME_FORMAT, year, month)


def report_path(path: Column) -> Column:
    """The path up to and including the report name; a report may be a folder of parts."""
    return F.regexp_extract(path, REPORT_PATH_PATTERN, 1)


def report_name_place(path: str) -> int | None:
    """Which character of a path its report's name begins with, from 1; None without such a name."""
    found = re.match(REPORT_PATH_PATTERN, path, re.ASCII)
    return found.start(2) + 1 if found else None


def report_name_of(path: Column, place: int | None = None) -> Column:
    """The report's name in a path; if it is known at which ``place``, rows need no look at the whole path."""
    name = F.regexp_extract(path, REPORT_PATH_PATTERN, 2)
    if place is None:
        return name
    tail = "_Report.csv"
    return F.when(F.substring(path, place + 7, len(tail)) == tail, F.substring(path, place, 7 + len(tail))).otherwise(name)


def with_report_period(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``file_name``, ``year`` and ``month`` read off a report path."""
    return (
        df.withColumn("file_name", report_name_of(F.col(path)))
        .withColumn("year", F.regexp_extract(F.col(path), REPORT_PATH_PATTERN, 3).cast("int"))
        .withColumn("month", F.regexp_extract(F.col(path), REPORT_PATH_PATTERN, 4).cast("int"))
    )


def months_from_report(file_name: Column, year: Column, month: Column) -> Column:
    """How many months a year and month are after those of a report's name (before: negative); null if any is missing."""
    usual = (F.substring(file_name, 5, 1) == "_") & (F.substring(file_name, 8, 12) == "_Report.csv")
    own = [
        F.when(usual, F.substring(file_name, at, n)).otherwise(F.regexp_extract(F.concat(F.lit("/"), file_name), REPORT_PATH_PATTERN, i)).cast("long")
        for i, at, n in ((3, 1, 4), (4, 6, 2))
    ]
    return (year.cast("long") * 12 + month) - (own[0] * 12 + own[1])


def previous_month(day: Column) -> Column:
    """First day of the month before ``day``: the newest complete month."""
    return F.add_months(F.trunc(day, "month"), -1)


def month_count(first: Column, last: Column) -> Column:
    """Number of months from ``first`` to ``last``, both included."""
    return F.months_between(F.trunc(last, "month"), F.trunc(first, "month")).cast("int") + 1


def explode_months(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month between two date columns, with the report expected for it.

    An empty range (``last`` before ``first``) gives no rows.
    """
    months = F.when(
        F.col(last) >= F.col(first),
        F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")),
    )
    return (
        df.withColumn("month_start", F.explode(months))
        .withColumn("year", F.year("month_start"))
        .withColumn("month", F.month("month_start"))
        .withColumn("file_name", report_name(F.col("year"), F.col("month")))
    )


def month_axis(spark: SparkSession, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """``(year, month, file_name)`` for an inclusive month range."""
    ends = spark.range(1).select(
        F.make_date(F.lit(start[0]), F.lit(start[1]), F.lit(1)).alias("first"),
        F.make_date(F.lit(end[0]), F.lit(end[1]), F.lit(1)).alias("last"),
    )
    return explode_months(ends, "first", "last").select("year", "month", "file_name")


def default_period(spark: SparkSession, today: str | None = None) -> tuple[int, int]:
    """(year, month) of the month before ``today`` (ISO date; the current UTC date if not given)."""
    day = F.lit(today).cast("date") if today else F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    month = previous_month(day)
    row = spark.range(1).select(F.year(month).alias("y"), F.month(month).alias("m")).first()
    return row["y"], row["m"]
