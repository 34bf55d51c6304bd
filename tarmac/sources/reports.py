"""Monthly CSV reports: listing, header check, reading by column name.

There is one report per month, so lists of reports are bounded by the number of
months, lists of parts by the number of files; rows never reach the driver.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import calendar
from tarmac.operators import clean
from tarmac.schema import RAW_TO_CLEAN, REPORT_SCHEMA

#: names of report files and parts; parts that come from archives are written as text
PART_FILES = "*.{csv,txt}"

CSV_OPTIONS = {"header": True, "escape": '"'}


@dataclass(frozen=True)
class Report:
    """One monthly report: a CSV file, or a folder of CSV parts, each with a header of its own."""

    path: str
    file_name: str
    year: int
    month: int


#: the header of every part of some reports, by the part's path
Headers = dict[str, tuple[str, ...]]


def unless_missing(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, None if its path does not exist; the path is listed once."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return unless_missing(lambda: spark.read.format("binaryFile").load(path)) is not None


def list_reports(spark: SparkSession, landing: str) -> DataFrame:
    """``(path, file_name, year, month)`` of the reports below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", PART_FILES)
    files = unless_missing(lambda: reader.load(landing))
    if files is None:
        return spark.createDataFrame([], "path string, file_name string, year int, month int")
    return reports_of_files(files.select("path"))


def reports_of_files(files: DataFrame) -> DataFrame:
    """The reports that the files (or parts) in column ``path`` belong to."""
    paths = files.select(calendar.report_path(F.col("path")).alias("path")).where("path != ''").distinct()
    return calendar.with_report_period(paths)


def collect_reports(reports: DataFrame) -> list[Report]:
    """At most one entry per month and landing path."""
    rows = reports.select("path", "file_name", "year", "month").orderBy("year", "month", "path").collect()
    return [Report(**row.asDict()) for row in rows]


#: makes every part a scan task of its own: no split, and no second part beside it
_ONE_PART_PER_TASK = {"spark.sql.files.maxPartitionBytes": "1p", "spark.sql.files.openCostInBytes": "1p"}


def first_lines(spark: SparkSession, reports: list[Report]) -> DataFrame:
    """``(file_path, value)``: the first line of every part. A task has one part, so it is the line whose number in its task, the lower 33 bits of its id, is 0."""
    # settings of a session of its own disturb nobody
    alone = spark.newSession()
    for key, value in _ONE_PART_PER_TASK.items():
        alone.conf.set(key, value)
    lines = alone.read.option("pathGlobFilter", PART_FILES).text([report.path for report in reports])
    return lines.where(F.monotonically_increasing_id() % (1 << 33) == 0).select("_metadata.file_path", "value")


def read_headers(spark: SparkSession, reports: list[Report]) -> Headers:
    """The first line of every part, split into names; one job, of which a task looks for the beginning of one part.

    The driver holds one header per part. Empty parts have none.
    """
    if not reports:
        return {}
    return {row["file_path"]: tuple(next(csv.reader([row["value"].removeprefix("\ufeff")]), ())) for row in first_lines(spark, reports).collect()}


def place(path: str) -> str:
    """A path without its scheme, of which listings differ."""
    return path.rpartition(":")[2].strip("/")


def headers_by_report(reports: list[Report], headers: Headers) -> dict[Report, Headers]:
    """The parts of each report: the file itself, or what lies below its folder."""
    own = {place(report.path): report for report in reports}
    out: dict[Report, Headers] = {report: {} for report in reports}
    for path, header in headers.items():
        at = place(path)
        while at and at not in own:
            at = at.rpartition("/")[0]
        if at:
            out[own[at]][path] = header
    return out


def missing_columns(header: tuple[str, ...], aliases: dict[str, str]) -> list[str]:
    present = {aliases.get(name, name) for name in header}
    return [name for name in RAW_TO_CLEAN if name not in present]


def read_text_rows(spark: SparkSession, headers: Headers, aliases: dict[str, str] | None = None) -> DataFrame:
    """The report columns of many parts as text, with ``source_file``.

    CSV columns are bound by position, so parts are read in groups of equal
    headers, each with its own schema, and appended by name. ``_overflow`` is
    the first field beyond the header, if a row has one. Parts of a group
    also have their report's name at the same place of their paths. A last column that nobody reads makes the reader
    pick fields by position; else every row without an overflow would be one with too few fields, an exception each.
    """
    aliases = aliases or {}
    groups: dict[tuple[tuple[str, ...], int | None], list[str]] = {}
    for path, header in headers.items():
        groups.setdefault((header, calendar.report_name_place(path)), []).append(path)

    frames = []
    for (header, name_place), paths in groups.items():
        names = [aliases.get(name, name) for name in header]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_overflow", "_unread"]])
        raw = spark.read.schema(schema).options(**CSV_OPTIONS).csv(paths)
        raw = raw.withColumn("source_file", calendar.report_name_of(F.col("_metadata.file_path"), name_place))
        frames.append(clean.select_report_columns(raw, "source_file", "_overflow"))
    if not frames:
        text = [T.StructField(c, T.StringType()) for c in [*REPORT_SCHEMA.names, "source_file", "_overflow"]]
        return spark.createDataFrame([], T.StructType(text))
    return clean.union_by_name(frames)


def count_rows(checked: DataFrame) -> DataFrame:
    """``(source_file, year, month, n_rows, n_bad)`` of rows with the flag ``bad``: what each report adds to each month.

    Rows are counted on the map side, so the shuffle holds a few rows per report.
    """
    return checked.groupBy("source_file", "year", "month").agg(F.expr("count(*) AS n_rows"), F.expr("count_if(bad) AS n_bad"))
