"""Continuous loading of reports as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions import calendar
from tarmac.plans.ingest import LoadResult, load_reports
from tarmac.plans.pipeline import publish
from tarmac.schema import STATUS_FAILED
from tarmac.sources.reports import PART_FILES, collect_reports, list_reports, place, reports_of_files
from tarmac.sources.warehouse import Warehouse

#: the file source forgets files older than this, in comparison with the newest one
NO_AGE_LIMIT = "36500d"

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


class StreamRun:
    """A running query whose results are published once, when it has ended; what else it is asked, the query answers."""

    def __init__(self, query: StreamingQuery, publish_results: Callable[[], None]):
        self._query, self._publish, self._published = query, publish_results, False

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802 (the query's name)
        ended = self._query.awaitTermination(timeout) if timeout is not None else self._query.awaitTermination()
        if not self._query.isActive and not self._published:
            self._published = True
            self._publish()
        return ended

    def __getattr__(self, name: str):
        return getattr(self._query, name)


def stream_reports(
    warehouse: Warehouse,
    landing: str,
    checkpoint: str,
    export_folder: str | None = None,
    aliases: dict[str, str] | None = None,
    max_files: int = 1000,
) -> StreamRun:
    """Loads every report that landed since the last run, whatever its age, then stops.

    Before that, reports whose last load failed are tried again, as a repaired file at
    the same path is not new to the stream.

    The stream carries file paths only (contents are pruned from the scan); each
    micro-batch reads its reports by column name, which a CSV stream cannot do:
    it binds columns by position. The checkpoint remembers which files were
    seen. A report is loaded whole, with all its parts in the landing folder, by the first batch that has one of them. The warehouse
    knows the parts it read, so later batches, of this run or another, load the report again only for parts that were not there then or
    changed since; a batch replayed after a crash finds its parts read, or nothing of them. A batch recomputes the summary of the
    months it changed. Views and exports follow once per run, in ``awaitTermination``, and exports only if something changed since the
    last one: their row windows are not defined on a stream.
    """
    retry_failed(warehouse, landing, aliases)
    files = (
        warehouse.spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", PART_FILES)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", NO_AGE_LIMIT)
        .load(landing)
        .select("path", "modificationTime")
    )

    def load_batch(batch: DataFrame, _: int) -> None:
        file_name, changed = calendar.report_name_of(F.col("path")).alias("file_name"), F.unix_micros("modificationTime").alias("changed")
        parts = batch.select("path", file_name, changed).where("file_name != ''").collect()  # max_files at most
        read = {(row["file_name"], row["path"]): row["seq"] for row in warehouse.parts_read(sorted({row["file_name"] for row in parts})).collect()}
        new = {row["file_name"] for row in parts if read.get((row["file_name"], place(row["path"])), 0) <= row["changed"]}
        reports = [report for report in collect_reports(reports_of_files(batch)) if report.file_name in new]
        if reports:
            load_reports(warehouse, reports, aliases)

    query = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return StreamRun(query, lambda: publish(warehouse, export_folder, only_changes=True))


def retry_failed(warehouse: Warehouse, landing: str, aliases: dict[str, str] | None = None) -> LoadResult | None:
    """Loads the reports in the landing folder whose last result is a failure."""
    failed = warehouse.ledger().where(F.col("status") == STATUS_FAILED).select("file_name")
    reports = collect_reports(list_reports(warehouse.spark, landing).join(failed, "file_name", "left_semi"))
    return load_reports(warehouse, reports, aliases) if reports else None
