"""Reports to marts: load, then publish views and exports."""

from __future__ import annotations

from tarmac.functions import calendar
from tarmac.operators.features import airline_month_features
from tarmac.plans.ingest import LoadResult, ingest
from tarmac.plans.views import export_marts, register_views
from tarmac.schema import PREZIP_ALIASES
from tarmac.sources import archives
from tarmac.sources.warehouse import EXPORT, Entry, Warehouse


def publish(warehouse: Warehouse, export_folder: str | None = None, overwrite: bool = True, only_changes: bool = False) -> None:
    """Points tables and views at the current files, and exports the marts if a folder is given.

    ``only_changes`` exports only if rows or summaries changed since the last export to the folder, by whichever run.
    """
    register_views(warehouse)
    if not export_folder:
        return
    state = warehouse.state()
    if only_changes and state.exports.get(export_folder) == state.changed:
        return
    export_marts(warehouse, export_folder, overwrite)
    if overwrite:
        warehouse.commit([Entry(EXPORT, place=export_folder)])


def run(
    warehouse: Warehouse,
    landing: str,
    start: tuple[int, int],
    end: tuple[int, int],
    export_folder: str | None = None,
    rerun: bool = False,
    dry_run: bool = False,
    aliases: dict[str, str] | None = None,
    overwrite_exports: bool = True,
) -> LoadResult:
    """One incremental run over a month range."""
    loaded = ingest(warehouse, landing, start, end, rerun, dry_run, aliases)
    if not dry_run:
        publish(warehouse, export_folder, overwrite_exports)
    return loaded


def run_archive(
    warehouse: Warehouse,
    archive_folder: str,
    landing: str,
    year: int | None = None,
    month: int | None = None,
    today: str | None = None,
    export_folder: str | None = None,
    rerun: bool = False,
    dry_run: bool = False,
    aliases: dict[str, str] | None = PREZIP_ALIASES,
) -> LoadResult | None:
    """Unpacks one month's archive and loads exactly that month.

    Year and month each default to those of the month before ``today``. A dry
    run unpacks the archive but writes nothing. The landed report is kept.
    """
    default_year, default_month = calendar.default_period(warehouse.spark, today)
    period = (year or default_year, month or default_month)
    found = archives.read_archives(warehouse.spark, archive_folder, period)
    if found.select("path").isEmpty():
        raise FileNotFoundError(f"no archive for {period[0]}-{period[1]:02d} in {archive_folder}")
    if dry_run:
        archives.unpack(found, aliases).write.format("noop").mode("overwrite").save()
        return None
    archives.land(found, landing, aliases)
    return run(warehouse, landing, period, period, export_folder, rerun=rerun)


def build_features(warehouse: Warehouse) -> None:
    """Recomputes the feature table; a second run gives the same table."""
    warehouse.write_features(airline_month_features(warehouse.flights()))
