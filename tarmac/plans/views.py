"""Named views and exports of the delay marts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import marts
from tarmac.sources.warehouse import Warehouse


def views(flights: DataFrame, measures: DataFrame | None = None) -> dict[str, DataFrame]:
    """All eight views; those that aggregate read ``measures`` (the flights if not given)."""
    if measures is None:
        measures = marts.flight_measures(flights)
    return {
        "v_flights_base": marts.flights_base(flights),
        **{name: view(measures) for name, view in marts.MEASURE_VIEWS.items()},
    }


def register_views(warehouse: Warehouse) -> None:
    """Makes tables and views available to ``spark.sql``, replacing older definitions."""
    flights = warehouse.flights()
    tables = {
        "flights": flights,
        "ingested_files": warehouse.ledger(),
        "airline_month_features": warehouse.features(),
    }
    for name, frame in {**tables, **views(flights, warehouse.summary())}.items():
        frame.createOrReplaceTempView(name)


def select(spark: SparkSession, query: str, params: list | dict | None = None) -> DataFrame:
    """A query over the registered tables and views, with bound parameters."""
    return spark.sql(query, args=params)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """Some rows; reads no more of the table than it takes to find them."""
    return df.limit(rows)


def export_csv(df: DataFrame, path: str, overwrite: bool = True, single_file: bool = False) -> None:
    """Writes a CSV folder with a header.

    ``single_file`` is for marts, whose size is bounded by airlines, airports,
    routes and months: ``repartition(1)`` moves the finished rows only, while
    the aggregation before it stays parallel. Without ``overwrite`` an existing
    export is left alone.
    """
    frame = df.repartition(1) if single_file else df
    frame.write.mode("overwrite" if overwrite else "ignore").option("header", True).csv(path)


def export_marts(warehouse: Warehouse, folder: str, overwrite: bool = True) -> None:
    """The seven exported views, all from the stored summary; small jobs that run side by side."""
    summary = warehouse.summary()

    def export(name: str) -> None:
        view = marts.MEASURE_VIEWS[name](summary)
        export_csv(view, f"{folder}/{name.removeprefix('v_')}", overwrite, single_file=True)

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(export, marts.MEASURE_VIEWS))
