"""Physical plans: what reaches the scan, and what must not appear."""

import pytest
from flight_rows import month_rows, write_report

from tarmac.operators import marts, training
from tarmac.operators.features import airline_month_features
from tarmac.plans.ingest import ingest
from tarmac.sources import reports as R


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString("formatted"))


@pytest.fixture
def flights(warehouse, landing):
    for month in (1, 2):
        write_report(landing, 2025, month, month_rows(3))
    ingest(warehouse, landing, (2025, 1), (2025, 2))
    return warehouse.flights()


def test_filters_and_columns_reach_the_scan(flights):
    text = formatted(marts.airline_delay_stats(marts.flight_measures(flights)))
    assert "EqualTo(cancelled,0)" in text
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert schema == "ReadSchema: struct<airline:string,dep_delay:double,arr_delay:double,arr_del15:int,cancelled:int>"
    causes = formatted(marts.delay_causes_by_airline(marts.flight_measures(flights)))
    assert "GreaterThan(carrier_delay,0.0)" in causes and "Or(" in causes
    rows = formatted(training.training_rows(flights, year=2025))
    assert "PartitionFilters" in rows and "year" in rows.split("PartitionFilters")[1].splitlines()[0]
    assert "IsNotNull(airline)" in rows


def test_exchanges(flights):
    measures = marts.flight_measures(flights)
    assert plan(marts.airline_delay_stats(measures)).count("Exchange") == 1
    assert plan(marts.airline_rolling_metrics(measures)).count("Exchange") == 2
    assert plan(airline_month_features(flights)).count("Exchange") == 2
    assert "Exchange" not in plan(marts.flights_base(flights))


def test_no_product_and_no_python_in_the_views(flights):
    measures = marts.flight_measures(flights)
    for name, view in marts.MEASURE_VIEWS.items():
        text = plan(view(measures))
        assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text, name


def test_loading_does_not_shuffle_rows(spark, landing):
    from tarmac.operators import clean

    path = write_report(landing, 2025, 1, month_rows(3))
    report = R.Report(path, "2025_01_Report.csv", 2025, 1)
    text = R.read_text_rows(spark, R.read_headers(spark, [report]))
    assert "Exchange" not in plan(clean.clean_reports(text))
    listing = R.list_reports(spark, landing)
    assert "content" not in plan(listing)
