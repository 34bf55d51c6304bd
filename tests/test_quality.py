from flight_rows import make_flights, month_rows, write_report

from tarmac.operators import quality
from tarmac.plans import pipeline, views
from tarmac.schema import FLIGHTS_PARTITIONS, RAW_TO_CLEAN


def test_tables_and_views_after_a_run(spark, warehouse, landing, tmp_path):
    write_report(landing, 2025, 1, month_rows(3))
    exports = str(tmp_path / "exports")
    pipeline.run(warehouse, landing, (2025, 1), (2025, 1), export_folder=exports)
    pipeline.build_features(warehouse)
    names = ["flights", "ingested_files", "airline_month_features", "v_flights_base", "v_route_delay_stats"]
    assert all(quality.tables_exist(spark, names).values())
    assert quality.tables_exist(spark, ["nothing"]) == {"nothing": False}
    assert quality.missing_columns(spark, "flights", [*RAW_TO_CLEAN.values(), *FLIGHTS_PARTITIONS, "route"]) == []
    assert quality.missing_columns(spark, "flights", ["tail"]) == ["tail"]

    back = spark.read.option("header", True).csv(f"{exports}/airline_delay_stats")
    assert back.columns == ["airline", "n_flights", "avg_arr_delay", "avg_dep_delay", "pct_arr_del15"]
    assert back.first().n_flights == "3"

    query = "SELECT airline FROM flights WHERE flight_number = ? AND origin = ?"
    assert views.select(spark, query, [1, "JFK"]).count() == 1
    assert views.select(spark, "SELECT * FROM v_airline_delay_stats WHERE n_flights > :n", {"n": 5}).isEmpty()
    assert views.preview(warehouse.flights(), 2).count() == 2
    assert warehouse.features().first().n_flights == 3
    pipeline.build_features(warehouse)
    assert warehouse.features().count() == 1


def test_exports_follow_new_months_unless_told_not_to(spark, warehouse, landing, tmp_path):
    exports = str(tmp_path / "exports")

    def flights_exported():
        return int(spark.read.option("header", True).csv(f"{exports}/airline_delay_stats").first().n_flights)

    for month in (1, 2, 3):
        write_report(landing, 2025, month, month_rows(2))
    pipeline.run(warehouse, landing, (2025, 1), (2025, 1), exports)
    pipeline.run(warehouse, landing, (2025, 2), (2025, 2), exports, overwrite_exports=False)
    assert flights_exported() == 2
    pipeline.run(warehouse, landing, (2025, 3), (2025, 3), exports)
    assert flights_exported() == 6


def test_checks_see_what_is_wrong(spark):
    good = {r.check_name: r.passed for r in quality.flight_checks(make_flights(spark, [{}]), ["year"]).collect()}
    assert all(good.values())
    rows = [{"arr_del15": 1, "cancelled": 1}, {"dep_delay": None}, {"carrier_delay": 3.0}]
    bad = {r.check_name: r.passed for r in quality.flight_checks(make_flights(spark, rows), ["year", "tail"]).collect()}
    assert [name for name, passed in bad.items() if not passed] == [
        "expected columns are present", "delays are filled", "cancelled flights are not late",
        "late flights are those with a cause",
    ]
    empty = {r.check_name: r.passed for r in quality.flight_checks(make_flights(spark, []), ["year"]).collect()}
    assert empty["has rows"] is False


def test_fingerprint_ignores_order(spark):
    df = make_flights(spark, [{"flight_number": i} for i in range(9)])
    assert quality.fingerprint(df) == quality.fingerprint(df.orderBy("flight_number", ascending=False))
    assert quality.fingerprint(df) != quality.fingerprint(df.limit(8))
