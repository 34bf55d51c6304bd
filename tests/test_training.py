import pytest
from flight_rows import make_flights
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from tarmac.operators import encoding, ledger, training
from tarmac.plans.train import train_and_evaluate
from tarmac.schema import OPTIONAL_FEATURES
from tarmac.sources import tpch_flights as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flights(spark):
    return T.flights(spark, SF).persist()


@pytest.fixture(scope="module")
def result(flights):
    return train_and_evaluate(flights, n_trees=5, max_depth=5)


def test_predictions(result, flights):
    p = result.predictions
    assert p.columns == [
        "airline", "origin", "dest", "distance", "month", "dep_delay", "day_of_week", "carrier_delay", "weather_delay",
        "nas_delay", "security_delay", "late_aircraft_delay", "actual_arr_del15", "predicted_arr_del15",
        "delay_probability", "airline_value", "origin_value", "dest_value",
    ]
    operated = flights.where("cancelled = 0").count()
    summary = result.summary.first()
    assert summary.train_size + summary.test_size == operated and p.count() == summary.test_size
    late = flights.where("cancelled = 0").agg(F.avg("arr_del15")).first()[0]
    assert summary.delay_rate == pytest.approx(late)
    assert p.where("delay_probability not between 0 and 1").isEmpty()
    assert dict(p.dtypes)["airline"] == "int"


def test_the_model_learns(result):
    assert result.roc_auc().first().roc_auc > 0.95
    report = {r.label: r for r in result.classification_report().collect()}
    assert report["accuracy"].f1_score > 0.9
    matrix = result.confusion_matrix().collect()
    assert sum(r["Predicted On Time"] + r["Predicted Delayed"] for r in matrix) == result.predictions.count()


def test_importance(result):
    rows = result.importance.collect()
    assert len(rows) == 12 and sum(r.importance for r in rows) == pytest.approx(1)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_export(spark, result, tmp_path):
    result.export(str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "delay_predictions"))
    assert back.columns == result.predictions.columns[:15] and back.count() == result.predictions.count()
    assert spark.read.option("header", True).csv(str(tmp_path / "feature_importance")).count() == 12


def test_one_seed_gives_one_forest(flights):
    """Whatever the partitions and the order of rows, on which the number of cores has an influence."""
    year = flights.where("year = 1997")
    a, b = (
        train_and_evaluate(rows, n_trees=3, max_depth=4).predictions
        for rows in (year.repartition(2), year.repartition(7, "origin").sortWithinPartitions(F.desc("flight_number")))
    )
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_before_departure_only_and_codes_from_the_training_part(flights):
    small = train_and_evaluate(flights, year=1997, n_trees=2, max_depth=3, pre_departure=True, encode_on="train")
    assert {r.feature for r in small.importance.collect()} == {"airline", "origin", "dest", "distance", "month", "day_of_week"}


def test_codes_follow_sorted_values_and_can_be_reused(spark, tmp_path):
    df = spark.createDataFrame([("B", "x", "p"), ("A", "y", "p"), ("C", "x", "q")], "airline string, origin string, dest string")
    encoder = encoding.fit_encoder(df)
    assert {r.airline: r.airline_code for r in encoding.encode(df, encoder).collect()} == {"A": 0.0, "B": 1.0, "C": 2.0}
    encoder.save(str(tmp_path / "encoder"))
    again = StringIndexerModel.load(str(tmp_path / "encoder"))
    new = spark.createDataFrame([("C", "y", "q")], df.schema)
    assert encoding.encode(new, again).first().airline_code == 2.0
    with pytest.raises(Exception, match="Unseen label"):
        encoding.encode(spark.createDataFrame([("Z", "y", "q")], df.schema), again).collect()
    keep = encoding.fit_encoder(df, on_unseen="keep")
    assert encoding.encode(spark.createDataFrame([("Z", "y", "q")], df.schema), keep).first().airline_code == 3.0


def test_training_rows(spark):
    flights = make_flights(spark, [{}, {"cancelled": 1}, {"year": 2024}, {"origin": None}])
    assert training.training_rows(flights).count() == 2
    assert training.training_rows(flights, year=2024).count() == 1


def test_absent_optional_features_are_left_out(spark):
    flights = make_flights(spark, [{}]).drop("day_of_week", "nas_delay")
    features = training.available_features(flights)
    assert "day_of_week" not in features and "nas_delay" not in features
    assert len(features) == 6 + len(OPTIONAL_FEATURES) - 2
    assert training.training_rows(flights).count() == 1


def test_balanced_weights(spark):
    assert training.balanced_weights({0: 30, 1: 10}) == {0: 40 / 60, 1: 2.0}
    rows = training.class_weights(spark, {1: 10, 0: 30}).collect()
    assert [(r.arr_del15, r.n_rows) for r in rows] == [(0, 30), (1, 10)]


def test_a_loaded_encoder_gives_the_same_codes_and_refuses_others(spark, tmp_path):
    learned = make_flights(spark, [{"airline": a, "origin": o, "dest": "LAX"} for a, o in [("B", "SEA"), ("A", "JFK"), ("C", "JFK")]])
    later = make_flights(spark, [{"airline": "C", "origin": "SEA", "dest": "LAX"}, {"airline": "A", "origin": "JFK", "dest": "LAX"}])
    strange = make_flights(spark, [{"airline": "Z", "origin": "SEA", "dest": "LAX"}])
    for on_unseen in ("error", "keep"):
        path = str(tmp_path / on_unseen)
        encoding.save_encoder(encoding.fit_encoder(learned, on_unseen=on_unseen), spark, path)
        loaded = encoding.load_encoder(spark, path)
        assert {(r.airline, r.airline_code, r.origin_code, r.dest_code) for r in encoding.encode(later, loaded).collect()} == {("C", 2, 1, 0), ("A", 0, 0, 0)}
        if on_unseen == "keep":
            assert encoding.encode(strange, loaded).first().airline_code == 3
        else:
            with pytest.raises(Exception, match="Unseen label"):
                encoding.encode(strange, loaded).collect()
    codes = spark.read.parquet(str(tmp_path / "error"))
    codes.where("not (column = 'airline' and code = 1)").write.parquet(str(tmp_path / "gap"))
    codes.where("column != 'dest'").write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="gaps"):
        encoding.load_encoder(spark, str(tmp_path / "gap"))
    with pytest.raises(ValueError, match="no codes of dest"):
        encoding.load_encoder(spark, str(tmp_path / "short"))


def test_log_times_are_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found = spark.range(1).select(ledger.time_text(F.timestamp_seconds(F.lit(1_700_000_000))).alias("t")).first().t
            assert found == "2023-11-14 22:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
