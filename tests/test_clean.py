import io

import pandas as pd
import pytest
from flight_rows import raw_row
from pyspark.sql import functions as F

from tarmac.operators import clean
from tarmac.schema import ADDED_COLUMNS, NA_TOKENS, RAW_TO_CLEAN, REPORT_SCHEMA


def text_rows(spark, rows, overflow=None):
    names = list(RAW_TO_CLEAN.values())
    data = [tuple(None if row[raw] is None else str(row[raw]) for raw in RAW_TO_CLEAN) + (overflow,) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in [*names, "_overflow"]))


def test_missing_delays_become_zero_and_flags_ints(spark):
    blank = {c: "" for c in ["DEP_DELAY", "ARR_DELAY", "ARR_DEL15", "CARRIER_DELAY", "OP_CARRIER_FL_NUM"]}
    row = clean.clean_reports(text_rows(spark, [raw_row(**blank)])).first()
    assert (row.dep_delay, row.arr_delay, row.arr_del15, row.carrier_delay) == (0.0, 0.0, 0, 0.0)
    assert row.flight_number == -99
    assert clean.clean_reports(text_rows(spark, [raw_row()])).first().arr_del15 == 1


@pytest.mark.parametrize("token", ["NA", "N/A", "null", "NaN", ""])
def test_missing_tokens_and_route(spark, token):
    row = clean.clean_reports(text_rows(spark, [raw_row(ORIGIN=token)])).first()
    assert row.origin is None and row.route is None and row.dest == "LAX"
    assert clean.clean_reports(text_rows(spark, [raw_row()])).first().route == "JFK-LAX"


def test_tokens_are_those_pandas_treats_as_missing():
    read = pd.read_csv(io.StringIO("a,b\n" + "".join(f'"{t}",1\n' for t in NA_TOKENS)))
    assert read["a"].isna().all()


def test_text_that_is_not_a_token_stays(spark):
    assert clean.clean_reports(text_rows(spark, [raw_row(ORIGIN="NAN1")])).first().origin == "NAN1"


@pytest.mark.parametrize(
    "change, bad",
    [
        ({}, False),
        ({"CANCELLED": ""}, True),
        ({"DIVERTED": "NA"}, True),
        ({"ARR_DEL15": "abc"}, True),
        ({"ARR_DEL15": ""}, False),
        ({"ARR_DEL15": "inf"}, True),
        ({"DISTANCE": ""}, False),
        ({"DISTANCE": "far"}, True),
        ({"OP_CARRIER_FL_NUM": ""}, False),
        ({"OP_CARRIER_FL_NUM": "12X"}, True),
        ({"DEP_DELAY": " 5.00"}, False),
        ({"DEP_DELAY": "5d"}, True),
        ({"OP_CARRIER_FL_NUM": "12f"}, True),
        ({"DISTANCE": "0x1p3"}, True),
        ({"DISTANCE": "1e2"}, False),
        ({"DEP_DELAY": "-.5"}, False),
    ],
)
def test_bad_rows(spark, change, bad):
    rows = text_rows(spark, [raw_row(**change)])
    assert clean.parse_text_rows(rows, bad="bad").first().bad is bad


def test_more_fields_than_the_header_is_bad(spark):
    rows = text_rows(spark, [raw_row()], overflow="x")
    assert clean.parse_text_rows(rows, bad="bad").first().bad


def test_route_is_added_or_backfilled(spark):
    df = spark.createDataFrame([("A", "B", None), ("A", "B", "kept"), (None, "B", None)], "origin string, dest string, route string")
    assert [r.route for r in clean.add_route(df).collect()] == ["A-B", "kept", None]
    assert clean.add_route(df.drop("route")).first().route == "A-B"


def test_older_tables_get_the_later_columns(spark):
    old = spark.createDataFrame([(1,)], "year int")
    grown = clean.add_missing_columns(old)
    assert grown.columns == ["year", *ADDED_COLUMNS]
    types = {f.name: f.dataType for f in REPORT_SCHEMA.fields}
    assert all(grown.schema[c].dataType == types[c] for c in ADDED_COLUMNS)
    assert clean.add_missing_columns(grown).columns == grown.columns


def test_frames_are_appended_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    c = spark.createDataFrame([(3,)], "n int")
    rows = clean.union_by_name([a, b, c]).orderBy("n").collect()
    assert [(r.n, r.s) for r in rows] == [(1, "x"), (2, "y"), (3, None)]
    assert clean.union_by_name([a, b]).where(F.col("s") == "y").first().n == 2


def test_plain_numbers_skip_the_pattern_without_changing_its_verdict(spark):
    texts = ["1", "-1.50", "+.5", "1.", ".", "+", "1.2.3", "1-2", "--1", "+-1", " 7 ", "\x017", "1e2", "5d", "0x1p3", "inf", "\u0665"]
    found = spark.createDataFrame([(t,) for t in texts], "distance string")
    plain = found.selectExpr(f"ltrim('{clean.PLAIN}', distance) = '' AS plain", f"distance RLIKE '{clean.NUMBER}' AS number", f"{clean._parsed('distance')} AS parsed").collect()
    assert [r.parsed is not None for r in plain] == [r.number for r in plain] and sum(r.plain for r in plain) == 10


def test_one_odd_field_changes_no_other(spark):
    """Numbers are looked at together; a row with an odd one is read field by field, with the same results."""
    odd = ["", "NA", "1e2", " 7 ", "5d", "1,2", ",", "\n", "-1.#IND"]
    rows = [raw_row()] + [raw_row(DISTANCE=text) for text in odd] + [raw_row(DISTANCE=None), raw_row(LATE_AIRCRAFT_DELAY="")]
    parsed = clean.parse_text_rows(text_rows(spark, rows), bad="bad").collect()
    assert [r.distance for r in parsed] == [2475.0, None, None, 100.0, 7.0, None, None, None, None, None, None, 2475.0]
    assert [r.bad for r in parsed] == [False, False, False, False, False, True, True, True, True, False, False, False]
    assert {(r.year, r.arr_delay, r.nas_delay, r.cancelled) for r in parsed} == {(2025, 20.0, 0.0, 0)} and parsed[-1].late_aircraft_delay is None
    assert [f for f in clean.parse_text_rows(text_rows(spark, rows)).columns if f.startswith("_")] == ["_overflow"]


def test_the_numbers_of_a_row_are_matched_once(spark):
    """Each field had its own walk over its characters."""
    plan = clean.parse_text_rows(text_rows(spark, [raw_row()]), bad="bad")._jdf.queryExecution().optimizedPlan().toString()
    assert "ltrim" not in plan and "trimleading" not in plan.lower() and plan.count("concat_ws") == 1
