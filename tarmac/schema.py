"""Schemas and fixed values of the flight data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and tokens that must equal the input format.
# ---------------------------------------------------------------------------

#: raw report column -> name in the flights table
RAW_TO_CLEAN = {
    "YEAR": "year",
    "MONTH": "month",
    "DAY_OF_MONTH": "day",
    "DAY_OF_WEEK": "day_of_week",
    "FL_DATE": "flight_date",
    "OP_UNIQUE_CARRIER": "airline",
    "OP_CARRIER_FL_NUM": "flight_number",
    "ORIGIN": "origin",
    "DEST": "dest",
    "DISTANCE": "distance",
    "DEP_DELAY": "dep_delay",
    "ARR_DELAY": "arr_delay",
    "ARR_DEL15": "arr_del15",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "CARRIER_DELAY": "carrier_delay",
    "WEATHER_DELAY": "weather_delay",
    "NAS_DELAY": "nas_delay",
    "SECURITY_DELAY": "security_delay",
    "LATE_AIRCRAFT_DELAY": "late_aircraft_delay",
}

#: header spelling of the publisher's pre-zipped files -> raw report column
PREZIP_ALIASES = {
    "Year": "YEAR",
    "Month": "MONTH",
    "DayofMonth": "DAY_OF_MONTH",
    "DayOfWeek": "DAY_OF_WEEK",
    "FlightDate": "FL_DATE",
    "Reporting_Airline": "OP_UNIQUE_CARRIER",
    "Flight_Number_Reporting_Airline": "OP_CARRIER_FL_NUM",
    "Origin": "ORIGIN",
    "Dest": "DEST",
    "Distance": "DISTANCE",
    "DepDelay": "DEP_DELAY",
    "ArrDelay": "ARR_DELAY",
    "ArrDel15": "ARR_DEL15",
    "Cancelled": "CANCELLED",
    "Diverted": "DIVERTED",
    "CarrierDelay": "CARRIER_DELAY",
    "WeatherDelay": "WEATHER_DELAY",
    "NASDelay": "NAS_DELAY",
    "SecurityDelay": "SECURITY_DELAY",
    "LateAircraftDelay": "LATE_AIRCRAFT_DELAY",
}

#: tokens that mean "missing" in a report (the default list of pandas.read_csv)
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

#: flight_number where the report has none
NO_FLIGHT_NUMBER = -99

#: the five delay causes, in report order
CAUSES = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]

#: columns whose missing values count as zero minutes / not late
ZERO_FILLED = ["dep_delay", "arr_delay", "arr_del15", *CAUSES]

#: columns that an older flights table may lack
ADDED_COLUMNS = ["day_of_week", *CAUSES]

#: model inputs
CATEGORICAL_FEATURES = ["airline", "origin", "dest"]
BASE_FEATURES = ["distance", "month", "dep_delay"]
OPTIONAL_FEATURES = ["day_of_week", *CAUSES]
TARGET = "arr_del15"

STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

INT_COLUMNS = ["year", "month", "day", "day_of_week", "flight_number", "arr_del15", "cancelled", "diverted"]
DOUBLE_COLUMNS = ["distance", "dep_delay", "arr_delay", *CAUSES]
STRING_COLUMNS = ["flight_date", "airline", "origin", "dest"]

#: flags that have to be present on every row, or the report is rejected
REQUIRED_FLAGS = ["cancelled", "diverted"]


def _clean_type(name: str) -> T.DataType:
    if name in INT_COLUMNS:
        return T.IntegerType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    return T.StringType()


#: the 20 report columns, in report order
REPORT_SCHEMA = T.StructType([T.StructField(c, _clean_type(c)) for c in RAW_TO_CLEAN.values()])

#: the fact table; stored as Parquet partitioned by FLIGHTS_PARTITIONS
FLIGHTS_SCHEMA = T.StructType(
    REPORT_SCHEMA.fields
    + [T.StructField("route", T.StringType()), T.StructField("source_file", T.StringType())]
)
FLIGHTS_PARTITIONS = ["year", "month", "source_file"]

#: append-only load log; the current row of a file is its newest one
LEDGER_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("seq", T.LongType()),
])
LEDGER_COLUMNS = ["file_name", "year", "month", "ingested_at", "n_rows", "status"]

#: what a commit of a warehouse says, one row each; the columns of the load log hold its own rows, and names and months of the others
COMMITS_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("place", T.StringType()),
    *LEDGER_SCHEMA.fields,
])

FEATURES_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("airline", T.StringType()),
    T.StructField("n_flights", T.LongType()),
    T.StructField("avg_arr_delay", T.DoubleType()),
    T.StructField("std_arr_delay", T.DoubleType()),
    T.StructField("avg_dep_delay", T.DoubleType()),
    T.StructField("pct_arr_del15", T.DoubleType()),
    T.StructField("rolling_3mo_avg_delay", T.DoubleType()),
])
