"""Raw and clean flight rows for tests."""

import csv
import os

from tarmac.operators.clean import add_route
from tarmac.schema import FLIGHTS_SCHEMA, RAW_TO_CLEAN

DEFAULTS = {
    "YEAR": 2025, "MONTH": 1, "DAY_OF_MONTH": 1, "DAY_OF_WEEK": 3, "FL_DATE": "1/1/2025 12:00:00 AM",
    "OP_UNIQUE_CARRIER": "AA", "OP_CARRIER_FL_NUM": "100", "ORIGIN": "JFK", "DEST": "LAX", "DISTANCE": "2475.00",
    "DEP_DELAY": "5.00", "ARR_DELAY": "20.00", "ARR_DEL15": "1.00", "CANCELLED": "0.00", "DIVERTED": "0.00",
    "CARRIER_DELAY": "20.00", "WEATHER_DELAY": "0.00", "NAS_DELAY": "0.00", "SECURITY_DELAY": "0.00",
    "LATE_AIRCRAFT_DELAY": "0.00",
}


def raw_row(**values) -> dict:
    return {**DEFAULTS, **values}


def write_report(folder, year, month, rows, columns=None, name=None):
    """A monthly CSV; ``columns`` sets header and order, values are taken by name."""
    columns = columns or list(RAW_TO_CLEAN)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or f"{year}_{month:02d}_Report.csv")
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        for row in rows:
            row = {**row, "YEAR": row.get("_year", year), "MONTH": row.get("_month", month)}
            writer.writerow([row.get(c, "") for c in columns])
    return path


def month_rows(n, **values):
    return [raw_row(OP_CARRIER_FL_NUM=str(i), **values) for i in range(n)]


FLIGHT_DEFAULTS = {
    "year": 2025, "month": 1, "day": 1, "day_of_week": 3, "flight_date": "2025-01-01", "airline": "AA",
    "flight_number": 1, "origin": "JFK", "dest": "LAX", "distance": 2475.0, "dep_delay": 0.0, "arr_delay": 0.0,
    "arr_del15": 0, "cancelled": 0, "diverted": 0, "carrier_delay": 0.0, "weather_delay": 0.0, "nas_delay": 0.0,
    "security_delay": 0.0, "late_aircraft_delay": 0.0, "route": None, "source_file": "2025_01_Report.csv",
}


def make_flights(spark, rows):
    """Clean flights from partial rows."""
    full = [tuple({**FLIGHT_DEFAULTS, **row}[c] for c in FLIGHTS_SCHEMA.names) for row in rows]
    return add_route(spark.createDataFrame(full, FLIGHTS_SCHEMA))
