"""Flight-shaped rows derived from the TPC-H-like test tables.

Only used by queries, tests and benches. Join strategies are left to Catalyst
and AQE: dimension sides are broadcast only while their size allows it, and a
hot key of a sort-merge join is split by AQE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.calendar import report_name
from tarmac.operators import clean
from tarmac.schema import CAUSES, FLIGHTS_SCHEMA, RAW_TO_CLEAN, REPORT_SCHEMA
from tarmac.session import writing_session

ROW_KEY = "row_key"

#: columns read of each table; a declared schema saves reading footers up front
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string",
}

_MIX = "(l_orderkey * 7 + l_linenumber * 31 + l_partkey * 3)"
_DEP = f"CASE WHEN {_MIX} % 100 < 18 THEN 10 + (l_orderkey * 17 + l_partkey) % 127 ELSE {_MIX} % 31 - 20 END"
_ARR = "dep + (l_suppkey * 13 + l_linenumber) % 21 - 10"
_CANCELLED = "l_orderkey % 41 = 0"
_DIVERTED = "l_orderkey % 211 = 1"
_NO_ARRIVAL = f"({_CANCELLED} OR {_DIVERTED})"

#: expression of each report column over the joined tables
_COLUMNS = {
    "year": "year(l_shipdate)",
    "month": "month(l_shipdate)",
    "day": "day(l_shipdate)",
    "day_of_week": "weekday(l_shipdate) + 1",
    "flight_date": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "airline": "p_brand",
    "flight_number": "CAST(CASE WHEN l_orderkey % 97 != 0 THEN l_orderkey END AS double)",
    "origin": "concat('N', lpad(CAST(s_nationkey AS string), 2, '0'))",
    "dest": "concat('N', lpad(CAST(c_nationkey AS string), 2, '0'))",
    "distance": "CAST(100 + 137 * abs(s_nationkey - c_nationkey) AS double)",
    "dep_delay": f"CAST(CASE WHEN NOT {_CANCELLED} THEN dep END AS double)",
    "arr_delay": f"CAST(CASE WHEN NOT {_NO_ARRIVAL} THEN arr END AS double)",
    "arr_del15": f"CAST(CASE WHEN NOT {_NO_ARRIVAL} THEN int(arr >= 15) END AS double)",
    "cancelled": f"CAST({_CANCELLED} AS double)",
    "diverted": f"CAST({_DIVERTED} AND NOT {_CANCELLED} AS double)",
    **{
        cause: f"CAST(CASE WHEN NOT {_NO_ARRIVAL} AND arr >= 15 "
        f"THEN CASE WHEN l_linenumber % 5 = {i} THEN arr ELSE 0 END END AS double)"
        for i, cause in enumerate(CAUSES)
    },
}
_ROW_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS int))"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned flights: missing delays are NULL. Minutes are whole numbers."""
    lineitem, orders, customer, supplier, part = (read_table(spark, sf_dir, name) for name in TABLES)
    # customers join the orders first, so that the larger line items move one time less; those are dealt by
    # the key of that join, which a small table in one file needs to be read by more than one task
    destinations = orders.join(customer, F.expr("c_custkey = o_custkey")).select("o_orderkey", "c_nationkey")
    joined = (
        lineitem.repartition("l_orderkey")
        .join(destinations, F.expr("o_orderkey = l_orderkey"))
        .join(supplier, F.expr("s_suppkey = l_suppkey"))
        .join(part, F.expr("p_partkey = l_partkey"))
        .selectExpr("*", f"{_DEP} AS dep")
        .selectExpr("*", f"{_ARR} AS arr")
    )
    return joined.selectExpr(f"{_ROW_KEY} AS {ROW_KEY}", *[f"{_COLUMNS[c]} AS {c}" for c in REPORT_SCHEMA.names])


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned flights with their row key and the report they would come from."""
    cleaned = clean.add_route(clean.fill_missing(raw_flights(spark, sf_dir)))
    return cleaned.withColumn("source_file", report_name(F.col("year"), F.col("month"))).select(
        ROW_KEY, *FLIGHTS_SCHEMA.names
    )


def raw_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the headers of a monthly report, plus the report's name."""
    raw = raw_flights(spark, sf_dir)
    headed = raw.withColumn("file_name", report_name(F.col("year"), F.col("month"))).drop(ROW_KEY)
    return headed.withColumnsRenamed({clean_name: raw_name for raw_name, clean_name in RAW_TO_CLEAN.items()})


def write_reports(
    spark: SparkSession, sf_dir: str, landing: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows, one_part: bool = False
) -> None:
    """Writes the rows, after ``change``, as CSV reports, one folder of parts per month.

    ``rebalance`` lets AQE split a month that holds far more rows than others, unless
    a month has to be ``one_part``.
    """
    rows = change(raw_report_rows(writing_session(spark), sf_dir))
    dealt = rows.repartition("file_name") if one_part else rows.hint("rebalance", "file_name")
    (
        dealt.write.mode("overwrite")
        .options(header=True, escape='"')
        .partitionBy("file_name")
        .csv(landing)
    )
