"""Checks of tables, and of the invariants that tie the marts together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.schema import ZERO_FILLED


def tables_exist(spark: SparkSession, names: list[str]) -> dict[str, bool]:
    return {name: spark.catalog.tableExists(name) for name in names}


def missing_columns(spark: SparkSession, table: str, expected: list[str]) -> list[str]:
    """Expected columns (or partition columns) the table does not have."""
    found = {column.name for column in spark.catalog.listColumns(table)}
    return [name for name in expected if name not in found]


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """(rows, checksum), equal for equal contents in any order."""
    checksum = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    row = df.agg(F.count("*").alias("n"), checksum.alias("checksum")).first()
    return row["n"], int(row["checksum"] or 0)


def flight_checks(flights: DataFrame, expected_columns: list[str]) -> DataFrame:
    """``(check_name, passed, n)``: one aggregation over the flights, ``n`` counts what the check saw."""
    absent = len(set(expected_columns) - set(flights.columns))

    op = C.is_operated()
    caused = op & C.has_delay_cause()
    unfilled = F.lit(False)
    for c in [*ZERO_FILLED, "flight_number"]:
        unfilled = unfilled | F.col(c).isNull()
    counts = {
        "rows": F.count("*"),
        "unfilled": F.count_if(unfilled),
        "operated": F.count_if(op),
        "cancelled": F.coalesce(F.sum("cancelled"), F.lit(0)),
        "late": F.coalesce(F.sum("arr_del15"), F.lit(0)),
        "late_operated": F.coalesce(F.sum(F.when(op, F.col("arr_del15"))), F.lit(0)),
        "caused": F.count_if(caused),
        "routed": F.count_if(F.col("route").isNotNull()),
        "both_ends": F.count_if(F.col("origin").isNotNull() & F.col("dest").isNotNull()),
    }
    seen = flights.agg(*[v.cast("long").alias(k) for k, v in counts.items()])
    c = F.col
    checks = [
        ("has rows", c("rows") > 0, c("rows")),
        ("expected columns are present", F.lit(absent == 0), F.lit(absent).cast("long")),
        ("delays are filled", c("unfilled") == 0, c("unfilled")),
        ("departures are operated or cancelled", c("operated") + c("cancelled") == c("rows"), c("cancelled")),
        ("cancelled flights are not late", c("late") == c("late_operated"), c("late")),
        ("late flights are those with a cause", c("caused") == c("late_operated"), c("caused")),
        ("routes have both ends", c("routed") == c("both_ends"), c("routed")),
    ]
    rows = [F.struct(F.lit(k).alias("check_name"), ok.alias("passed"), n.alias("n")) for k, ok, n in checks]
    return seen.select(F.inline(F.array(*rows)))
