"""Per-airline-month feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators.marts import last_three_months, operated
from tarmac.schema import FEATURES_SCHEMA

KEYS = ["year", "month", "airline"]


def airline_month_features(flights: DataFrame) -> DataFrame:
    """Monthly delay statistics per airline, with a rolling mean over three full months.

    Unlike the views, rows without a key are left out, lateness is a percentage
    and the rolling mean is NULL until an airline has three monthly rows.
    """
    monthly = (
        operated(flights)
        .select(*KEYS, "dep_delay", "arr_delay", "arr_del15")
        .where(C.all_present(KEYS))
        .groupBy(*KEYS)
        .agg(
            F.count("arr_delay").alias("n_flights"),
            F.avg("arr_delay").alias("avg_arr_delay"),
            F.stddev_samp("arr_delay").alias("std_arr_delay"),
            F.avg("dep_delay").alias("avg_dep_delay"),
            F.sum("arr_del15").alias("n_late"),
        )
    )
    w = last_three_months()
    rolling = F.when(F.count("avg_arr_delay").over(w) == 3, F.avg("avg_arr_delay").over(w))
    return monthly.withColumns({
        "pct_arr_del15": C.ratio(F.col("n_late"), F.col("n_flights")) * 100,
        "rolling_3mo_avg_delay": rolling,
    }).select(*FEATURES_SCHEMA.names)
