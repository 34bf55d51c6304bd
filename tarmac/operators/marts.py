"""The eight delay views.

Each aggregated view is written once, over *additive measures*: counts and sums
per group. A measure frame is either

* ``flight_measures(flights)``: one row per flight, a projection that Catalyst
  folds into the scan and the partial aggregation, or
* ``month_summary(flights)``: the same columns summed by month, airline and
  route. It is stored, refreshed only for the months that changed, and every
  view rolls up from it instead of reading the flights again.

Averages are not additive, so the measures hold sums and non-null counts. The
rolling metrics are windows over the monthly aggregate, never over flights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.schema import CAUSES

#: groups of the stored summary; the last two are what the views filter on
SUMMARY_KEYS = ["year", "month", "airline", "route", "origin", "dest", "cancelled", "has_cause"]

BASE_COLUMNS = [
    "flight_date", "airline", "flight_number", "origin", "dest", "distance", "dep_delay",
    "arr_delay", "arr_del15", "cancelled", "diverted", "route",
]


def operated(flights: DataFrame) -> DataFrame:
    """Flights that were not cancelled; diverted ones stay in."""
    return flights.where(C.is_operated())


def flights_base(flights: DataFrame) -> DataFrame:
    return operated(flights).select(*BASE_COLUMNS)


# --- additive measures ------------------------------------------------------

def flight_measures(flights: DataFrame) -> DataFrame:
    """One measure row per flight. Averages skip NULLs, so each sum has its own count."""
    averaged = ["dep_delay", "arr_delay", *CAUSES]
    sums = [f"{c} AS {c}_sum" for c in averaged]
    counts = [f"bigint({c} IS NOT NULL) AS {c}_n" for c in averaged]
    keyed = flights.withColumn("has_cause", C.has_delay_cause())
    return keyed.selectExpr(*SUMMARY_KEYS, "1L AS flights", "bigint(arr_del15) AS late", *sums, *counts)


def month_summary(flights: DataFrame) -> DataFrame:
    """Measures by month, airline and route: the stored base of all views."""
    measures = flight_measures(flights)
    sums = [F.sum(name).alias(name) for name in measures.columns if name not in SUMMARY_KEYS]
    return measures.groupBy(*SUMMARY_KEYS).agg(*sums)


def _mean(name: str) -> Column:
    return F.expr(f"try_divide(sum({name}_sum), double(sum({name}_n)))")


# --- grouped views ----------------------------------------------------------

def _delay_stats(measures: DataFrame, *keys: str) -> DataFrame:
    return operated(measures).groupBy(*keys).agg(
        F.sum("flights").alias("n_flights"),
        _mean("arr_delay").alias("avg_arr_delay"),
        _mean("dep_delay").alias("avg_dep_delay"),
        C.ratio(F.sum("late"), F.sum("flights")).alias("pct_arr_del15"),
    )


def airline_delay_stats(measures: DataFrame) -> DataFrame:
    return _delay_stats(measures, "airline")


def route_delay_stats(measures: DataFrame) -> DataFrame:
    return _delay_stats(measures, "route", "origin", "dest")


def _mean_delays(measures: DataFrame, *keys: str) -> DataFrame:
    return operated(measures).groupBy(*keys).agg(
        _mean("arr_delay").alias("avg_arr_delay"), F.sum("flights").alias("n_flights")
    )


def monthly_delays(measures: DataFrame) -> DataFrame:
    return _mean_delays(measures, "year", "month")


def airline_month(measures: DataFrame) -> DataFrame:
    """Mean arrival delay and flights by month and airline: base of both window views."""
    return _mean_delays(measures, "year", "month", "airline")


def delay_causes_by_airline(measures: DataFrame) -> DataFrame:
    """Mean minutes per cause over operated flights delayed by at least one of them."""
    return operated(measures).where("has_cause").groupBy("airline").agg(
        F.sum("flights").alias("n_delayed_flights"),
        *[_mean(cause).alias(f"avg_{cause}") for cause in CAUSES],
    )


def airport_delay_stats(measures: DataFrame, true_rate: bool = False) -> DataFrame:
    """Departures by origin, cancelled ones included.

    ``cancellation_rate`` counts cancelled flights twice in its denominator, as
    the published figures do; ``true_rate`` adds the share of departures.
    """
    departures, cancelled = F.sum("flights"), F.sum(F.col("cancelled") * F.col("flights"))
    rates = [C.ratio(cancelled, departures + cancelled).alias("cancellation_rate")]
    if true_rate:
        rates.append(C.ratio(cancelled, departures).alias("cancellation_rate_true"))
    return measures.groupBy(F.col("origin").alias("airport")).agg(
        departures.alias("n_departures"),
        _mean("dep_delay").alias("avg_dep_delay"),
        C.ratio(F.sum("late"), departures).alias("pct_arr_del15"),
        *rates,
    )


# --- window views -----------------------------------------------------------

def last_three_months():
    """Current and two preceding *rows* of an airline; a month without flights is skipped over."""
    return W.partitionBy("airline").orderBy("year", "month").rowsBetween(-2, W.currentRow)


def airline_rolling_metrics(measures: DataFrame) -> DataFrame:
    """Mean of up to three monthly means (not weighted by flights), and their flights."""
    w = last_three_months()
    return airline_month(measures).select(
        "year", "month", "airline", "avg_arr_delay",
        F.avg("avg_arr_delay").over(w).alias("rolling_3mo_avg_delay"),
        F.sum("n_flights").over(w).alias("rolling_3mo_flights"),
    )


def airline_vs_month_avg(measures: DataFrame) -> DataFrame:
    """Distance of each airline from the unweighted mean over airlines of the month."""
    month_avg = F.avg("avg_arr_delay").over(W.partitionBy("year", "month"))
    return airline_month(measures).select(
        "year", "month", "airline",
        F.col("avg_arr_delay").alias("airline_avg_delay"),
        month_avg.alias("month_avg_delay"),
        (F.col("avg_arr_delay") - month_avg).alias("delay_vs_month_avg"),
    )


#: view name -> function of a measure frame, in export order
MEASURE_VIEWS = {
    "v_airline_rolling_metrics": airline_rolling_metrics,
    "v_airline_delay_stats": airline_delay_stats,
    "v_monthly_delays": monthly_delays,
    "v_airline_vs_month_avg": airline_vs_month_avg,
    "v_delay_causes_by_airline": delay_causes_by_airline,
    "v_route_delay_stats": route_delay_stats,
    "v_airport_delay_stats": airport_delay_stats,
}
