import math
import statistics

import pytest
from flight_rows import make_flights

from tarmac.operators import marts
from tarmac.operators.features import airline_month_features
from tarmac.plans import views
from tarmac.schema import CAUSES
from tarmac.sources import tpch_flights as T

SF = "/root/testdata/sf0.001"


def rows_of(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def flights(spark):
    return T.flights(spark, SF).persist()


@pytest.fixture(scope="module")
def measures(flights):
    return marts.flight_measures(flights)


def test_frames_are_rows_not_months(spark):
    flights = make_flights(spark, [{"month": m, "arr_delay": float(m)} for m in [1, 2, 5, 6]])
    got = rows_of(marts.airline_rolling_metrics(marts.flight_measures(flights)), "month")
    assert [r["rolling_3mo_avg_delay"] for r in got] == [1.0, 1.5, 8 / 3, 13 / 3]
    assert [r["rolling_3mo_flights"] for r in got] == [1, 2, 3, 3]
    features = rows_of(airline_month_features(flights), "month")
    assert [r["rolling_3mo_avg_delay"] for r in features] == [None, None, 8 / 3, 13 / 3]


def test_rolling_mean_is_not_weighted_by_flights(spark):
    rows = [{"month": 1, "arr_delay": 0.0}] * 9 + [{"month": 2, "arr_delay": 10.0}]
    got = rows_of(marts.airline_rolling_metrics(marts.flight_measures(make_flights(spark, rows))), "month")
    assert got[1]["rolling_3mo_avg_delay"] == 5.0


def test_month_average_is_over_airlines(spark):
    rows = [{"airline": "AA", "arr_delay": 0.0}] * 9 + [{"airline": "BB", "arr_delay": 10.0}]
    got = rows_of(marts.airline_vs_month_avg(marts.flight_measures(make_flights(spark, rows))), "airline")
    assert [(r["airline_avg_delay"], r["month_avg_delay"], r["delay_vs_month_avg"]) for r in got] == [
        (0.0, 5.0, -5.0), (10.0, 5.0, 5.0),
    ]


def test_cancelled_flights_count_twice_in_the_published_rate(spark):
    rows = [{"cancelled": 1 if i < 4 else 0, "arr_del15": 1 if i > 13 else 0} for i in range(17)]
    got = marts.airport_delay_stats(marts.flight_measures(make_flights(spark, rows)), true_rate=True).first()
    assert (got.airport, got.n_departures) == ("JFK", 17)
    assert got.cancellation_rate == 4 / 21 and got.cancellation_rate_true == 4 / 17
    assert got.pct_arr_del15 == 3 / 17


def test_cancelled_flights_are_not_operated_but_diverted_are(spark):
    rows = [{"cancelled": 1, "arr_delay": 90.0}, {"diverted": 1, "arr_delay": 0.0}, {"arr_delay": 4.0}]
    flights = make_flights(spark, rows)
    got = marts.airline_delay_stats(marts.flight_measures(flights)).first()
    assert (got.n_flights, got.avg_arr_delay) == (2, 2.0)
    assert marts.flights_base(flights).count() == 2
    assert marts.flights_base(flights).columns == marts.BASE_COLUMNS


def test_causes(spark):
    rows = [
        {"carrier_delay": 20.0, "arr_delay": 20.0},
        {"weather_delay": 10.0, "nas_delay": 6.0},
        {"arr_delay": 3.0},
        {"carrier_delay": 50.0, "cancelled": 1},
        {"carrier_delay": None, "nas_delay": 2.0},
    ]
    got = marts.delay_causes_by_airline(marts.flight_measures(make_flights(spark, rows))).first()
    assert got.n_delayed_flights == 3
    assert got.avg_carrier_delay == 10.0  # a missing cause is skipped, not zero
    assert got.avg_nas_delay == 8 / 3


def test_unknown_airline_is_a_group_in_views_but_not_in_features(spark):
    flights = make_flights(spark, [{"airline": None}, {"airline": "AA"}])
    assert {r.airline for r in marts.airline_delay_stats(marts.flight_measures(flights)).collect()} == {None, "AA"}
    assert [r.airline for r in airline_month_features(flights).collect()] == ["AA"]


def test_feature_values(spark):
    delays = [3.0, 8.0, 40.0]
    rows = [{"arr_delay": d, "dep_delay": d, "arr_del15": int(d >= 15)} for d in delays] + [{"month": 2}]
    got = rows_of(airline_month_features(make_flights(spark, rows)), "month")
    assert got[0]["std_arr_delay"] == pytest.approx(statistics.stdev(delays))
    assert got[0]["pct_arr_del15"] == pytest.approx(100 / 3) and got[0]["n_flights"] == 3
    assert got[1]["std_arr_delay"] is None  # one flight has no deviation


def test_views_from_the_summary_equal_views_from_flights(flights, measures):
    summary = marts.month_summary(flights)
    direct, stored = views.views(flights), views.views(flights, summary)
    assert list(direct) == ["v_flights_base", *marts.MEASURE_VIEWS]
    for name in marts.MEASURE_VIEWS:
        a, b = (sorted(map(tuple, v[name].collect()), key=repr) for v in (direct, stored))
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert all(
                math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-12) if isinstance(p, float) else p == q for p, q in zip(x, y)
            ), name


def test_totals_agree_between_views(spark, flights, measures):
    by_airline = rows_of(marts.airline_delay_stats(measures), "airline")
    by_month = rows_of(marts.monthly_delays(measures), "year", "month")
    by_airport = rows_of(marts.airport_delay_stats(measures), "airport")
    by_route = rows_of(marts.route_delay_stats(measures), "route")
    causes = {r["airline"]: r["n_delayed_flights"] for r in rows_of(marts.delay_causes_by_airline(measures), "airline")}
    operated = sum(r["n_flights"] for r in by_airline)
    assert operated == sum(r["n_flights"] for r in by_month) == sum(r["n_flights"] for r in by_route)
    cancelled = sum(r["cancellation_rate"] * r["n_departures"] / (1 - r["cancellation_rate"]) for r in by_airport)
    assert sum(r["n_departures"] for r in by_airport) == operated + round(cancelled)
    late = [sum(round(r["pct_arr_del15"] * r[n]) for r in g) for g, n in [(by_airline, "n_flights"), (by_airport, "n_departures")]]
    assert late[0] == late[1]
    for r in by_airline:
        assert round(r["n_flights"] * r["pct_arr_del15"]) == causes[r["airline"]]
        minutes = r["avg_arr_delay"] * r["n_flights"]
        assert minutes == pytest.approx(round(minutes), abs=1e-6)


def test_rolling_values_follow_from_the_monthly_ones(measures):
    got = rows_of(marts.airline_rolling_metrics(measures), "airline", "year", "month")
    base = {(r["airline"], r["year"], r["month"]): r["n_flights"] for r in rows_of(marts.airline_month(measures), "airline")}
    seen: dict = {}
    for r in got:
        history = seen.setdefault(r["airline"], [])
        history.append((r["avg_arr_delay"], base[r["airline"], r["year"], r["month"]]))
        last = history[-3:]
        assert r["rolling_3mo_avg_delay"] == pytest.approx(sum(a for a, _ in last) / len(last))
        assert r["rolling_3mo_flights"] == sum(n for _, n in last)


def test_month_average_column_is_consistent(measures):
    months: dict = {}
    got = rows_of(marts.airline_vs_month_avg(measures), "year", "month", "airline")
    for r in got:
        months.setdefault((r["year"], r["month"]), []).append(r["airline_avg_delay"])
    for r in got:
        values = months[r["year"], r["month"]]
        assert r["month_avg_delay"] == pytest.approx(sum(values) / len(values))
        assert r["delay_vs_month_avg"] == pytest.approx(r["airline_avg_delay"] - r["month_avg_delay"])


def test_every_cause_has_a_mean(measures):
    assert marts.delay_causes_by_airline(measures).columns == ["airline", "n_delayed_flights", *[f"avg_{c}" for c in CAUSES]]
