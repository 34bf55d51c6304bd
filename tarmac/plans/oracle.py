"""The catalogue's queries as SQL for a second engine (DuckDB).

Forest outputs have no SQL; they are checked for rows only.
"""

from __future__ import annotations

from tarmac.schema import CAUSES

_RAW = """
flights_raw AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS row_key,
    CAST(year(l_shipdate) AS INT) AS year,
    CAST(month(l_shipdate) AS INT) AS month,
    CAST(day(l_shipdate) AS INT) AS day,
    CAST(isodow(l_shipdate) AS INT) AS day_of_week,
    strftime(l_shipdate, '%Y-%m-%d') AS flight_date,
    p_brand AS airline,
    CAST(CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey END AS DOUBLE) AS flight_number,
    concat('N', lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS origin,
    concat('N', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS dest,
    CAST(100 + 137 * abs(s_nationkey - c_nationkey) AS DOUBLE) AS distance,
    CAST(CASE WHEN cx THEN NULL ELSE dep END AS DOUBLE) AS dep_delay,
    CAST(CASE WHEN cx OR dv THEN NULL ELSE arr END AS DOUBLE) AS arr_delay,
    CAST(CASE WHEN cx OR dv THEN NULL WHEN arr >= 15 THEN 1 ELSE 0 END AS DOUBLE) AS arr_del15,
    CAST(CASE WHEN cx THEN 1 ELSE 0 END AS DOUBLE) AS cancelled,
    CAST(CASE WHEN dv AND NOT cx THEN 1 ELSE 0 END AS DOUBLE) AS diverted,
    CAST(CASE WHEN cx OR dv OR arr < 15 THEN NULL WHEN cause = 0 THEN arr ELSE 0 END AS DOUBLE) AS carrier_delay,
    CAST(CASE WHEN cx OR dv OR arr < 15 THEN NULL WHEN cause = 1 THEN arr ELSE 0 END AS DOUBLE) AS weather_delay,
    CAST(CASE WHEN cx OR dv OR arr < 15 THEN NULL WHEN cause = 2 THEN arr ELSE 0 END AS DOUBLE) AS nas_delay,
    CAST(CASE WHEN cx OR dv OR arr < 15 THEN NULL WHEN cause = 3 THEN arr ELSE 0 END AS DOUBLE) AS security_delay,
    CAST(CASE WHEN cx OR dv OR arr < 15 THEN NULL WHEN cause = 4 THEN arr ELSE 0 END AS DOUBLE) AS late_aircraft_delay
  FROM (
    SELECT *, dep + (l_suppkey * 13 + l_linenumber) % 21 - 10 AS arr
    FROM (
      SELECT *,
        CASE WHEN (l_orderkey * 7 + l_linenumber * 31 + l_partkey * 3) % 100 < 18
             THEN 10 + (l_orderkey * 17 + l_partkey) % 127
             ELSE (l_orderkey * 7 + l_linenumber * 31 + l_partkey * 3) % 31 - 20 END AS dep,
        l_orderkey % 41 = 0 AS cx, l_orderkey % 211 = 1 AS dv, l_linenumber % 5 AS cause
      FROM lineitem
      JOIN orders   ON o_orderkey = l_orderkey
      JOIN customer ON c_custkey  = o_custkey
      JOIN supplier ON s_suppkey  = l_suppkey
      JOIN part     ON p_partkey  = l_partkey) a) b)"""

_FLIGHTS = f"""{_RAW},
flights AS (
  SELECT row_key, year, month, day, day_of_week, flight_date, airline,
    CAST(coalesce(flight_number, -99) AS INT) AS flight_number, origin, dest, distance,
    coalesce(dep_delay, 0) AS dep_delay, coalesce(arr_delay, 0) AS arr_delay,
    CAST(coalesce(arr_del15, 0) AS INT) AS arr_del15,
    CAST(cancelled AS INT) AS cancelled, CAST(diverted AS INT) AS diverted,
    coalesce(carrier_delay, 0) AS carrier_delay, coalesce(weather_delay, 0) AS weather_delay,
    coalesce(nas_delay, 0) AS nas_delay, coalesce(security_delay, 0) AS security_delay,
    coalesce(late_aircraft_delay, 0) AS late_aircraft_delay,
    origin || '-' || dest AS route,
    printf('%d_%02d_Report.csv', year, month) AS source_file
  FROM flights_raw)"""


def _over_flights(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([_FLIGHTS.strip(), *ctes])}\n{body.strip()}"


_AIRLINE_MONTH = """
airline_month AS (
  SELECT year, month, airline, avg(arr_delay) AS a, count(*) AS n
  FROM flights WHERE cancelled = 0 GROUP BY year, month, airline)"""

_STATS = """count(*) AS n_flights, round(avg(arr_delay), 6) AS avg_arr_delay,
  round(avg(dep_delay), 6) AS avg_dep_delay,
  round(CAST(sum(arr_del15) AS DOUBLE) / count(*), 6) AS pct_arr_del15"""

_ANY_CAUSE = "(" + " OR ".join(f"{c} > 0" for c in CAUSES) + ")"
_AVERAGED = ["dep_delay", "arr_delay", *CAUSES]
_FRAME = "(PARTITION BY airline ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"

_AXIS = """
ends AS (SELECT date_trunc('month', min(l_shipdate)) AS a,
                date_trunc('month', max(l_shipdate)) - INTERVAL 1 MONTH AS b FROM lineitem),
months AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m, a, b FROM ends),
axis AS (SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
                printf('%d_%02d_Report.csv', year(m), month(m)) AS file_name,
                CAST(datediff('month', a, b) + 1 AS INT) AS n_months FROM months)"""

_EVENTS = """
days AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1),
events AS (
  SELECT printf('%d_%02d_Report.csv', year(d), month(d)) AS file_name,
    CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, d AS ingested_at,
    CASE WHEN (day(d) * 7 + month(d)) % 3 = 0 THEN 0 ELSE n END AS n_rows,
    CASE WHEN (day(d) * 7 + month(d)) % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
    day(d) AS seq
  FROM days)"""

_LEDGER_COLUMNS = """file_name, year, month, strftime(ingested_at, '%Y-%m-%d') AS ingested_at,
  CAST(n_rows AS BIGINT) AS n_rows, status"""


def _newest(where: str = "TRUE") -> str:
    return f"""
ledger AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY ingested_at DESC, seq DESC) AS rn
    FROM events WHERE {where}) e WHERE rn = 1)"""


_FEATURES = f"airline, origin, dest, distance, month, dep_delay, day_of_week, {', '.join(CAUSES)}"
_TRAINING = "t AS (SELECT *, dep_delay AS score, CAST(dep_delay >= 15 AS INT) AS guess FROM flights WHERE cancelled = 0)"

# train rows per class by largest remainder; the test part gets the rest of ceil(0.2 n)
_SPLIT = """
total AS (SELECT count(*) AS n, count(*) - CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS n_train FROM t),
class_counts AS (SELECT arr_del15, count(*) AS k FROM t GROUP BY arr_del15),
floors AS (
  SELECT arr_del15, k, n_train, (k * n_train) // n AS f,
    row_number() OVER (ORDER BY (k * n_train) % n DESC, arr_del15) AS by_remainder
  FROM class_counts, total),
short AS (SELECT n_train - CAST(sum(f) AS BIGINT) AS missing FROM floors GROUP BY n_train),
sizes AS (
  SELECT arr_del15, k - f - CASE WHEN by_remainder <= missing THEN 1 ELSE 0 END AS n_test
  FROM floors, short),
split AS (
  SELECT row_key, t.arr_del15, CASE WHEN
    row_number() OVER (PARTITION BY t.arr_del15 ORDER BY md5('42:' || row_key)) <= n_test
    THEN 'test' ELSE 'train' END AS part
  FROM t JOIN sizes ON sizes.arr_del15 = t.arr_del15)"""

_OUTCOME = """
o AS (SELECT
  CAST(count(*) AS DOUBLE) AS n,
  CAST(count(*) FILTER (arr_del15 = 0 AND guess = 0) AS DOUBLE) AS h0,
  CAST(count(*) FILTER (arr_del15 = 1 AND guess = 1) AS DOUBLE) AS h1,
  CAST(count(*) FILTER (guess = 0) AS DOUBLE) AS g0, CAST(count(*) FILTER (guess = 1) AS DOUBLE) AS g1,
  CAST(count(*) FILTER (arr_del15 = 0) AS DOUBLE) AS s0, CAST(count(*) FILTER (arr_del15 = 1) AS DOUBLE) AS s1
  FROM t),
pr AS (SELECT *, coalesce(h0 / nullif(g0, 0), 0) AS p0, coalesce(h1 / nullif(g1, 0), 0) AS p1,
  coalesce(h0 / nullif(s0, 0), 0) AS r0, coalesce(h1 / nullif(s1, 0), 0) AS r1 FROM o),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
  coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM pr),
report AS (
  SELECT 'On Time' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM f
  UNION ALL SELECT 'Delayed 15+', p1, r1, f1, s1 FROM f
  UNION ALL SELECT 'accuracy', NULL, NULL, (h0 + h1) / n, n FROM f
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f)"""

_LOADED = _over_flights("SELECT * EXCLUDE (row_key) FROM flights")

_AIRLINE_STATS = _over_flights(f"SELECT airline, {_STATS} FROM flights WHERE cancelled = 0 GROUP BY airline")

_ROUTE_STATS = _over_flights(
    f"SELECT route, origin, dest, {_STATS} FROM flights WHERE cancelled = 0 GROUP BY route, origin, dest"
)

# every month from the first to the last shipped; one without rows has no report
_LOAD_REPORT = _over_flights(
    "SELECT file_name, year, month, CASE WHEN n IS NULL THEN 'missing' ELSE 'success' END AS status, "
    "coalesce(n, 0) AS n_rows FROM asked LEFT JOIN counted ON source_file = file_name",
    "counted AS (SELECT source_file, count(*) AS n FROM flights GROUP BY source_file)",
    "asked AS (SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month, "
    "printf('%d_%02d_Report.csv', year(m), month(m)) AS file_name FROM (SELECT unnest(generate_series("
    "date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)), INTERVAL 1 MONTH)) AS m FROM lineitem))",
)

_CHECKS = """
c AS (SELECT count(*) AS n,
  count(*) FILTER (dep_delay IS NULL OR arr_delay IS NULL OR arr_del15 IS NULL OR carrier_delay IS NULL
    OR weather_delay IS NULL OR nas_delay IS NULL OR security_delay IS NULL OR late_aircraft_delay IS NULL
    OR flight_number IS NULL) AS unfilled,
  count(*) FILTER (cancelled = 0) AS operated,
  CAST(sum(cancelled) AS BIGINT) AS cancelled,
  CAST(sum(arr_del15) AS BIGINT) AS late,
  CAST(sum(arr_del15) FILTER (cancelled = 0) AS BIGINT) AS late_operated,
  count(*) FILTER (cancelled = 0 AND ANY_CAUSE) AS caused,
  count(route) AS routed,
  count(*) FILTER (origin IS NOT NULL AND dest IS NOT NULL) AS both_ends
  FROM flights)""".replace("ANY_CAUSE", _ANY_CAUSE)

_MONTHLY_DELAYS = _over_flights(
    "SELECT year, month, round(avg(arr_delay), 6) AS avg_arr_delay, count(*) AS n_flights "
    "FROM flights WHERE cancelled = 0 GROUP BY year, month"
)

_MARTS = {
    "v_airline_delay_stats": "airline",
    "v_monthly_delays": "year, month",
    "v_airline_rolling_metrics": "year, month, airline",
    "v_airline_vs_month_avg": "year, month, airline",
    "v_route_delay_stats": "route, origin, dest",
}

ORACLE_SQL: dict[str, str] = {
    "clean_flights": _over_flights("SELECT * FROM flights"),
    "flights_base": _over_flights(
        "SELECT flight_date, airline, flight_number, origin, dest, distance, dep_delay, arr_delay, arr_del15, "
        "cancelled, diverted, route FROM flights WHERE cancelled = 0"
    ),
    "airline_delay_stats": _AIRLINE_STATS,
    "monthly_delays": _MONTHLY_DELAYS,
    "airline_month_base": _over_flights(
        "SELECT year, month, airline, round(a, 6) AS avg_arr_delay, n AS n_flights FROM airline_month", _AIRLINE_MONTH
    ),
    "airline_rolling_metrics": _over_flights(
        f"SELECT year, month, airline, round(a, 6) AS avg_arr_delay, "
        f"round(avg(a) OVER {_FRAME}, 6) AS rolling_3mo_avg_delay, "
        f"CAST(sum(n) OVER {_FRAME} AS BIGINT) AS rolling_3mo_flights FROM airline_month",
        _AIRLINE_MONTH,
    ),
    "airline_vs_month_avg": _over_flights(
        "SELECT year, month, airline, round(a, 6) AS airline_avg_delay, "
        "round(avg(a) OVER (PARTITION BY year, month), 6) AS month_avg_delay, "
        "round(a - avg(a) OVER (PARTITION BY year, month), 6) AS delay_vs_month_avg FROM airline_month",
        _AIRLINE_MONTH,
    ),
    "delay_causes_by_airline": _over_flights(
        "SELECT airline, count(*) AS n_delayed_flights, "
        + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in CAUSES)
        + f" FROM flights WHERE cancelled = 0 AND {_ANY_CAUSE} GROUP BY airline"
    ),
    "route_delay_stats": _ROUTE_STATS,
    "airport_delay_stats": _over_flights(
        "SELECT origin AS airport, count(*) AS n_departures, round(avg(dep_delay), 6) AS avg_dep_delay, "
        "round(CAST(sum(arr_del15) AS DOUBLE) / count(*), 6) AS pct_arr_del15, "
        "round(CAST(sum(cancelled) AS DOUBLE) / (count(*) + sum(cancelled)), 6) AS cancellation_rate, "
        "round(CAST(sum(cancelled) AS DOUBLE) / count(*), 6) AS cancellation_rate_true "
        "FROM flights GROUP BY origin"
    ),
    "month_summary": _over_flights(
        f"SELECT year, month, airline, route, origin, dest, cancelled, {_ANY_CAUSE} AS has_cause, "
        "count(*) AS flights, CAST(sum(arr_del15) AS BIGINT) AS late, "
        + ", ".join(f"sum({c}) AS {c}_sum, count({c}) AS {c}_n" for c in _AVERAGED)
        + " FROM flights GROUP BY ALL"
    ),
    "airline_month_features": _over_flights(
        """
SELECT year, month, airline, n_flights, round(a, 6) AS avg_arr_delay, round(s, 6) AS std_arr_delay,
  round(d, 6) AS avg_dep_delay, round(CAST(late AS DOUBLE) / n_flights * 100, 6) AS pct_arr_del15,
  round(CASE WHEN count(a) OVER w = 3 THEN avg(a) OVER w END, 6) AS rolling_3mo_avg_delay
FROM m WINDOW w AS (PARTITION BY airline ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        """
m AS (SELECT year, month, airline, count(arr_delay) AS n_flights, avg(arr_delay) AS a, stddev_samp(arr_delay) AS s,
        avg(dep_delay) AS d, sum(arr_del15) AS late
      FROM flights WHERE cancelled = 0 AND year IS NOT NULL AND month IS NOT NULL AND airline IS NOT NULL
      GROUP BY year, month, airline)""",
    ),
    "month_axis": f"WITH {_AXIS.strip()} SELECT year, month, file_name, n_months FROM axis",
    "ledger_pending": (
        f"WITH {_AXIS.strip()}, {_EVENTS.strip()}, {_newest().strip()} "
        "SELECT file_name, year, month FROM axis WHERE NOT EXISTS "
        "(SELECT 1 FROM ledger WHERE ledger.file_name = axis.file_name AND status = 'success')"
    ),
    "ledger_upsert": f"WITH {_EVENTS.strip()}, {_newest().strip()} SELECT {_LEDGER_COLUMNS} FROM ledger",
    "ledger_insert_if_absent": (
        f"WITH {_EVENTS.strip()}, {_newest().strip()} SELECT {_LEDGER_COLUMNS} FROM ledger "
        "WHERE file_name NOT IN (SELECT file_name FROM ledger WHERE month BETWEEN 2 AND 11)"
    ),
    "route_backfill": _over_flights(
        "SELECT row_key, o AS origin, dest, coalesce(r, o || '-' || dest) AS route FROM old",
        "old AS (SELECT row_key, dest, CASE WHEN flight_number % 5 <> 0 THEN origin END AS o, "
        "CASE WHEN flight_number % 3 = 0 THEN 'kept' END AS r FROM flights)",
    ),
    "schema_evolution_union": _over_flights(
        "SELECT row_key, year, CAST(day_of_week AS DOUBLE) AS day_of_week, " + ", ".join(CAUSES) + " FROM ("
        "SELECT * FROM flights WHERE year >= 1998 UNION ALL BY NAME "
        "SELECT * EXCLUDE (day_of_week, " + ", ".join(CAUSES) + ") FROM flights WHERE year < 1998) u"
    ),
    "file_row_counts": _over_flights("SELECT source_file, count(*) AS n_rows FROM flights GROUP BY source_file"),
    "training_rows": _over_flights(
        f"SELECT row_key, {_FEATURES}, arr_del15 FROM flights WHERE cancelled = 0 AND year = 1997"
    ),
    "label_encoding": _over_flights(
        "SELECT row_key, airline, origin, dest, "
        + ", ".join(
            f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_code" for c in ["airline", "origin", "dest"]
        )
        + " FROM t",
        _TRAINING,
    ),
    "stratified_split": _over_flights("SELECT row_key, arr_del15, part FROM split", _TRAINING, _SPLIT),
    "class_weights": _over_flights(
        "SELECT arr_del15, count(*) AS n_rows, "
        "round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight "
        "FROM split WHERE part = 'train' GROUP BY arr_del15",
        _TRAINING,
        _SPLIT,
    ),
    "split_summary": _over_flights(
        "SELECT count(*) FILTER (part = 'train') AS train_size, count(*) FILTER (part = 'test') AS test_size, "
        "round(avg(arr_del15), 6) AS delay_rate FROM split",
        _TRAINING,
        _SPLIT,
    ),
    "roc_auc": _over_flights(
        "SELECT round((sum(CASE WHEN arr_del15 = 1 THEN r ELSE 0 END) - p * (p + 1) / 2) / (p * q), 6) AS roc_auc "
        "FROM ranked, (SELECT CAST(sum(arr_del15) AS DOUBLE) AS p, "
        "CAST(sum(1 - arr_del15) AS DOUBLE) AS q FROM t) k GROUP BY p, q",
        _TRAINING,
        "ranked AS (SELECT arr_del15, CAST(rank() OVER (ORDER BY score) AS DOUBLE) "
        "+ (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM t)",
    ),
    "classification_report": _over_flights(
        "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM report",
        _TRAINING,
        _OUTCOME,
    ),
    "confusion_matrix": _over_flights(
        "SELECT CASE c WHEN 0 THEN 'Actual On Time' ELSE 'Actual Delayed' END AS actual, "
        "count(*) FILTER (arr_del15 = c AND guess = 0) AS \"Predicted On Time\", "
        "count(*) FILTER (arr_del15 = c AND guess = 1) AS \"Predicted Delayed\" "
        "FROM t, (VALUES (0), (1)) classes(c) GROUP BY c",
        _TRAINING,
    ),
    "preview": _over_flights("SELECT * FROM flights ORDER BY ALL LIMIT 10"),
    "quality_report": _over_flights(
        """
SELECT 'has rows' AS check_name, n > 0 AS passed, n FROM c
UNION ALL SELECT 'expected columns are present', TRUE, CAST(0 AS BIGINT) FROM c
UNION ALL SELECT 'delays are filled', unfilled = 0, unfilled FROM c
UNION ALL SELECT 'departures are operated or cancelled', operated + cancelled = n, cancelled FROM c
UNION ALL SELECT 'cancelled flights are not late', late = late_operated, late FROM c
UNION ALL SELECT 'late flights are those with a cause', caused = late_operated, caused FROM c
UNION ALL SELECT 'routes have both ends', routed = both_ends, routed FROM c""",
        _CHECKS,
    ),
    "csv_ingest_roundtrip": _LOADED,
    "dry_run_report": _LOAD_REPORT,
    "marts_from_summary": _AIRLINE_STATS,
    "mart_exports": _ROUTE_STATS,
    "zip_ingest": _LOADED,
    "stream_ingest": _LOADED,
    "forest_checks": _over_flights(
        "SELECT count(*) AS test_rows, CAST(sum(arr_del15) AS BIGINT) AS late_rows, count(*) AS in_range, count(*) AS consistent, "
        "CAST(12 AS BIGINT) AS features, CAST(1 AS DOUBLE) AS importance_sum, TRUE AS auc_above_0_9 FROM split WHERE part = 'test'",
        _TRAINING,
        _SPLIT,
    ),
    "prediction_export": _over_flights(
        "SELECT airline_code AS airline, origin_code AS origin, dest_code AS dest, distance, month, dep_delay, day_of_week, "
        + ", ".join(CAUSES)
        + ", arr_del15 AS actual_arr_del15, CAST(month >= 7 AS INT) AS predicted_arr_del15, CAST(month >= 7 AS DOUBLE) AS delay_probability "
        "FROM (SELECT *, "
        + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_code" for c in ["airline", "origin", "dest"])
        + " FROM t) c WHERE row_key IN (SELECT row_key FROM split WHERE part = 'test')",
        _TRAINING,
        _SPLIT,
    ),
    "importance_export": _over_flights(
        "SELECT feature, importance, place FROM (VALUES ('month', CAST(1 AS DOUBLE), CAST(1 AS BIGINT)), ('distance', CAST(0 AS DOUBLE), CAST(2 AS BIGINT))) "
        "x(feature, importance, place) WHERE EXISTS (SELECT 1 FROM t WHERE month >= 7) AND EXISTS (SELECT 1 FROM t WHERE month < 7)",
        _TRAINING,
    ),
    "encoder_reload": _over_flights(
        "SELECT row_key, airline, origin, dest, "
        + ", ".join(f"{c}_code" for c in ["airline", "origin", "dest"])
        + " FROM t"
        + "".join(
            f" JOIN (SELECT {c}, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_code FROM "
            f"(SELECT DISTINCT {c} FROM t WHERE year = 1995) d_{c}) k_{c} USING ({c})"
            for c in ["airline", "origin", "dest"]
        )
        + " WHERE year = 1996",
        _TRAINING,
    ),
    "ledger_time": _over_flights(
        "SELECT source_file AS file_name, count(*) AS n_rows, 'success' AS status, TRUE AS whole_seconds, TRUE AS within_run FROM flights GROUP BY source_file"
    ),
    "load_failures": _over_flights(
        "SELECT source_file AS file_name, year, month, CASE WHEN bad THEN 0 ELSE n END AS n_rows, "
        "CASE WHEN bad THEN 'failed' ELSE 'success' END AS status FROM "
        "(SELECT source_file, year, month, count(*) AS n, bool_or(month = 3 AND day = 1) AS bad FROM flights GROUP BY ALL) r"
    ),
    "rerun_replaces": _over_flights(
        "SELECT source_file, count(*) AS n_rows FROM flights WHERE year > (SELECT min(year) FROM flights) OR day <= 15 "
        "OR source_file NOT IN (SELECT source_file FROM flights WHERE day <= 15) GROUP BY source_file"
    ),
    "reset_then_load": _LOADED,
    "ledger_loaded": (
        f"WITH {_AXIS.strip()}, {_EVENTS.strip()}, {_newest().strip()} "
        "SELECT axis.file_name, axis.year, axis.month, CAST(n_rows AS BIGINT) AS n_rows, "
        "(SELECT max(file_name) FROM axis) IN (SELECT file_name FROM ledger WHERE status = 'success') AS newest_is_loaded "
        "FROM axis JOIN ledger ON ledger.file_name = axis.file_name WHERE status = 'success'"
    ),
    "ledger_preview": (
        f"WITH {_EVENTS.strip()}, {_newest().strip()} SELECT {_LEDGER_COLUMNS} FROM ledger ORDER BY file_name DESC LIMIT 10"
    ),
    "repeat_runs": _LOAD_REPORT.replace(
        "SELECT file_name, year, month, CASE WHEN n IS NULL THEN 'missing' ELSE 'success' END AS status, ",
        "SELECT file_name, CASE WHEN n IS NULL THEN 'missing' ELSE 'skipped' END AS second_run, "
        "CASE WHEN n IS NULL THEN 'missing' ELSE 'success' END AS dry_rerun, TRUE AS unchanged, TRUE AS tables_exist, ",
    ),
    "all_mart_exports": _over_flights(
        " UNION ALL ".join(
            [f"SELECT '{mart}' AS mart, count(*) AS n_rows FROM (SELECT DISTINCT {keys} FROM flights WHERE cancelled = 0) x" for mart, keys in _MARTS.items()]
            + ["SELECT 'v_airport_delay_stats' AS mart, count(DISTINCT origin) AS n_rows FROM flights",
               f"SELECT 'v_delay_causes_by_airline' AS mart, count(DISTINCT airline) AS n_rows FROM flights WHERE cancelled = 0 AND {_ANY_CAUSE}"]
        )
    ),
    "stream_marts": _MONTHLY_DELAYS,
}
