import random

import pytest
from flight_rows import make_flights, month_rows, raw_row, write_report
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarmac.operators import ledger, marts
from tarmac.operators.quality import fingerprint
from tarmac.plans import pipeline
from tarmac.plans import ingest as load
from tarmac.plans.ingest import ingest
from tarmac.schema import FLIGHTS_SCHEMA, RAW_TO_CLEAN
from tarmac.session import COMPILED_BYTES, OPEN_FILES, writing_session
from tarmac.sources import reports as R

JAN, FEB, MAR = (2025, 1), (2025, 2), (2025, 3)


def statuses(result):
    return {r.file_name: (r.status, r.n_rows) for r in result.report().collect()}


def ledger_rows(warehouse):
    return {r.file_name: (r.status, r.n_rows) for r in warehouse.ledger().collect()}


def per_month(warehouse):
    return {(r.year, r.month): r["count"] for r in warehouse.flights().groupBy("year", "month").count().collect()}


def test_months_are_loaded_once(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    write_report(landing, 2025, 2, month_rows(4))
    first = ingest(warehouse, landing, JAN, MAR)
    assert statuses(first) == {
        "2025_01_Report.csv": ("success", 3), "2025_02_Report.csv": ("success", 4), "2025_03_Report.csv": ("missing", 0),
    }
    assert ledger_rows(warehouse) == {"2025_01_Report.csv": ("success", 3), "2025_02_Report.csv": ("success", 4)}
    before = fingerprint(warehouse.flights())
    again = ingest(warehouse, landing, JAN, MAR)
    assert statuses(again)["2025_01_Report.csv"][0] == "skipped"
    assert fingerprint(warehouse.flights()) == before
    assert warehouse.flights().columns == FLIGHTS_SCHEMA.names
    assert ledger.is_loaded(warehouse.ledger(), "2025_01_Report.csv")
    assert not ledger.is_loaded(warehouse.ledger(), "2025_03_Report.csv")


def test_header_order_and_extra_columns_do_not_matter(warehouse, landing):
    columns = list(RAW_TO_CLEAN)
    shuffled = columns[:]
    random.Random(1).shuffle(shuffled)
    rows = [raw_row(OP_CARRIER_FL_NUM=str(i), ORIGIN="SEA", DEST=f"D{i}") for i in range(5)]
    write_report(landing, 2025, 1, rows, columns)
    write_report(landing, 2025, 2, rows, [*shuffled, "TAIL_NUM", ""])
    ingest(warehouse, landing, JAN, FEB)
    values = [c for c in FLIGHTS_SCHEMA.names if c not in ["month", "source_file"]]
    jan, feb = (warehouse.flights().where(F.col("month") == m).select(values) for m in (1, 2))
    assert jan.count() == 5
    assert jan.exceptAll(feb).isEmpty() and feb.exceptAll(jan).isEmpty()
    assert jan.where("origin = 'SEA' and route like 'SEA-D%'").count() == 5


@pytest.mark.parametrize(
    "bad",
    [
        {"columns": [c for c in RAW_TO_CLEAN if c != "ARR_DEL15"]},
        {"rows": [raw_row(), raw_row(CANCELLED="")]},
        {"rows": [raw_row(ARR_DEL15="late")]},
        {"rows": [raw_row(extra="x")], "columns": list(RAW_TO_CLEAN), "overflow": True},
    ],
)
def test_a_bad_report_fails_alone_and_can_be_fixed(warehouse, landing, bad):
    path = write_report(landing, 2025, 1, bad.get("rows", [raw_row()]), bad.get("columns"))
    if bad.get("overflow"):
        with open(path) as f:
            lines = f.read().splitlines()
        with open(path, "w") as f:
            f.write("\n".join([lines[0], lines[1] + ",stray"]) + "\n")
    write_report(landing, 2025, 2, month_rows(2))
    result = statuses(ingest(warehouse, landing, JAN, FEB))
    assert result == {"2025_01_Report.csv": ("failed", 0), "2025_02_Report.csv": ("success", 2)}
    assert per_month(warehouse) == {FEB: 2}
    assert ledger_rows(warehouse)["2025_01_Report.csv"] == ("failed", 0)

    write_report(landing, 2025, 1, month_rows(3))
    ingest(warehouse, landing, JAN, FEB)
    assert per_month(warehouse) == {JAN: 3, FEB: 2}
    assert ledger_rows(warehouse)["2025_01_Report.csv"] == ("success", 3)
    assert warehouse.ledger().count() == 2 and warehouse.load_log().count() == 3


def test_an_unreadable_report_fails_alone(warehouse, landing, monkeypatch):
    write_report(landing, 2025, 1, month_rows(1))
    write_report(landing, 2025, 2, month_rows(2))
    real = R.read_text_rows

    def broken(spark, headers, aliases=None):
        text = real(spark, headers, aliases)
        if any("2025_01" in path for path in headers):
            text = text.withColumn("year", F.expr(f"CASE WHEN month = '1' THEN raise_error('{message}') ELSE year END"))
        return text

    monkeypatch.setattr(R, "read_text_rows", broken)
    message = "a lost executor"
    with pytest.raises(PySparkException, match=message):
        ingest(warehouse, landing, JAN, FEB)
    assert warehouse.load_log().count() == 0
    message = "FAILED_READ_FILE"
    result = statuses(ingest(warehouse, landing, JAN, FEB))
    assert result == {"2025_01_Report.csv": ("failed", 0), "2025_02_Report.csv": ("success", 2)}
    assert per_month(warehouse) == {FEB: 2}


def test_parts_are_read_by_their_own_headers(spark, warehouse, landing):
    columns = list(RAW_TO_CLEAN)
    swapped = [{"ORIGIN": "DEST", "DEST": "ORIGIN"}.get(c, c) for c in columns]
    folder = f"{landing}/2025_01_Report.csv"
    write_report(folder, 2025, 1, month_rows(2), columns, name="part-0.csv")
    write_report(folder, 2025, 1, month_rows(3), swapped, name="part-1.csv")
    open(f"{folder}/part-2.csv", "w").close()
    ingest(warehouse, landing, JAN, JAN)
    assert {(r.route, r["count"]) for r in warehouse.flights().groupBy("route").count().collect()} == {("JFK-LAX", 5)}
    write_report(f"{landing}/2025_02_Report.csv", 2025, 2, month_rows(2), columns, name="part-0.csv")
    write_report(f"{landing}/2025_02_Report.csv", 2025, 2, month_rows(2), [c for c in columns if c != "DEST"], name="part-1.csv")
    headers = R.read_headers(spark, R.collect_reports(R.list_reports(spark, landing)))
    assert len(headers) == 4
    assert statuses(ingest(warehouse, landing, FEB, FEB)) == {"2025_02_Report.csv": ("failed", 0)}


def test_a_report_of_too_many_months_is_rejected(warehouse, landing, monkeypatch):
    monkeypatch.setattr(load, "MOST_MONTHS", 3)
    write_report(landing, 2025, 1, [raw_row(_month=m) for m in range(1, 6)])
    write_report(landing, 2025, 2, [raw_row(_month=m) for m in (2, 3, 4)])
    assert statuses(ingest(warehouse, landing, JAN, FEB)) == {"2025_01_Report.csv": ("failed", 0), "2025_02_Report.csv": ("success", 3)}


def test_a_failed_rerun_keeps_the_loaded_rows_and_their_log(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    ingest(warehouse, landing, JAN, JAN)
    write_report(landing, 2025, 1, [raw_row(CANCELLED="")])
    assert statuses(ingest(warehouse, landing, JAN, JAN, rerun=True)) == {"2025_01_Report.csv": ("failed", 0)}
    assert per_month(warehouse) == {JAN: 3} and ledger_rows(warehouse)["2025_01_Report.csv"] == ("success", 3)


def test_rerun_replaces_only_its_months(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    write_report(landing, 2025, 2, month_rows(4))
    ingest(warehouse, landing, JAN, FEB)
    write_report(landing, 2025, 1, month_rows(5, ORIGIN="BOS"))
    write_report(landing, 2025, 2, month_rows(9))
    ingest(warehouse, landing, JAN, JAN, rerun=True)
    assert per_month(warehouse) == {JAN: 5, FEB: 4}
    assert warehouse.flights().where("month = 1 and origin = 'BOS'").count() == 5


def test_dry_run_writes_nothing(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    result = ingest(warehouse, landing, JAN, JAN, dry_run=True)
    assert statuses(result) == {"2025_01_Report.csv": ("success", 3)}
    assert not R.path_exists(warehouse.spark, warehouse.flights_path)
    ingest(warehouse, landing, JAN, JAN)
    before, log = fingerprint(warehouse.flights()), warehouse.load_log().count()
    write_report(landing, 2025, 1, month_rows(7))
    ingest(warehouse, landing, JAN, JAN, rerun=True, dry_run=True)
    assert fingerprint(warehouse.flights()) == before and warehouse.load_log().count() == log


def everything(warehouse):
    return [fingerprint(table) for table in (warehouse.flights(), warehouse.summary(), warehouse.load_log())]


@pytest.mark.parametrize("step", ["stage_rows", "stage_summary", "commit"])
def test_a_crash_at_any_write_is_never_visible(warehouse, landing, monkeypatch, step):
    """Rows, summary and log change together or not at all, on a first load and on a rerun; then the run is simply run again."""
    real = getattr(type(warehouse), step)

    def crash_before(self, *args):
        raise RuntimeError("lost the driver")

    def crash_after(self, *args):
        if step != "commit":
            real(self, *args)
        raise RuntimeError("lost the driver")

    for n, crash in ((3, crash_before), (5, crash_after)):
        write_report(landing, 2025, 1, [*month_rows(n), *month_rows(1, _month=2)])
        before = everything(warehouse)
        with monkeypatch.context() as patch:
            patch.setattr(type(warehouse), step, crash)
            with pytest.raises(RuntimeError):
                ingest(warehouse, landing, JAN, JAN, rerun=True)
        assert everything(warehouse) == before
        ingest(warehouse, landing, JAN, JAN, rerun=True)
        assert per_month(warehouse) == {JAN: n, FEB: 1} and warehouse.ledger().count() == 1
        assert {r.month: r.n_flights for r in marts.monthly_delays(warehouse.summary()).collect()} == {1: n, 2: 1}


def test_a_commit_without_its_file_counts_for_nothing(warehouse, landing, tmp_path):
    """What a writer leaves that dies inside a commit: a folder without a finished file."""
    write_report(landing, 2025, 1, month_rows(3))
    ingest(warehouse, landing, JAN, JAN)
    before = everything(warehouse)
    (tmp_path / "warehouse" / "commits" / "1-dead" / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "warehouse" / "commits" / "1-dead" / "_temporary" / "0" / "part-0.parquet").write_bytes(b"half")
    assert everything(warehouse) == before


def test_text_is_parsed_once(spark, warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    write_report(landing, 2025, 2, month_rows(4))
    store = spark._jsparkSession.sharedState().statusStore()

    def scans():
        plans = store.executionsList()
        return sum(plans.apply(i).physicalPlanDescription().count("Scan csv") > 0 for i in range(plans.size()))

    before = scans()
    ingest(warehouse, landing, JAN, FEB)
    assert scans() == before + 1 and per_month(warehouse) == {JAN: 3, FEB: 4}


def test_readers_keep_what_they_started_from(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    ingest(warehouse, landing, JAN, JAN)
    reader = warehouse.flights()
    assert warehouse.unused() == []
    write_report(landing, 2025, 1, month_rows(5))
    ingest(warehouse, landing, JAN, JAN, rerun=True)
    assert reader.count() == 3 and warehouse.flights().count() == 5
    assert len(warehouse.unused()) == 2  # the old rows and their summary
    warehouse.reset()
    assert len(warehouse.unused()) == 4


def test_rows_that_name_far_months_reject_the_report(warehouse, landing):
    write_report(landing, 2025, 1, [raw_row(), raw_row(_year=1925)])
    write_report(landing, 2025, 2, [raw_row(_year=2024, _month=3), raw_row(_year=2147483647, _month=2147483647)])
    write_report(landing, 2025, 3, [raw_row(_year=2024, _month=4), raw_row(_year=2026, _month=2)])
    result = statuses(ingest(warehouse, landing, JAN, MAR))
    assert result == {"2025_01_Report.csv": ("failed", 0), "2025_02_Report.csv": ("failed", 0), "2025_03_Report.csv": ("success", 2)}
    assert per_month(warehouse) == {(2024, 4): 1, (2026, 2): 1}


def test_headers_go_to_their_reports():
    reports = [R.Report("file:/a/2025_01_Report.csv", "2025_01_Report.csv", 2025, 1), R.Report("/a/2025_02_Report.csv/", "2025_02_Report.csv", 2025, 2)]
    headers = {"file:///a/2025_01_Report.csv": ("X",), "file:/a/2025_02_Report.csv/p0.csv": ("Y",), "/a/2025_02_Report.csv/s/p1.csv": ("Z",), "/b/other.csv": ("W",)}
    found = R.headers_by_report(reports, headers)
    assert [sorted(found[r].values()) for r in reports] == [[("X",)], [("Y",), ("Z",)]]


def test_rows_of_another_month_do_not_touch_that_month(warehouse, landing):
    write_report(landing, 2025, 2, month_rows(4))
    write_report(landing, 2025, 1, [*month_rows(3), *month_rows(2, _month=2)])
    pipeline.run(warehouse, landing, JAN, FEB)
    assert per_month(warehouse) == {JAN: 3, FEB: 6}
    write_report(landing, 2025, 1, month_rows(3))
    pipeline.run(warehouse, landing, JAN, JAN, rerun=True)
    assert per_month(warehouse) == {JAN: 3, FEB: 4}
    months = {(r.year, r.month): r.n_flights for r in marts.monthly_delays(warehouse.summary()).collect()}
    assert months == {JAN: 3, FEB: 4}


def test_a_month_can_lose_all_its_rows(warehouse, landing):
    write_report(landing, 2025, 1, [*month_rows(3), *month_rows(2, _month=2)])
    pipeline.run(warehouse, landing, JAN, JAN)
    write_report(landing, 2025, 1, month_rows(1))
    pipeline.run(warehouse, landing, JAN, JAN, rerun=True)
    assert per_month(warehouse) == {JAN: 1}
    assert [(r.month, r.flights) for r in warehouse.summary().collect()] == [(1, 1)]


def test_missing_period_is_kept(warehouse, landing):
    write_report(landing, 2025, 1, [*month_rows(2), *month_rows(1, _year="", _month="")])
    pipeline.run(warehouse, landing, JAN, JAN)
    assert per_month(warehouse) == {JAN: 2, (None, None): 1}
    assert marts.airline_delay_stats(warehouse.summary()).first().n_flights == 3


def test_header_aliases(warehouse, landing):
    names = {"YEAR": "Year", "OP_UNIQUE_CARRIER": "Reporting_Airline"}
    columns = [names.get(c, c) for c in RAW_TO_CLEAN]
    rows = [{names.get(k, k): v for k, v in raw_row().items()} | {"Year": 2025}]
    write_report(landing, 2025, 1, rows, columns)
    assert statuses(ingest(warehouse, landing, JAN, JAN, dry_run=True))["2025_01_Report.csv"][0] == "failed"
    ingest(warehouse, landing, JAN, JAN, aliases={v: k for k, v in names.items()})
    assert warehouse.flights().first().airline == "AA"


def test_two_reports_of_one_name_are_not_both_loaded(warehouse, landing):
    write_report(landing + "/a", 2025, 1, month_rows(2))
    write_report(landing + "/b", 2025, 1, month_rows(3))
    write_report(landing + "/b", 2025, 2, month_rows(1))
    ingest(warehouse, landing, JAN, FEB)
    assert per_month(warehouse) == {FEB: 1}
    assert ledger_rows(warehouse) == {"2025_01_Report.csv": ("failed", 0), "2025_02_Report.csv": ("success", 1)}


def test_reset_empties_everything(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(3))
    pipeline.run(warehouse, landing, JAN, JAN)
    warehouse.reset()
    assert warehouse.flights().isEmpty() and warehouse.ledger().isEmpty() and warehouse.summary().isEmpty()
    pipeline.run(warehouse, landing, JAN, JAN)
    assert per_month(warehouse) == {JAN: 3}


def test_append_and_mark(warehouse, landing):
    write_report(landing, 2025, 1, month_rows(2))
    ingest(warehouse, landing, JAN, JAN)
    rows = warehouse.spark.createDataFrame(
        [("2025_01_Report.csv", 2025, 1, 99, "failed"), ("2025_02_Report.csv", 2025, 2, 0, "success")],
        "file_name string, year int, month int, n_rows long, status string",
    )
    warehouse.mark_loaded(rows)
    assert ledger_rows(warehouse) == {"2025_01_Report.csv": ("success", 2), "2025_02_Report.csv": ("success", 0)}
    more = warehouse.spark.createDataFrame(warehouse.flights().collect(), FLIGHTS_SCHEMA)
    warehouse.append_flights(more)
    assert per_month(warehouse) == {JAN: 4}


def test_columns_added_later_are_null_in_older_files(spark, warehouse, landing):
    write_report(landing, 2025, 1, month_rows(2))
    ingest(warehouse, landing, JAN, JAN)
    old = warehouse.flights().drop("carrier_delay", "route").withColumns(
        {"month": F.lit(2), "source_file": F.lit("2025_02_Report.csv")}
    )
    old.write.mode("append").partitionBy("year", "month", "source_file").parquet(warehouse.flights_path)
    rows = warehouse.flights().where("month = 2").collect()
    assert len(rows) == 2 and all(r.carrier_delay is None and r.route == "JFK-LAX" for r in rows)


def test_newest_log_row_wins(spark):
    rows = [
        ("a", 2025, 1, "2025-01-01 00:00:00", 5, "success", 1),
        ("a", 2025, 1, "2025-01-02 00:00:00", 0, "failed", 1),
        ("b", 2025, 2, "2025-01-02 00:00:00", 0, "failed", 1),
        ("b", 2025, 2, "2025-01-02 00:00:00", 7, "success", 2),
    ]
    schema = "file_name string, year int, month int, t string, n_rows long, status string, seq long"
    log = spark.createDataFrame(rows, schema).withColumn("ingested_at", F.col("t").cast("timestamp")).drop("t")
    current = {r.file_name: r.status for r in ledger.current_ledger(log).collect()}
    assert current == {"a": "failed", "b": "success"}
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    assert {r.file_name for r in ledger.pending(todo, ledger.current_ledger(log)).collect()} == {"a", "c"}
    assert {r.file_name for r in ledger.already_loaded(todo, ledger.current_ledger(log)).collect()} == {"b"}


def test_appended_rows_are_brought_together_by_month(warehouse, spark, tmp_path):
    rows = [{"month": m, "flight_number": i, "source_file": f"2025_{m:02d}_Report.csv"} for i in range(40) for m in (1, 2, 3)]
    warehouse.append_flights(make_flights(spark, rows).repartition(8))
    assert len(list((tmp_path / "warehouse").glob("loads/**/*.parquet"))) == 3 and per_month(warehouse) == {(2025, m): 40 for m in (1, 2, 3)}


def test_reports_are_written_without_sorting_them_by_month(warehouse, landing, spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    beside = writing_session(spark)
    assert beside.conf.get(key) == str(OPEN_FILES) and spark.conf.get(key) == before
    assert beside.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    # one file whose rows alternate between months
    rows = [raw_row(_month=1 + i % 12, OP_CARRIER_FL_NUM=str(i)) for i in range(96)]
    write_report(landing, 2025, 6, rows)
    assert statuses(ingest(warehouse, landing, JAN, (2025, 12)))["2025_06_Report.csv"] == ("success", 96)
    assert per_month(warehouse) == {(2025, m): 8 for m in range(1, 13)}


def test_parts_in_folders_keep_their_report(warehouse, landing):
    for part, n in (("a", 2), ("b", 3)):
        write_report(f"{landing}/x_Report.csv_old/2025_01_Report.csv", 2025, 1, month_rows(n), name=f"{part}.csv")
    assert statuses(ingest(warehouse, landing, JAN, JAN)) == {"2025_01_Report.csv": ("success", 5)}


def test_code_that_the_jvm_would_interpret_is_run_in_pieces(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    assert writing_session(spark).conf.get(key) == str(COMPILED_BYTES) and spark.conf.get(key) == before and int(before) > COMPILED_BYTES


def test_rows_of_other_lengths_than_the_header(spark, warehouse, landing):
    """A row with too few fields ends in nulls, one with too many names the first of them."""
    path = write_report(landing, 2025, 1, month_rows(3))
    with open(path) as f:
        lines = f.read().splitlines()
    with open(path, "w") as f:
        f.write("\n".join([lines[0], lines[1].rsplit(",", 2)[0], lines[2] + ",", lines[3] + ",stray,more"]) + "\n")
    rows = R.read_text_rows(spark, R.read_headers(spark, R.collect_reports(R.list_reports(spark, landing)))).orderBy("flight_number").collect()
    assert [(r.nas_delay, r.security_delay, r.late_aircraft_delay, r._overflow) for r in rows] == [
        ("0.00", None, None, None), ("0.00", "0.00", "0.00", None), ("0.00", "0.00", "0.00", "stray"),
    ]
    assert "_unread" not in rows[0] and statuses(ingest(warehouse, landing, JAN, JAN)) == {"2025_01_Report.csv": ("failed", 0)}


def test_headers_are_read_without_python_workers(spark, landing):
    """A worker was started for each part, and was sent all of its lines."""
    for part, n in (("a", 30_000), ("b", 2)):
        write_report(f"{landing}/2025_01_Report.csv", 2025, 1, month_rows(n), [*RAW_TO_CLEAN, part], name=f"{part}.csv")
    open(f"{landing}/2025_01_Report.csv/c.csv", "w").close()
    with open(f"{landing}/2025_01_Report.csv/d.csv", "w") as out:
        out.write("\ufeff" + '"x, y",z\n')
    reports = R.collect_reports(R.list_reports(spark, landing))
    assert "MapInArrow" not in R.first_lines(spark, reports)._jdf.queryExecution().executedPlan().toString()
    assert {path[-5:]: header for path, header in R.read_headers(spark, reports).items()} == {
        "a.csv": (*RAW_TO_CLEAN, "a"), "b.csv": (*RAW_TO_CLEAN, "b"), "d.csv": ("x, y", "z"),
    }
