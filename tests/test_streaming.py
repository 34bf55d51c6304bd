import os
import random
import time

import pytest
from flight_rows import month_rows, raw_row, write_report
from pyspark.errors import StreamingQueryException

from tarmac.operators.quality import fingerprint
from tarmac.plans import pipeline
from tarmac.schema import RAW_TO_CLEAN
from tarmac.sources import reports as R
from tarmac.streaming import ingest as streaming
from tarmac.streaming.ingest import stream_reports


def run(warehouse, landing, checkpoint, **options):
    query = stream_reports(warehouse, landing, checkpoint, **options)
    query.awaitTermination()
    assert query.exception() is None


def test_each_report_counts_once(warehouse, landing, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    write_report(landing, 2025, 1, month_rows(3))
    run(warehouse, landing, checkpoint)
    assert warehouse.flights().count() == 3
    before = fingerprint(warehouse.flights())
    run(warehouse, landing, checkpoint)
    assert fingerprint(warehouse.flights()) == before

    columns = list(RAW_TO_CLEAN)
    random.Random(2).shuffle(columns)
    write_report(landing, 2025, 2, [raw_row(ORIGIN="SEA")] * 2, columns)
    write_report(landing, 2025, 3, [raw_row(CANCELLED="")])
    run(warehouse, landing, checkpoint)
    assert warehouse.flights().count() == 5 and warehouse.flights().where("origin = 'SEA'").count() == 2
    assert {r.file_name: r.status for r in warehouse.ledger().collect()} == {
        "2025_01_Report.csv": "success", "2025_02_Report.csv": "success", "2025_03_Report.csv": "failed",
    }
    months = warehouse.spark.sql("SELECT month, n_flights FROM v_monthly_delays ORDER BY month").collect()
    assert [tuple(r) for r in months] == [(1, 3), (2, 2)]


def test_a_replayed_batch_changes_nothing(warehouse, landing, tmp_path):
    write_report(landing, 2025, 1, month_rows(3))
    run(warehouse, landing, str(tmp_path / "one"))
    before = fingerprint(warehouse.flights())
    run(warehouse, landing, str(tmp_path / "two"))  # a lost checkpoint sees every file again
    assert fingerprint(warehouse.flights()) == before


def test_old_files_count(warehouse, landing, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    write_report(landing, 2025, 1, month_rows(1))
    run(warehouse, landing, checkpoint)
    for month, days in ((2, 8), (3, 400)):
        path = write_report(landing, 2025, month, month_rows(month))
        then = time.time() - days * 86400
        os.utime(path, (then, then))
    run(warehouse, landing, checkpoint)
    assert warehouse.flights().count() == 6


def test_a_repaired_report_is_tried_again(warehouse, landing, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    write_report(landing, 2025, 1, [raw_row(CANCELLED="")])
    run(warehouse, landing, checkpoint)
    assert warehouse.ledger().first().status == "failed"
    write_report(landing, 2025, 1, month_rows(4))
    run(warehouse, landing, checkpoint)
    assert warehouse.flights().count() == 4 and warehouse.ledger().first().status == "success"


def test_a_report_in_parts_is_loaded_once(warehouse, landing, tmp_path, monkeypatch):
    loads = []
    real = streaming.load_reports
    monkeypatch.setattr(streaming, "load_reports", lambda w, reports, *a, **k: loads.append([r.file_name for r in reports]) or real(w, reports, *a, **k))
    folder, checkpoint = f"{landing}/2025_01_Report.csv", str(tmp_path / "checkpoint")
    for part in range(5):
        write_report(folder, 2025, 1, month_rows(2), name=f"part-{part}.csv")
    run(warehouse, landing, checkpoint, max_files=2)
    assert loads == [["2025_01_Report.csv"]] and warehouse.flights().count() == 10
    write_report(folder, 2025, 1, month_rows(2), name="part-9.csv")
    run(warehouse, landing, checkpoint, max_files=2)
    assert len(loads) == 2 and warehouse.flights().count() == 12


def test_marts_are_exported_once_per_run_and_only_after_changes(warehouse, landing, tmp_path, monkeypatch):
    exports, folder, checkpoint = [], str(tmp_path / "marts"), str(tmp_path / "checkpoint")
    real = pipeline.export_marts
    monkeypatch.setattr(pipeline, "export_marts", lambda *a: exports.append(a[1]) or real(*a))
    for month in (1, 2, 3):
        write_report(landing, 2025, month, month_rows(month))
    run(warehouse, landing, checkpoint, export_folder=folder, max_files=1)  # three micro-batches
    assert exports == [folder] and warehouse.flights().count() == 6
    marts = warehouse.spark.read.option("header", True).csv(f"{folder}/monthly_delays")
    assert sorted(int(r.n_flights) for r in marts.collect()) == [1, 2, 3]
    run(warehouse, landing, checkpoint, export_folder=folder)
    assert exports == [folder]
    write_report(landing, 2025, 4, month_rows(4))
    run(warehouse, landing, checkpoint, export_folder=folder)
    assert exports == [folder] * 2


def test_a_run_that_dies_loads_nothing_twice(warehouse, landing, tmp_path, monkeypatch):
    """The first run dies after its first batch; the next one takes up the remaining parts of a report that is loaded whole."""
    loads, real, checkpoint = [], streaming.load_reports, str(tmp_path / "checkpoint")
    for part in range(4):
        write_report(f"{landing}/2025_01_Report.csv", 2025, 1, month_rows(2), name=f"part-{part}.csv")

    def load(w, reports, *args):
        loads.append([r.file_name for r in reports])
        return real(w, reports, *args)

    def die(*args, **kwargs):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(streaming, "load_reports", load)
    with monkeypatch.context() as patch:
        patch.setattr(streaming, "collect_reports", lambda frame, seen=[]: die() if seen else seen.append(1) or R.collect_reports(frame))
        patch.setattr(streaming, "retry_failed", lambda *a: None)
        query = stream_reports(warehouse, landing, checkpoint, max_files=2)
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
    assert loads == [["2025_01_Report.csv"]] and warehouse.flights().count() == 8
    run(warehouse, landing, checkpoint, max_files=2)
    assert loads == [["2025_01_Report.csv"]] and warehouse.flights().count() == 8


def test_a_part_that_changed_is_read_again(warehouse, landing, tmp_path):
    path = write_report(landing, 2025, 1, month_rows(3))
    run(warehouse, landing, str(tmp_path / "one"))
    write_report(landing, 2025, 1, month_rows(5))
    later = time.time() + 5
    os.utime(path, (later, later))
    run(warehouse, landing, str(tmp_path / "two"))  # a lost checkpoint
    assert warehouse.flights().count() == 5
