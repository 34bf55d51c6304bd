"""Queries over the flight-shaped rows of the test tables.

Each takes ``(spark, sf_dir)`` and runs over the whole tables. Averages and
ratios are rounded to six places, so that two engines compare equal.
"""

from __future__ import annotations

import shutil
import uuid
import zipfile
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import calendar
from tarmac.operators import clean, encoding, evaluation, features, ledger, marts, quality, sampling, training
from tarmac.plans import pipeline, views
from tarmac.plans.ingest import ingest, load_reports
from tarmac.plans.train import Evaluation, train_and_evaluate
from tarmac.schema import ADDED_COLUMNS, CAUSES, FLIGHTS_SCHEMA, RAW_TO_CLEAN, TARGET
from tarmac.session import scratch_path, stored
from tarmac.sources import archives, reports
from tarmac.sources import tpch_flights as T
from tarmac.sources.warehouse import Warehouse
from tarmac.streaming.ingest import stream_reports

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6

#: bytes of a report that a task holds at a time while it zips it
PIECE = 1 << 20


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, DIGITS) for c in doubles})


# --- cleaning and views -----------------------------------------------------

def clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.flights(spark, sf_dir)


def flights_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.flights_base(T.flights(spark, sf_dir))


def _view(view: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(view(marts.flight_measures(T.flights(spark, sf_dir))))

    return query


def airport_delay_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = marts.flight_measures(T.flights(spark, sf_dir))
    return rounded(marts.airport_delay_stats(measures, true_rate=True))


def month_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.month_summary(T.flights(spark, sf_dir)))


def airline_month_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.airline_month_features(T.flights(spark, sf_dir)))


def route_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows have no origin and most no route, as in a table older than the column."""
    order = F.col("flight_number")
    old = T.flights(spark, sf_dir).withColumns({
        "origin": F.when(order % 5 != 0, F.col("origin")),
        "route": F.when(order % 3 == 0, F.lit("kept")),
    })
    return clean.add_route(old).select("row_key", "origin", "dest", "route")


def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before 1998 lack the columns that were added later.

    ``day_of_week`` comes out as a double: clients disagree on integers with gaps.
    """
    flights = stored(T.flights(spark, sf_dir).select("row_key", "year", *ADDED_COLUMNS), "flights")
    old = flights.where("year < 1998").drop(*ADDED_COLUMNS)
    both = clean.union_by_name([flights.where("year >= 1998"), old])
    rows = clean.add_missing_columns(both).select("row_key", "year", *ADDED_COLUMNS)
    return rows.withColumn("day_of_week", F.col("day_of_week").cast("double"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = T.flights(spark, sf_dir)
    return views.preview(flights.orderBy(*flights.columns))


# --- months and the load log ------------------------------------------------

def month_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected reports from the first month shipped to the month before the last shipping date."""
    ends = T.read_table(spark, sf_dir, "lineitem").select("l_shipdate").agg(
        F.min(F.to_date("l_shipdate")).alias("first"),
        calendar.previous_month(F.max(F.to_date("l_shipdate"))).alias("last"),
    )
    months = ends.withColumn("n_months", calendar.month_count(F.col("first"), F.col("last")))
    return calendar.explode_months(months, "first", "last").select("year", "month", "file_name", "n_months")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log with one attempt per day of the data; about a third of them failed."""
    lineitem = T.read_table(spark, sf_dir, "lineitem").select("l_shipdate")
    day = lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    failed = (F.day("day") * 7 + F.month("day")) % 3 == 0
    return day.select(
        calendar.report_name(F.year("day"), F.month("day")).alias("file_name"),
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.col("day").cast("timestamp").alias("ingested_at"),
        F.when(failed, 0).otherwise(F.col("n")).cast("long").alias("n_rows"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.day("day").cast("long").alias("seq"),
    )


def _as_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd"))


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even days are in the log already, odd days replace them by file name."""
    events = load_events(spark, sf_dir)
    return _as_date(ledger.upsert(events.where("seq % 2 = 0"), events.where("seq % 2 = 1")))


def ledger_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files known from February to November; only the others are inserted."""
    current = ledger.current_ledger(load_events(spark, sf_dir))
    return _as_date(ledger.insert_if_absent(current.where("month between 2 and 11"), current))


def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected reports that are there and were not loaded successfully yet."""
    current = ledger.current_ledger(load_events(spark, sf_dir))
    return ledger.pending(month_axis(spark, sf_dir), current).select("file_name", "year", "month")


def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.file_row_counts(T.flights(spark, sf_dir))


# --- training ---------------------------------------------------------------

KEY = (T.ROW_KEY,)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_rows(T.flights(spark, sf_dir), year=1997, keep=KEY)


def _all_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of all years, stored once: the operators below read them repeatedly."""
    return stored(training.training_rows(T.flights(spark, sf_dir), keep=KEY), "training-rows")


def label_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["row_key", "airline", "origin", "dest"]
    rows = stored(training.training_rows(T.flights(spark, sf_dir), keep=KEY).select(*columns), "training-codes")
    encoded = encoding.encode(rows, encoding.fit_encoder(rows))
    return encoded.withColumns({f"{c}_code": F.col(f"{c}_code").cast("int") for c in ["airline", "origin", "dest"]})


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sampling.stratified_split(_all_training_rows(spark, sf_dir), TARGET, key=KEY)
    part = [split.train.withColumn("part", F.lit("train")), split.test.withColumn("part", F.lit("test"))]
    return clean.union_by_name(part).select("row_key", TARGET, "part")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the classes in the training part."""
    rows = training.training_rows(T.flights(spark, sf_dir))
    sizes = sampling.class_sizes(sampling.class_counts(rows, TARGET), test_size=0.2)
    return rounded(training.class_weights(spark, {c: n for c, (n, _) in sizes.items()}))


def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.training_rows(T.flights(spark, sf_dir))
    sizes = sampling.class_sizes(sampling.class_counts(rows, TARGET), test_size=0.2)
    return rounded(training.split_summary(spark, sizes))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score with many ties: the departure delay; late if it is 15 minutes or more."""
    rows = training.training_rows(T.flights(spark, sf_dir))
    return rows.select(TARGET, F.col("dep_delay").alias("score"), (F.col("dep_delay") >= 15).cast("int").alias("guess"))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.roc_auc(_scored(spark, sf_dir), TARGET, "score"))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.classification_report(_scored(spark, sf_dir), TARGET, "guess"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_scored(spark, sf_dir), TARGET, "guess")


#: one fit per session and data folder, shared by the queries about it; what it holds lies in the shared folder
_forests: dict[tuple[str, str], Evaluation] = {}


def _forest(spark: SparkSession, sf_dir: str) -> Evaluation:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _forests:
        _forests[key] = train_and_evaluate(T.flights(spark, sf_dir))
    return _forests[key]


def delay_forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_forest(spark, sf_dir).predictions)


def forest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any forest: one row."""
    result = _forest(spark, sf_dir)
    seen = result.predictions.agg(
        F.count("*").alias("test_rows"),
        F.coalesce(F.sum("actual_arr_del15"), F.lit(0)).cast("long").alias("late_rows"),
        F.expr("count_if(delay_probability between 0 and 1)").alias("in_range"),
        F.expr("count_if(predicted_arr_del15 = cast(delay_probability > 0.5 as int) or delay_probability = 0.5)").alias("consistent"),
    )
    ranked = result.importance.agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("importance_sum"))
    return seen.join(ranked).join(result.roc_auc().select((F.col("roc_auc") > 0.9).alias("auc_above_0_9")))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_forest(spark, sf_dir).importance)


_season_models: dict[tuple[str, str], str] = {}


def _season_exports(spark: SparkSession, sf_dir: str) -> str:
    """The folder of exports of a forest whose predictions are known: whether a flight leaves in the second half of the year.

    It learns that in place of lateness from month and distance, is saved and loaded, and predicts the held-out flights.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _season_models:
        return _season_models[key]
    rows, used = _all_training_rows(spark, sf_dir), ["month", "distance"]
    encoder, binner = encoding.fit_encoder(rows), training.fit_bins(rows, used)

    def prepared(part: DataFrame) -> DataFrame:
        return training.assemble(encoding.encode(part, encoder), used, binner)

    seasons = rows.withColumn(TARGET, (F.col("month") >= 7).cast("int"))
    path = scratch_path(spark, "forest")
    training.fit_forest(prepared(seasons), used, encoder, {0: 1.0, 1: 1.0}, n_trees=4, max_depth=3, group=2).save(path)
    model = RandomForestClassificationModel.load(path)
    split = sampling.stratified_split(rows, TARGET, key=KEY)
    result = Evaluation(
        model=model, encoder=encoder, binner=binner, summary=training.split_summary(spark, split.sizes),
        predictions=training.predict(model, prepared(split.test), training.available_features(rows)),
        importance=training.feature_importance(spark, model, used),
    )
    folder = scratch_path(spark, "export")
    result.export(folder)
    _season_models[key] = folder
    return folder


def prediction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported predictions, read back."""
    numbers = ", ".join(f"{c} double" for c in ["dep_delay", "day_of_week", *CAUSES])
    schema = f"airline int, origin int, dest int, distance double, month int, {numbers.replace('day_of_week double', 'day_of_week int')}, "
    schema += "actual_arr_del15 int, predicted_arr_del15 int, delay_probability double"
    return rounded(spark.read.schema(schema).option("header", True).csv(f"{_season_exports(spark, sf_dir)}/delay_predictions"))


def importance_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported importances, read back, with their place in the file."""
    found = spark.read.schema("feature string, importance double").option("header", True).csv(f"{_season_exports(spark, sf_dir)}/feature_importance")
    return rounded(found.withColumn("place", F.monotonically_increasing_id() + 1))


def encoder_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes learned from the flights of one year, saved, loaded, and given to those of the next."""
    rows = training.training_rows(T.flights(spark, sf_dir).where("year in (1995, 1996)"), keep=(*KEY, "year")).select(*KEY, "year", "airline", "origin", "dest")
    rows, path = stored(rows, "training-codes"), scratch_path(spark, "encoder")
    encoding.save_encoder(encoding.fit_encoder(rows.where("year = 1995")), spark, path)
    encoded = encoding.encode(rows.where("year = 1996"), encoding.load_encoder(spark, path)).drop("year")
    return encoded.withColumns({f"{c}_code": F.col(f"{c}_code").cast("int") for c in ["airline", "origin", "dest"]})


# --- loading ----------------------------------------------------------------

def _table(warehouse: Warehouse) -> DataFrame:
    return warehouse.flights().select(*FLIGHTS_SCHEMA.names)


def _months(spark: SparkSession, sf_dir: str) -> dict[str, tuple[int, int]]:
    """First and last month shipped, as the range to load."""
    shipped = T.read_table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    first, last = shipped.agg(F.min("day"), F.max("day")).first()
    return {"start": (first.year, first.month), "end": (last.year, last.month)}


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, str, dict]:
    """A warehouse into which the reports of all rows were loaded, their folder and the months asked for."""
    landing, warehouse, months = scratch_path(spark, "landing"), _new_warehouse(spark), _months(spark, sf_dir)
    T.write_reports(spark, sf_dir, landing)
    ingest(warehouse, landing, **months)
    return warehouse, landing, months


def _new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def csv_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as monthly CSV reports and loaded back."""
    return _table(_loaded(spark, sf_dir)[0])


def dry_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loading the reports would do, month by month, without loading them."""
    landing = scratch_path(spark, "landing")
    T.write_reports(spark, sf_dir, landing)
    result = ingest(_new_warehouse(spark), landing, **_months(spark, sf_dir), dry_run=True)
    return result.report().select("file_name", "year", "month", "status", "n_rows")


def mart_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route statistics exported as CSV and read back."""
    view = marts.route_delay_stats(marts.flight_measures(T.flights(spark, sf_dir)))
    folder = scratch_path(spark, "export")
    views.export_csv(view, folder, single_file=True)
    return rounded(spark.read.schema(view.schema).option("header", True).csv(folder))


def marts_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded reports to airline statistics, by way of the stored summary."""
    landing = scratch_path(spark, "landing")
    T.write_reports(spark, sf_dir, landing)
    warehouse = _new_warehouse(spark)
    pipeline.run(warehouse, landing, **_months(spark, sf_dir))
    return rounded(views.select(spark, "SELECT * FROM v_airline_delay_stats"))


def _zip_each(csv_files: DataFrame, folder: str) -> None:
    """One archive per CSV part, named like the publisher's. A task streams parts into archives, so neither is ever whole in memory."""
    system, place = archives.file_system(folder)
    system.create_dir(place)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(*(column.to_pylist() for column in batch.columns)):
                (source, at), (target, to) = archives.file_system(path), archives.file_system(f"{folder}/{name}")
                unfinished = f"{to}.{uuid.uuid4().hex[:12]}"
                with source.open_input_stream(at, compression=None) as content, target.open_output_stream(unfinished, compression=None) as out:
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("report.csv", "w", force_zip64=True) as member:
                        shutil.copyfileobj(content, member, PIECE)
                target.move(unfinished, to)
            yield batch.select(["name"])

    name = F.format_string("on_time_%d_%d.zip", "year", "month").alias("name")
    period = calendar.with_report_period(csv_files.select("path")).select("path", name)
    period.mapInArrow(pack, "name string").write.format("noop").mode("overwrite").save()


def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as reports of one part, zipped, unpacked into a landing folder and loaded."""
    csv_folder, zips, landing = scratch_path(spark, "reports"), scratch_path(spark, "archives"), scratch_path(spark, "landing")
    T.write_reports(spark, sf_dir, csv_folder, one_part=True)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    _zip_each(files.load(csv_folder), zips)
    archives.land(archives.read_archives(spark, zips), landing)
    warehouse = _new_warehouse(spark)
    load_reports(warehouse, reports.collect_reports(reports.list_reports(spark, landing)))
    return _table(warehouse)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as reports and loaded by the streaming job."""
    landing = scratch_path(spark, "landing")
    T.write_reports(spark, sf_dir, landing)
    warehouse = _new_warehouse(spark)
    stream_reports(warehouse, landing, scratch_path(spark, "stream")).awaitTermination()
    return _table(warehouse)


def load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log, without its time, after reports of which those of March miss a flag on the first day."""
    landing, warehouse = scratch_path(spark, "landing"), _new_warehouse(spark)
    broken = F.when((F.col("MONTH") == 3) & (F.col("DAY_OF_MONTH") == 1), None).otherwise(F.col("CANCELLED"))
    T.write_reports(spark, sf_dir, landing, change=lambda rows: rows.withColumn("CANCELLED", broken))
    ingest(warehouse, landing, **_months(spark, sf_dir))
    return warehouse.ledger().select("file_name", "year", "month", "n_rows", "status")


def rerun_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per report after those of the first year were rerun with the first half of each month alone."""
    warehouse, _, months = _loaded(spark, sf_dir)
    again, year = scratch_path(spark, "landing"), months["start"][0]
    T.write_reports(spark, sf_dir, again, change=lambda rows: rows.where("DAY_OF_MONTH <= 15"))
    ingest(warehouse, again, months["start"], (year, 12), rerun=True)
    return ledger.file_row_counts(warehouse.flights())


def reset_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended, the tables emptied, and the rows appended again."""
    warehouse, rows = _new_warehouse(spark), stored(T.flights(spark, sf_dir).drop("row_key"), "flights")
    warehouse.create_tables()
    warehouse.append_flights(rows)
    warehouse.reset()
    warehouse.append_flights(rows)
    return _table(warehouse)


def ledger_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected reports with a successful load, by the log and by a query with a bound status."""
    current = ledger.current_ledger(load_events(spark, sf_dir))
    current.createOrReplaceTempView("load_events_log")
    asked = views.select(spark, "SELECT file_name, n_rows FROM load_events_log WHERE status = :status", {"status": "success"})
    known = ledger.already_loaded(month_axis(spark, sf_dir), current).select("file_name", "year", "month")
    newest = month_axis(spark, sf_dir).agg(F.max("file_name")).first()[0]
    return known.join(asked, "file_name").withColumn("newest_is_loaded", F.lit(ledger.is_loaded(current, newest)))


def ledger_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports marked as loaded, and whether the log has the time of the run, in whole seconds and in UTC."""
    warehouse, start = _new_warehouse(spark), datetime.now(UTC)
    counts = T.flights(spark, sf_dir).groupBy("source_file", "year", "month").agg(F.count("*").alias("n_rows"))
    warehouse.mark_loaded(counts.withColumnRenamed("source_file", "file_name").withColumn("status", F.lit("success")))
    text, at = ledger.time_text(F.col("ingested_at")), F.col("ingested_at")
    ends = [moment.strftime("%Y-%m-%d %H:%M:%S") for moment in (start, datetime.now(UTC))]
    return warehouse.ledger().select(
        "file_name", "n_rows", "status", (at == F.date_trunc("second", at)).alias("whole_seconds"), text.between(*ends).alias("within_run"),
    )


def ledger_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last ten reports of the log."""
    log = _as_date(ledger.current_ledger(load_events(spark, sf_dir)))
    return views.preview(log.orderBy(F.desc("file_name")).select("file_name", "year", "month", "ingested_at", "n_rows", "status"))


def repeat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run and a dry rerun did to each report, and whether they left the table as it was."""
    warehouse, landing, months = _loaded(spark, sf_dir)
    pipeline.publish(warehouse)
    before = quality.fingerprint(warehouse.flights())
    again = ingest(warehouse, landing, **months).report().select("file_name", F.col("status").alias("second_run"))
    after = quality.fingerprint(warehouse.flights())
    dry = ingest(warehouse, landing, **months, rerun=True, dry_run=True).report()
    tables = quality.tables_exist(spark, ["flights", "ingested_files"])
    same = before == after == quality.fingerprint(warehouse.flights())
    return again.join(dry.select("file_name", F.col("status").alias("dry_rerun"), "n_rows"), "file_name").withColumns({
        "unchanged": F.lit(same), "tables_exist": F.lit(all(tables.values())),
    })


def all_mart_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every exported mart; a second export that keeps what is there changes nothing."""
    warehouse, folder = _new_warehouse(spark), scratch_path(spark, "export")
    warehouse.create_tables()
    warehouse.append_flights(T.flights(spark, sf_dir))
    months = warehouse.flights().select("year", "month").distinct().collect()
    warehouse.refresh_summary({(row["year"], row["month"]) for row in months})
    views.export_marts(warehouse, folder)
    warehouse.reset()
    views.export_marts(warehouse, folder, overwrite=False)
    counts = [
        spark.read.option("header", True).csv(f"{folder}/{name.removeprefix('v_')}").agg(F.count("*").alias("n_rows")).withColumn("mart", F.lit(name))
        for name in marts.MEASURE_VIEWS
    ]
    return clean.union_by_name(counts).select("mart", "n_rows")


def stream_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly delays after two runs of the stream: the odd months land first, then the others."""
    landing, warehouse, checkpoint = scratch_path(spark, "landing"), _new_warehouse(spark), scratch_path(spark, "stream")
    for odd in (1, 0):
        T.write_reports(spark, sf_dir, f"{landing}/{odd}", change=lambda rows, odd=odd: rows.where(f"MONTH % 2 = {odd}"))
        stream_reports(warehouse, landing, checkpoint).awaitTermination()
    return rounded(views.select(spark, "SELECT * FROM v_monthly_delays"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flight_checks(T.flights(spark, sf_dir), list(RAW_TO_CLEAN.values()))


QUERIES: dict[str, Query] = {
    "clean_flights": clean_flights,
    "flights_base": flights_base,
    "airline_delay_stats": _view(marts.airline_delay_stats),
    "monthly_delays": _view(marts.monthly_delays),
    "airline_month_base": _view(marts.airline_month),
    "airline_rolling_metrics": _view(marts.airline_rolling_metrics),
    "airline_vs_month_avg": _view(marts.airline_vs_month_avg),
    "delay_causes_by_airline": _view(marts.delay_causes_by_airline),
    "route_delay_stats": _view(marts.route_delay_stats),
    "airport_delay_stats": airport_delay_stats,
    "month_summary": month_summary,
    "airline_month_features": airline_month_features,
    "month_axis": month_axis,
    "ledger_pending": ledger_pending,
    "ledger_upsert": ledger_upsert,
    "ledger_insert_if_absent": ledger_insert_if_absent,
    "route_backfill": route_backfill,
    "schema_evolution_union": schema_evolution_union,
    "file_row_counts": file_row_counts,
    "training_rows": training_rows,
    "label_encoding": label_encoding,
    "stratified_split": stratified_split,
    "class_weights": class_weights,
    "split_summary": split_summary,
    "roc_auc": roc_auc,
    "classification_report": classification_report,
    "confusion_matrix": confusion_matrix,
    "preview": preview,
    "quality_report": quality_report,
    "csv_ingest_roundtrip": csv_ingest_roundtrip,
    "dry_run_report": dry_run_report,
    "marts_from_summary": marts_from_summary,
    "mart_exports": mart_exports,
    "zip_ingest": zip_ingest,
    "stream_ingest": stream_ingest,
    "delay_forest_predictions": delay_forest_predictions,
    "feature_importance": feature_importance,
    "forest_checks": forest_checks,
    "prediction_export": prediction_export,
    "importance_export": importance_export,
    "encoder_reload": encoder_reload,
    "ledger_time": ledger_time,
    "load_failures": load_failures,
    "rerun_replaces": rerun_replaces,
    "reset_then_load": reset_then_load,
    "ledger_loaded": ledger_loaded,
    "ledger_preview": ledger_preview,
    "repeat_runs": repeat_runs,
    "all_mart_exports": all_mart_exports,
    "stream_marts": stream_marts,
}
