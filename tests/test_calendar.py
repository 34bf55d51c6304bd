from pyspark.sql import functions as F

from tarmac.functions import calendar


def test_range_over_a_year_boundary(spark):
    rows = calendar.month_axis(spark, (2024, 11), (2025, 2)).collect()
    assert [r.file_name for r in rows] == [
        "2024_11_Report.csv", "2024_12_Report.csv", "2025_01_Report.csv", "2025_02_Report.csv",
    ]
    assert [(r.year, r.month) for r in rows] == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_empty_and_single_month_range(spark):
    assert calendar.month_axis(spark, (2025, 2), (2025, 1)).count() == 0
    assert calendar.month_axis(spark, (2025, 2), (2025, 2)).count() == 1


def test_month_count(spark):
    first, last = F.lit("2024-11-30").cast("date"), F.lit("2025-02-01").cast("date")
    assert spark.range(1).select(calendar.month_count(first, last).alias("n")).first().n == 4


def test_default_period_is_the_month_before(spark):
    assert calendar.default_period(spark, "2025-01-15") == (2024, 12)
    assert calendar.default_period(spark, "2025-07-01") == (2025, 6)
    year, month = calendar.default_period(spark)
    assert year >= 2024 and 1 <= month <= 12


def test_names_are_read_off_files_and_folders(spark):
    paths = ["file:/a/2025_01_Report.csv", "s3://b/c/file_name=2024_12_Report.csv/part-0.csv", "/a/x2025_01_Report.csv", "/a/2025_1.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = calendar.with_report_period(df.withColumn("path", calendar.report_path(F.col("path"))).where("path != ''")).collect()
    assert [(r.path, r.file_name, r.year, r.month) for r in got] == [
        ("file:/a/2025_01_Report.csv", "2025_01_Report.csv", 2025, 1),
        ("s3://b/c/file_name=2024_12_Report.csv", "2024_12_Report.csv", 2024, 12),
    ]


def test_months_from_a_report_by_its_name(spark):
    names = [("2025_01_Report.csv", 2025, 3), ("2024_12_Report.csv", 2025, 1), ("a/2025_01_Report.csv/part", 2024, 12), ("2025_01_Report.csv", None, 1)]
    rows = spark.createDataFrame(names, "file_name string, year int, month int")
    away = calendar.months_from_report(F.col("file_name"), F.col("year"), F.col("month"))
    assert [r.away for r in rows.select(away.alias("away")).collect()] == [2, 1, -1, None]
