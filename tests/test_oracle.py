"""Every query with SQL gives the same rows in DuckDB, over whole tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def canonical(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    rows = df.astype(object).where(df.notna(), None).values.tolist()
    return sorted(repr([int(v) if isinstance(v, float) and v.is_integer() else v for v in row]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_rows_in_both_engines(spark, duck, name):
    ours = entry_points.queries()[name](spark, SF).toPandas()
    theirs = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert canonical(ours) == canonical(theirs)


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["year", "month", "airline"]
    assert df.count() > 0
