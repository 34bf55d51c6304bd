"""Integer codes for categorical columns."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import CATEGORICAL_FEATURES


def fit_encoder(
    df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES, on_unseen: str = "error"
) -> StringIndexerModel:
    """Codes from 0 in sorted order of the values.

    ``on_unseen`` is what a value without a code does later: ``error``, or
    ``keep`` to give all such values one extra code.
    """
    indexer = StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid=on_unseen,
    )
    return indexer.fit(as_text(df, columns))


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def encode(df: DataFrame, encoder: StringIndexerModel) -> DataFrame:
    """Adds ``<column>_code`` for each encoded column."""
    return encoder.transform(as_text(df, encoder.getInputCols()))


#: one row per value that has a code; ``on_unseen`` repeats in all of them
ENCODER_SCHEMA = "column string, code int, value string, on_unseen string"


def save_encoder(encoder: StringIndexerModel, spark: SparkSession, path: str) -> None:
    """Writes the codes as a table, to encode later data alike; an existing one is not overwritten."""
    on_unseen = encoder.getHandleInvalid()
    rows = [
        (column, code, value, on_unseen)
        for column, values in zip(encoder.getInputCols(), encoder.labelsArray)
        for code, value in enumerate(values)
    ]
    spark.createDataFrame(rows, ENCODER_SCHEMA).coalesce(1).write.parquet(path)


def load_encoder(spark: SparkSession, path: str, columns: list[str] = CATEGORICAL_FEATURES) -> StringIndexerModel:
    """The encoder of a saved table. Codes must be there for all ``columns`` and run from 0 without gaps."""
    values: dict[str, list[str]] = {c: [] for c in columns}
    on_unseen = "error"
    for row in spark.read.schema(ENCODER_SCHEMA).parquet(path).where(F.col("column").isin(columns)).orderBy("column", "code").collect():
        if row["code"] != len(values[row["column"]]):
            raise ValueError(f"codes of {row['column']} in {path} have gaps or repeats at {row['code']}")
        values[row["column"]].append(row["value"])
        on_unseen = row["on_unseen"]
    if absent := [c for c, found in values.items() if not found]:
        raise ValueError(f"{path} has no codes of {', '.join(absent)}")
    return StringIndexerModel.from_arrays_of_labels(
        [values[c] for c in columns], inputCols=columns, outputCols=[f"{c}_code" for c in columns], handleInvalid=on_unseen
    )
