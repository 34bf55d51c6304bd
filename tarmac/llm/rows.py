"""Rows that are passed through an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wrapped(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``doc``, so that no name clashes with those given beside it; ``select("doc.*")`` unwraps."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[c.alias(name) for name, c in columns.items()])


def text_of(text_col: str) -> Column:
    return F.col(f"`{text_col}`").cast("string")
