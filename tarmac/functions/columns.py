"""Column expressions: routes, ratios, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schema import CAUSES


def route(origin: str = "origin", dest: str = "dest") -> Column:
    """``ORIGIN-DEST``; NULL if either end is."""
    return F.concat(F.col(origin), F.lit("-"), F.col(dest))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating ratio, NULL for an empty denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def is_operated() -> Column:
    return F.col("cancelled") == 0


def has_delay_cause() -> Column:
    return F.expr(" OR ".join(f"{c} > 0" for c in CAUSES))


def all_present(columns: list[str]) -> Column:
    """No column is NULL. Unlike ``dropna``, each test can reach the Parquet scan."""
    return F.expr(" AND ".join(f"{c} IS NOT NULL" for c in columns))
