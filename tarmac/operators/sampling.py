"""Exact stratified train/test split without sorting a class in one task.

Rows are ordered by a seeded hash; the first rows of each class, up to its
exact share, form the test part. Sorting a class to find that position would
put most of the data in one window, so the position is found from counts:

1. counts of the first three hash digits per class (at most 4,096 per class), and
   the same again for six digits inside the one prefix that holds the position;
2. counts per full hash inside the longer prefix, which gives the cut of a class;
3. every row is then compared with the cut of its class.

Rows that share the cut share the key; a second hash, of the whole row, decides
among them. What still ties are copies of one row. They are collapsed to a count
before any shuffle and dealt to both parts by number, so that the sizes stay
exact however many copies there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_DIGITS = [3, 6, 32]  # hex digits compared, coarse to complete
_COPIES_PER_ROW = 100_000  # copies that one row expands to


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame
    sizes: dict  # class -> (train rows, test rows)


def key_hash(seed: int, key: Sequence[str]) -> Column:
    """MD5 of seed and key: the same order in any engine."""
    return F.md5(F.concat_ws(":", F.lit(seed), *key))


def row_hash(seed: int, columns: Sequence[str]) -> Column:
    """64-bit hash of the whole row, without turning its columns into text."""
    return F.lpad(F.hex(F.xxhash64(F.lit(seed), *columns)), 16, "0")


def class_sizes(counts: dict, test_size: float) -> dict:
    """(train, test) rows per class.

    The test part has ``ceil(test_size * n)`` rows; train rows are shared out in
    proportion, rounded by largest remainder (the smaller class value on a tie).
    """
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    floors = {c: k * n_train // n for c, k in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))
    for c in by_remainder[: n_train - sum(floors.values())]:
        floors[c] += 1
    return {c: (floors[c], counts[c] - floors[c]) for c in counts}


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class; the driver gets one row per class."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def _per_class(label: str, values: dict) -> Column:
    """The value of a row's class, as an expression."""
    column = F.lit(None)
    for cls, value in values.items():
        column = F.when(F.col(label) == cls, F.lit(value)).otherwise(column)
    return column


def _counts(rows: DataFrame, label: str, value: Column) -> DataFrame:
    return rows.groupBy(label, value.alias("value")).agg(F.count("*").alias("n"))


def _locate(counts: DataFrame, label: str, position: dict) -> dict:
    """class -> (value that holds the class's position, rows before it, rows that share it)."""
    upto = F.sum("n").over(W.partitionBy(label).orderBy("value"))
    target = _per_class(label, position)
    holds = (F.col("upto") >= target) & (F.col("upto") - F.col("n") < target)
    hits = counts.withColumn("upto", upto).where(holds).collect()
    return {r[label]: (r["value"], r["upto"] - r["n"], r["n"]) for r in hits}


def stratified_split(
    df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42, key: Sequence[str] = ()
) -> Split:
    """Splits ``df`` by class, keeping the share of each class in both parts.

    ``key`` names columns that identify a row; without it the whole row does.
    ``df`` is read several times, so pass a stored table.
    """
    hashes = [key_hash(seed, key)] if key else []
    hashes.append(row_hash(seed, df.columns))

    coarse = _counts(df, label, F.substring(hashes[0], 1, _DIGITS[0])).persist()
    try:
        totals = coarse.groupBy(label).agg(F.sum("n").alias("n")).collect()
        sizes = class_sizes({r[label]: r["n"] for r in totals}, test_size)
        position = {c: test for c, (_, test) in sizes.items() if test > 0}
        found = _locate(coarse, label, position)
    finally:
        coarse.unpersist()

    before, tied = F.lit(False), F.col(label).isin(list(position))
    for hashed in hashes:
        rows = undecided = df.where(tied)
        for digits in _DIGITS:
            prefix = F.substring(hashed, 1, digits)
            if found is None:
                found = _locate(_counts(undecided, label, prefix), label, position)
            position = {c: position[c] - skipped for c, (_, skipped, _) in found.items()}
            sharing = {c: n for c, (_, _, n) in found.items()}
            cut = _per_class(label, {c: value for c, (value, _, _) in found.items()})
            undecided, found = rows.where(prefix == cut), None
        before = before | (tied & (hashed < cut))
        tied = tied & (hashed == cut)
        if position == sharing:
            in_test = F.coalesce(before | tied, F.lit(False))
            return Split(df.where(~in_test), df.where(in_test), sizes)

    # the first `position` copies of the row at the cut belong to the test part
    columns = df.columns
    copies = df.where(tied).groupBy(*columns).agg(F.count("*").alias("_n"))
    w = W.partitionBy(label).orderBy(*columns).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = F.sum("_n").over(w) - F.col("_n")
    to_test = F.least(F.greatest(_per_class(label, position) - earlier, F.lit(0)), F.col("_n"))
    dealt = copies.withColumn("_test", to_test)
    after = ~F.coalesce(before | tied, F.lit(False))
    return Split(
        train=df.where(after).unionByName(_copies(dealt, F.col("_n") - F.col("_test"), columns)),
        test=df.where(F.coalesce(before, F.lit(False))).unionByName(_copies(dealt, F.col("_test"), columns)),
        sizes=sizes,
    )


def _copies(rows: DataFrame, n: Column, columns: list[str]) -> DataFrame:
    """Each row ``n`` times; many copies are first spread over tasks in portions."""
    portions = F.sequence(F.lit(0).cast("long"), F.col("_left") - 1, F.lit(_COPIES_PER_ROW).cast("long"))
    spread = (
        rows.withColumn("_left", n)
        .where("_left > 0")
        .withColumn("_start", F.explode(portions))
        .repartition("_start")
    )
    size = F.least(F.lit(_COPIES_PER_ROW), F.col("_left") - F.col("_start")).cast("int")
    return spread.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), size))).select(*columns)
