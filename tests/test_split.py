import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.operators import sampling
from tarmac.operators.sampling import class_sizes, stratified_split


def counts(df, label="y"):
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def multiset(df):
    return Counter(map(tuple, df.collect()))


def numbered(spark, n, every=5):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") % every == 0).cast("int").alias("y"))


@pytest.mark.parametrize("n0, n1", [(80, 20), (81, 20), (7, 3), (1000, 1), (13, 13)])
def test_sizes(n0, n1):
    sizes = class_sizes({0: n0, 1: n1}, 0.2)
    assert sum(test for _, test in sizes.values()) == math.ceil(0.2 * (n0 + n1))
    assert all(train + test == n for (train, test), n in zip(sizes.values(), (n0, n1)))
    assert all(abs(test - 0.2 * n) <= 1 for (_, test), n in zip(sizes.values(), (n0, n1)))


def test_same_rows_as_sorting_each_class_by_hash(spark):
    df = numbered(spark, 3001)
    split = stratified_split(df, "y", 0.2, seed=7, key=("k",))
    rows = df.collect()
    expected = set()
    for cls, (_, n_test) in split.sizes.items():
        keys = sorted((r.k for r in rows if r.y == cls), key=lambda k: hashlib.md5(f"7:{k}".encode()).hexdigest())
        expected |= set(keys[:n_test])
    assert {r.k for r in split.test.collect()} == expected
    assert {r.k for r in split.train.collect()} == {r.k for r in rows} - expected


def test_whole_row_as_key_and_seed(spark):
    df = numbered(spark, 2000)
    one, same, other = (stratified_split(df, "y", seed=s) for s in (1, 1, 2))
    assert counts(one.test) == {0: 320, 1: 80} and counts(one.train) == {0: 1280, 1: 320}
    assert multiset(one.test) == multiset(same.test) != multiset(other.test)
    assert multiset(one.test) + multiset(one.train) == multiset(df)


@pytest.mark.parametrize("key", [(), ("k",)])
def test_sizes_stay_exact_with_many_copies(spark, key, monkeypatch):
    monkeypatch.setattr(sampling, "_COPIES_PER_ROW", 64)
    copies = spark.range(1500).select(F.lit("same").alias("k"), F.lit(0).alias("y"))
    df = numbered(spark, 1000).unionByName(copies)
    for seed in range(4):
        split = stratified_split(df, "y", 0.2, seed=seed, key=key)
        assert counts(split.test) == {c: t for c, (_, t) in split.sizes.items()}
        assert multiset(split.test) + multiset(split.train) == multiset(df)


def test_all_rows_equal(spark):
    df = spark.range(100).select(F.lit("same").alias("k"), F.lit(1).alias("y"))
    split = stratified_split(df, "y", 0.25)
    assert (split.train.count(), split.test.count()) == (75, 25)


def test_a_key_that_is_not_unique_splits_by_the_whole_row(spark):
    df = spark.range(400).select(F.lit("one").alias("k"), F.lit(0).alias("y"), F.col("id").alias("v"))
    split = stratified_split(df, "y", 0.2, key=("k",))
    assert (split.train.count(), split.test.count()) == (320, 80)
    assert multiset(split.test) + multiset(split.train) == multiset(df)


def test_nulls_in_columns(spark):
    df = spark.range(50).select(F.lit(None).cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    split = stratified_split(df, "y", 0.2)
    assert counts(split.test) == {0: 5, 1: 5}
