"""The forest depends on rows and seed alone."""

import math

import pytest
from pyspark.sql import functions as F

from tarmac.operators import encoding, training
from tarmac.session import stored
from tarmac.sources import tpch_flights as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return stored(training.training_rows(T.flights(spark, SF)), "rows")


def fitted(rows, **options):
    features = training.available_features(rows)
    encoder, binner = encoding.fit_encoder(rows), training.fit_bins(rows, features)
    ready = training.assemble(encoding.encode(rows, encoder), features, binner)
    model = training.fit_forest(ready, features, encoder, {0: 0.61, 1: 2.7}, max_depth=6, **options)
    return model, {tuple(r) for r in training.predict(model, ready, features).collect()}


def test_the_same_forest_from_any_partitioning(spark, rows):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.files.openCostInBytes")}
    found = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # every stored part is a partition of its own
        for n in (8, 32, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            found.append(fitted(rows.repartition(n), n_trees=4, group=2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    model, predictions = found[0]
    assert len(model.trees) == 4 and len({t.toDebugString for t in model.trees}) == 4
    for other, same in found[1:]:
        assert same == predictions
        assert [t.toDebugString.split("\n", 1)[1] for t in other.trees] == [t.toDebugString.split("\n", 1)[1] for t in model.trees]
        assert other.featureImportances == model.featureImportances


def test_groups_and_seeds_give_other_trees(rows):
    _, one = fitted(rows, n_trees=2, group=1)
    _, two = fitted(rows, n_trees=2, group=1, seed=7)
    assert one != two


def test_bootstrap_counts_are_poisson(spark):
    drawn = spark.range(40_000).select(*[training.bootstrap_count(F.xxhash64("id"), F.lit(m).cast("long"), draw, 42).alias(f"n{m}_{draw}") for m, draw in [(1, 0), (1, 1), (5, 0), (400, 0)]])
    for name, m in [("n1_0", 1), ("n1_1", 1), ("n5_0", 5), ("n400_0", 400)]:
        mean, spread = drawn.agg(F.avg(name), F.variance(name)).first()
        assert mean == pytest.approx(m, abs=5 * math.sqrt(m / 40_000)) and spread == pytest.approx(m, rel=0.06)
    assert abs(drawn.agg(F.corr("n1_0", "n1_1")).first()[0]) < 0.03
    none = drawn.where("n1_0 = 0").count() / 40_000
    assert none == pytest.approx(math.exp(-1), abs=0.01)


def test_cuts_have_parts_of_similar_size():
    assert training._cuts([(1.0, 5)], 4) == [-math.inf, 1.0, math.inf]
    assert training._cuts([], 4) == [-math.inf, 0.0, math.inf]
    counts = [(float(v), 10) for v in range(100)] + [(500.0, 5000)] + [(600.0 + v, 1) for v in range(3)]
    cuts = training._cuts(counts, 32)
    sizes = [sum(n for v, n in counts if low < v <= high) for low, high in zip(cuts, cuts[1:])]
    assert sum(sizes) == 6003 and len(sizes) <= 33 and min(sizes) >= 6003 / 64


def test_a_saved_forest_is_the_same(rows, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel

    model, _ = fitted(rows, n_trees=3, group=2)
    model.save(str(tmp_path / "forest"))
    again = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert [t.toDebugString.split("\n", 1)[1] for t in again.trees] == [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_counts_of_a_draw_are_the_steps_of_the_distribution(spark):
    upto = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(14)]
    given = [0.0, 0.2, 0.37, 0.5, 0.9, 0.99, 0.9999, 1 - 2**-53]
    found = spark.createDataFrame([(u,) for u in given], "u double").select(training._poisson(F.col("u"))).collect()
    assert [row[0] for row in found] == [sum(u >= x for x in upto) for u in given]


@pytest.mark.parametrize("most", [1, training.ROWS_AT_ONCE])
def test_many_rows_are_fitted_one_group_at_a_time(rows, monkeypatch, most):
    running, seen = [], []

    class Watched(training.RandomForestClassifier):
        def fit(self, dataset):
            running.append(self)
            seen.append((len(running), sorted(dataset.columns), self.getCacheNodeIds()))
            try:
                return super().fit(dataset)
            finally:
                running.remove(self)

    monkeypatch.setattr(training, "RandomForestClassifier", Watched)
    monkeypatch.setattr(training, "ROWS_AT_ONCE", most)
    model, _ = fitted(rows, n_trees=3, group=1)
    assert len(model.trees) == 3 and len(seen) == 3 and all(cached for _, _, cached in seen)
    assert (max(n for n, _, _ in seen) == 1) == (most == 1)
