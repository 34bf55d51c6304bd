"""Rows, weights and the classifier for late arrivals."""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators.marts import operated
from tarmac.schema import BASE_FEATURES, CATEGORICAL_FEATURES, OPTIONAL_FEATURES, TARGET
from tarmac.session import scratch_path, session_beside

#: bins of a numeric feature; trees that share a bootstrap draw and are fitted in one pass; passes at the same time
BINS, GROUP, AT_ONCE = 32, 10, 4
#: different rows that passes at the same time may hold in memory, at about 450 bytes each, unless one pass alone has more
ROWS_AT_ONCE = 30_000_000
#: bytes of stored rows in one task of a fit, which holds some 20 times as many in memory
TASK_BYTES = 8 << 20
#: class weights are multiples of this, so that sums over up to 10**11 rows are exact in any order
WEIGHT_STEP = 2.0**-16
#: copies of a row up to which each is drawn by itself; beyond, their sum is drawn as a whole
FEW_COPIES = 16

#: features known before departure: no delay and no cause of it
PRE_DEPARTURE = ["distance", "month", "day_of_week"]


def available_features(df: DataFrame, pre_departure: bool = False) -> list[str]:
    """Feature columns in order; optional ones only if the data has them."""
    optional = [c for c in OPTIONAL_FEATURES if c in df.columns]
    features = [*CATEGORICAL_FEATURES, *BASE_FEATURES, *optional]
    if pre_departure:
        features = [c for c in features if c in [*CATEGORICAL_FEATURES, *PRE_DEPARTURE]]
    return features


def training_rows(flights: DataFrame, year: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features and target of operated flights, of one year if given, without incomplete rows."""
    rows = operated(flights)
    if year is not None:
        rows = rows.where(F.col("year") == year)
    columns = [*available_features(flights), TARGET]
    return rows.select(*keep, *columns).where(C.all_present(columns))


def balanced_weights(counts: dict) -> dict:
    """class -> n / (number of classes * rows of the class)."""
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in counts.items()}


def weight_column(weights: dict, label: str = TARGET) -> Column:
    column = F.lit(None).cast("double")
    for cls, weight in weights.items():
        column = F.when(F.col(label) == cls, F.lit(float(weight))).otherwise(column)
    return column


def split_summary(spark: SparkSession, sizes: dict) -> DataFrame:
    """One row: sizes of both parts and the share of late flights.

    ``sizes`` are the exact (train, test) rows per class that the split was cut
    to, so nothing has to be read again.
    """
    train, test = (sum(size[i] for size in sizes.values()) for i in (0, 1))
    late = sum(sizes.get(1, (0, 0)))
    rate = late / (train + test) if train + test else None
    return spark.createDataFrame([(train, test, rate)], "train_size long, test_size long, delay_rate double")


def class_weights(spark: SparkSession, counts: dict, label: str = TARGET) -> DataFrame:
    """``(<label>, n_rows, weight)``: one row per class."""
    weights = balanced_weights(counts)
    rows = [(cls, n, weights[cls]) for cls, n in sorted(counts.items())]
    return spark.createDataFrame(rows, f"{label} int, n_rows long, weight double")


def model_inputs(features: list[str]) -> list[str]:
    return [f"{c}_code" if c in CATEGORICAL_FEATURES else f"{c}_bin" for c in features]


def fit_bins(rows: DataFrame, features: list[str], bins: int = BINS) -> Bucketizer:
    """Cuts of the numeric features into at most ``bins`` parts of similar size.

    Cut points come from counts of values at three significant digits, whose number does not grow with the rows (minutes,
    miles and months have a few thousand); the driver gets one row per feature and value. Being exact counts, they do not depend on partitions or row order,
    and every part has at least half its share of the rows.
    """
    numeric = [c for c in features if c not in CATEGORICAL_FEATURES]
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.expr(f"double(format_string('%.2e', double({c})))").alias("value")) for c in numeric]))
    counts: dict[str, list] = {c: [] for c in numeric}
    for row in rows.select(values.alias("v")).groupBy("v.feature", "v.value").count().orderBy("feature", "value").collect():
        counts[row["feature"]].append((row["value"], row["count"]))
    return Bucketizer(inputCols=numeric, outputCols=[f"{c}_bin" for c in numeric], splitsArray=[_cuts(counts[c], bins) for c in numeric])


def _cuts(counts: list[tuple[float, int]], bins: int) -> list[float]:
    """Midpoints between neighbouring values, from minus to plus infinity."""
    total, filled, left, cuts = sum(n for _, n in counts), 0, sum(n for _, n in counts), []
    for (value, n), (following, _) in zip(counts, counts[1:]):
        filled, left = filled + n, left - n
        # a part is full at its share; a value that alone has a share ends a part that is half full, the last part is half full at least
        full = total / 2 if n * bins >= total else total
        if filled * bins >= full and left * bins >= total / 2:
            cuts.append((value + following) / 2)
            filled = 0
    # one cut at least, as the splitter needs two parts
    return [-math.inf, *(cuts or [counts[0][0] if counts else 0.0]), math.inf]


def assemble(encoded: DataFrame, features: list[str], binner: Bucketizer) -> DataFrame:
    """Adds binned numbers and the ``features`` vector; codes keep their nominal meaning."""
    numeric = binner.getInputCols()
    kept = binner.transform(encoded.withColumns({c: F.col(c).cast("double") for c in numeric}))
    kept = kept.withColumns({c: F.col(c).cast(encoded.schema[c].dataType) for c in numeric})
    return VectorAssembler(inputCols=model_inputs(features), outputCol="features").transform(kept)


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 1 that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def _poisson(u: Column) -> Column:
    """The Poisson count of mean one at the quantile ``u``, which is computed about twice: cases end at the first that holds."""
    upto, count = 0.0, F
    for k in range(14):
        upto += math.exp(-1) / math.factorial(k)
        count = count.when(u < upto, F.lit(k))
    return count.otherwise(F.lit(14))


def bootstrap_count(row: Column, copies: Column, draw: int | Column, seed: int) -> Column:
    """How often ``copies`` equal rows with the hash ``row`` are in a bootstrap draw: a Poisson count of that mean.

    It depends on the row, the draw and the seed, so not on partitions, files or cores.
    """
    t, s = F.lit(draw), F.lit(seed)
    each = F.aggregate(F.sequence(F.lit(1), F.least(copies, F.lit(FEW_COPIES)).cast("int")), F.lit(0), lambda n, i: n + _poisson(_uniform(row, t, s, i)))
    normal = F.sqrt(-2 * F.log(1 - _uniform(row, t, s, F.lit("r")))) * F.cos(2 * math.pi * _uniform(row, t, s, F.lit("a")))
    many = F.greatest(F.lit(0), F.round(copies + F.sqrt(copies.cast("double")) * normal).cast("long"))
    return F.when(copies == 1, _poisson(_uniform(row, t, s, F.lit(1)))).when(copies <= FEW_COPIES, each).otherwise(many)


def fit_forest(
    train: DataFrame,
    features: list[str],
    encoder: StringIndexerModel,
    weights: dict,
    n_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    group: int = GROUP,
) -> RandomForestClassificationModel:
    """A class-weighted random forest over assembled rows.

    A nominal feature needs a bin per value, so ``maxBins`` follows the encoder. Equal rows (of binned features and target) are counted
    first, on the map side, and stored with their counts in all draws, since a fit reads its rows three times. Trees are fitted in groups to these rows, weighted by how often the group's bootstrap draws them
    (``bootstrap_count``); the trees of a group differ by the features they may split on. ``group=1`` gives every tree a draw of its own, at the price of more passes.
    Memory holds the rows of at most ``AT_ONCE`` groups, and of fewer where they have more than ``ROWS_AT_ONCE``. Weights are multiples of a power of two and add up exactly, so the same rows
    and seed give the same forest however the rows are partitioned. One model is made of all trees.
    """
    spark = train.sparkSession
    bins = max(BINS, max(len(labels) for labels in encoder.labelsArray) + 1)
    inputs = model_inputs(features)
    starts = range(0, n_trees, group)
    rows = train.groupBy(*inputs, TARGET).agg(F.count("*").alias("_copies")).withColumn("_row", F.xxhash64(*inputs, TARGET))
    draws = F.transform(F.array(*map(F.lit, starts)), lambda draw: bootstrap_count(F.col("_row"), F.col("_copies"), draw, seed).cast("long"))
    rows = rows.select(*inputs, TARGET, draws.alias("_draws")).select(*inputs, TARGET, *[F.col("_draws")[i].alias(f"_draw{start}") for i, start in enumerate(starts)])
    rows = _in_small_tasks(rows, "forest-rows")
    at_once = max(1, min(AT_ONCE, ROWS_AT_ONCE // max(1, rows.count())))
    # the metadata that tells nominal codes from numbers does not survive storing
    rows = rows.withMetadata(inputs[0], train.schema[inputs[0]].metadata)
    for c in inputs[1:]:
        rows = rows.withMetadata(c, train.schema[c].metadata)
    steps = {c: max(1, round(w / WEIGHT_STEP)) * WEIGHT_STEP for c, w in weights.items()}

    def fit_group(start: int) -> RandomForestClassificationModel:
        forest = RandomForestClassifier(
            labelCol=TARGET,
            featuresCol="features",
            weightCol="_weight",
            numTrees=min(group, n_trees - start),
            bootstrap=False,
            maxDepth=max_depth,
            maxBins=bins,
            featureSubsetStrategy="sqrt",
            seed=seed + start,
            maxMemoryInMB=1024,
            # else every row walks down every tree from its root on each level
            cacheNodeIds=True,
        )
        drawn = rows.withColumn("_weight", F.col(f"_draw{start}") * weight_column(steps)).where("_weight > 0")
        return forest.fit(VectorAssembler(inputCols=inputs, outputCol="features").transform(drawn).select("features", TARGET, "_weight"))

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return _ensemble(spark, list(pool.map(fit_group, starts)))


def _in_small_tasks(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored and read back by tasks of ``TASK_BYTES``, for rows that take far more memory than bytes in files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", TASK_BYTES).parquet(path)
    reading = session_beside(df.sparkSession, **{"spark.sql.files.maxPartitionBytes": str(TASK_BYTES)})
    return reading.read.schema(df.schema).parquet(path)


def _ensemble(spark: SparkSession, models: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One model of the trees of several; it averages their probabilities."""
    jvm = spark.sparkContext._jvm.org.apache.spark.ml.classification
    found = [tree for model in models for tree in model._java_obj.trees()]
    trees = spark.sparkContext._gateway.new_array(jvm.DecisionTreeClassificationModel, len(found))
    for i, tree in enumerate(found):
        trees[i] = tree
    whole = jvm.RandomForestClassificationModel(f"forest_{uuid.uuid4().hex[:12]}", trees, models[0].numFeatures, models[0].numClasses)
    return RandomForestClassificationModel(whole).setFeaturesCol("features")._set(numTrees=len(found))


def predict(model: RandomForestClassificationModel, rows: DataFrame, features: list[str]) -> DataFrame:
    """Held-out rows with codes, actual and predicted class and probability; original values last."""
    scored = model.transform(rows)
    codes = [F.col(f"{c}_code").cast("int").alias(c) for c in CATEGORICAL_FEATURES]
    names = [F.col(c).alias(f"{c}_value") for c in CATEGORICAL_FEATURES]
    return scored.select(
        *codes,
        *[c for c in features if c not in CATEGORICAL_FEATURES],
        F.col(TARGET).alias("actual_arr_del15"),
        F.col("prediction").cast("int").alias("predicted_arr_del15"),
        vector_to_array("probability")[1].alias("delay_probability"),
        *names,
    )


def feature_importance(
    spark: SparkSession, model: RandomForestClassificationModel, features: list[str]
) -> DataFrame:
    """``(feature, importance)``, most important first; one row per feature."""
    rows = [(name, float(value)) for name, value in zip(features, model.featureImportances.toArray())]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


