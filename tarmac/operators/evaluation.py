"""Measures of a binary classifier, each from one small aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import columns as C

# Names of the two classes in reports.
CLASS_NAMES = {0: "On Time", 1: "Delayed 15+"}
CONFUSION_ROWS = {0: "Actual On Time", 1: "Actual Delayed"}
CONFUSION_COLUMNS = {0: "Predicted On Time", 1: "Predicted Delayed"}


def roc_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """``(roc_auc)``: chance that a late flight scores above a punctual one, ties counting half.

    Equal scores are counted before they are shuffled, and the evaluator sorts
    the counts across partitions, so neither a common score nor a large class
    ends up in one task. Without binning it is exact. NULL if there is only one
    class.
    """
    counted = (
        scored.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
        .groupBy("label", "score")
        .agg(F.count("*").cast("double").alias("n"))
        .persist()
    )
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", weightCol="n", metricName="areaUnderROC", numBins=0
    )
    try:
        both = counted.select("label").distinct().count() == 2
        value = evaluator.evaluate(counted) if both else None
    finally:
        counted.unpersist()
    return scored.sparkSession.createDataFrame([(value,)], "roc_auc double")


def _outcomes(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows by actual and predicted class: at most four."""
    return (
        predicted.select(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
        .groupBy("actual", "predicted")
        .agg(F.count("*").alias("n"))
    )


def confusion_matrix(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    """2x2 counts: one row per actual class, one column per predicted class."""
    def count_of(actual: int, guess: int):
        return F.coalesce(F.sum(F.when((F.col("actual") == actual) & (F.col("predicted") == guess), F.col("n"))), F.lit(0))

    totals = _outcomes(predicted, label, prediction).agg(
        *[count_of(a, p).alias(f"n{a}{p}") for a in CLASS_NAMES for p in CLASS_NAMES]
    )
    rows = [
        F.struct(
            F.lit(CONFUSION_ROWS[a]).alias("actual"),
            *[F.col(f"n{a}{p}").alias(CONFUSION_COLUMNS[p]) for p in CLASS_NAMES],
        )
        for a in CLASS_NAMES
    ]
    return totals.select(F.inline(F.array(*rows)))


def classification_report(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, precision, recall, f1_score, support)`` per class, plus accuracy and averages.

    A measure with an empty denominator is 0. The accuracy row has its value in
    ``f1_score``.
    """
    outcomes = _outcomes(predicted, label, prediction)
    actual, guess, n = F.col("actual"), F.col("predicted"), F.col("n")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    sums = {"correct": total(actual == guess), "all_rows": total(F.lit(True))}
    for c in CLASS_NAMES:
        sums[f"hit{c}"] = total((actual == c) & (guess == c))
        sums[f"guessed{c}"] = total(guess == c)
        sums[f"support{c}"] = total(actual == c)
    totals = outcomes.agg(*[s.alias(name) for name, s in sums.items()])

    def or_zero(column):
        return F.coalesce(column, F.lit(0.0))

    per_class = {}
    for c in CLASS_NAMES:
        per_class[f"precision{c}"] = or_zero(C.ratio(F.col(f"hit{c}"), F.col(f"guessed{c}")))
        per_class[f"recall{c}"] = or_zero(C.ratio(F.col(f"hit{c}"), F.col(f"support{c}")))
    totals = totals.withColumns(per_class)
    totals = totals.withColumns({
        f"f1_score{c}": or_zero(C.ratio(
            2 * F.col(f"precision{c}") * F.col(f"recall{c}"), F.col(f"precision{c}") + F.col(f"recall{c}")
        ))
        for c in CLASS_NAMES
    })
    measures = ["precision", "recall", "f1_score"]

    def add(terms):
        return reduce(lambda a, b: a + b, terms)

    def row(name, values, support):
        return F.struct(
            F.lit(name).alias("label"), *[v.alias(m) for v, m in zip(values, measures)], support.alias("support")
        )

    n_rows = F.col("all_rows")
    nothing = F.lit(None).cast("double")
    rows = [row(CLASS_NAMES[c], [F.col(f"{m}{c}") for m in measures], F.col(f"support{c}")) for c in CLASS_NAMES]
    rows.append(row("accuracy", [nothing, nothing, or_zero(C.ratio(F.col("correct"), n_rows))], n_rows))
    rows.append(row("macro avg", [add([F.col(f"{m}{c}") for c in CLASS_NAMES]) / 2 for m in measures], n_rows))
    weighted = [
        or_zero(C.ratio(add([F.col(f"{m}{c}") * F.col(f"support{c}") for c in CLASS_NAMES]), n_rows)) for m in measures
    ]
    rows.append(row("weighted avg", weighted, n_rows))
    return totals.select(F.inline(F.array(*rows)))
