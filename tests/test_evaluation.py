import random

import pytest

from tarmac.operators import evaluation as E


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double")


def brute_force_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.3), float(rng.randint(0, 6))) for _ in range(400)]
    got = E.roc_auc(scored(spark, pairs), "y", "s").first().roc_auc
    assert got == pytest.approx(brute_force_auc(pairs))


def test_auc_with_one_common_score(spark):
    pairs = [(i % 2, 0.5) for i in range(300)] + [(1, 0.9), (0, 0.1)]
    assert E.roc_auc(scored(spark, pairs), "y", "s").first().roc_auc == pytest.approx(brute_force_auc(pairs))


def test_auc_of_one_class_is_undefined(spark):
    assert E.roc_auc(scored(spark, [(1, 0.3), (1, 0.4)]), "y", "s").first().roc_auc is None


def guessed(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p int")


def test_report(spark):
    pairs = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 3
    report = {r.label: r for r in E.classification_report(guessed(spark, pairs), "y", "p").collect()}
    assert list(report) == ["On Time", "Delayed 15+", "accuracy", "macro avg", "weighted avg"]
    late = report["Delayed 15+"]
    assert (late.precision, late.recall, late.support) == (3 / 5, 3 / 4, 4)
    assert late.f1_score == pytest.approx(2 / 3)
    assert report["accuracy"].f1_score == 9 / 12 and report["accuracy"].support == 12
    assert report["macro avg"].recall == pytest.approx((6 / 8 + 3 / 4) / 2)
    assert report["weighted avg"].precision == pytest.approx((6 / 7 * 8 + 3 / 5 * 4) / 12)


def test_a_class_never_predicted_has_precision_zero(spark):
    report = {r.label: r for r in E.classification_report(guessed(spark, [(0, 0), (1, 0)]), "y", "p").collect()}
    assert report["Delayed 15+"].precision == 0 and report["Delayed 15+"].f1_score == 0


def test_confusion_matrix(spark):
    pairs = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 1)] * 3
    rows = E.confusion_matrix(guessed(spark, pairs), "y", "p").collect()
    assert [tuple(r) for r in rows] == [("Actual On Time", 6, 2), ("Actual Delayed", 0, 3)]
