"""Train and evaluate the late-arrival classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, StringIndexerModel
from pyspark.sql import DataFrame

from tarmac.operators import encoding, evaluation, sampling, training
from tarmac.plans.views import export_csv
from tarmac.schema import CATEGORICAL_FEATURES, TARGET
from tarmac.session import stored


@dataclass(frozen=True)
class Evaluation:
    """A fitted model and its reports over the held-out part."""

    model: RandomForestClassificationModel
    encoder: StringIndexerModel
    binner: Bucketizer
    predictions: DataFrame
    importance: DataFrame
    summary: DataFrame

    def roc_auc(self) -> DataFrame:
        return evaluation.roc_auc(self.predictions, "actual_arr_del15", "delay_probability")

    def classification_report(self) -> DataFrame:
        return evaluation.classification_report(self.predictions, "actual_arr_del15", "predicted_arr_del15")

    def confusion_matrix(self) -> DataFrame:
        return evaluation.confusion_matrix(self.predictions, "actual_arr_del15", "predicted_arr_del15")

    def export(self, folder: str) -> None:
        """The published columns. Predictions grow with the data and stay in as many parts as there are tasks."""
        own = [f"{c}_value" for c in CATEGORICAL_FEATURES]
        export_csv(self.predictions.drop(*own), f"{folder}/delay_predictions")
        export_csv(self.importance, f"{folder}/feature_importance", single_file=True)


def train_and_evaluate(
    flights: DataFrame,
    year: int | None = None,
    n_trees: int = 100,
    max_depth: int = 10,
    test_size: float = 0.2,
    seed: int = 42,
    key: Sequence[str] = (),
    pre_departure: bool = False,
    encode_on: str = "all",
) -> Evaluation:
    """Fits on a stratified part of the operated flights and scores the rest.

    The rows, both parts and the predictions are written to the shared folder: split,
    forest and reports read them several times, and a lost executor then re-reads a file
    instead of repeating what came before. ``encode_on="train"`` fits the codes
    on the training part only and gives unseen values a code of their own.
    """
    spark = flights.sparkSession
    features = training.available_features(flights, pre_departure)
    rows = stored(training.training_rows(flights, year, tuple(key)), "training-rows")
    split = sampling.stratified_split(rows, TARGET, test_size, seed, key)
    train, test = stored(split.train, "train"), stored(split.test, "test")
    if encode_on == "train":
        encoder = encoding.fit_encoder(train, on_unseen="keep")
    else:
        encoder = encoding.fit_encoder(rows)

    binner = training.fit_bins(train, features)

    def prepared(part: DataFrame) -> DataFrame:
        return training.assemble(encoding.encode(part, encoder), features, binner)

    weights = training.balanced_weights({c: n for c, (n, _) in split.sizes.items() if n})
    model = training.fit_forest(prepared(train), features, encoder, weights, n_trees, max_depth, seed)
    return Evaluation(
        model=model,
        encoder=encoder,
        binner=binner,
        predictions=stored(training.predict(model, prepared(test), features), "predictions"),
        importance=training.feature_importance(spark, model, features),
        summary=training.split_summary(spark, split.sizes),
    )
