"""The training jobs (decision tree, Naive Bayes, random forest) and the scoring job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tripmill.operators.bayes import tune_bayes
from tripmill.operators.clean import CleanRules, clean, clean_loss, clean_split
from tripmill.operators.features import CLASS_THRESHOLD, feature_pipeline
from tripmill.operators.metrics import confusion_matrix, metric_report, pr_curve, roc_curve
from tripmill.operators.models import (
    BAYES_CHOICE,
    BAYES_GRID,
    FOLDS,
    FOREST_CHOICE,
    FOREST_GRID,
    TREE_CHOICE,
    TREE_SETTINGS,
    cached,
    compare_trees,
    cross_validate,
    decision_tree,
    naive_bayes,
    random_forest,
    tuning_table,
)
from tripmill.operators.profile import approx_median, preview
from tripmill.operators.split import hash_split, random_split, with_fold, with_side
from tripmill.session import tune
from tripmill.sources.sinks import load_model
from tripmill.sources.trips import read_trips_csv

KINDS = ("dt", "nb", "rf")
FULL_GRIDS = {"dt": TREE_SETTINGS, "nb": BAYES_GRID, "rf": FOREST_GRID}
CHOICES = {"dt": TREE_CHOICE, "nb": BAYES_CHOICE, "rf": FOREST_CHOICE}


class Judged:
    """Reports over predictions (id, probability, prediction, label)."""

    predictions: DataFrame

    @property
    def metrics(self) -> DataFrame:
        return metric_report(self.predictions)

    @property
    def confusion(self) -> DataFrame:
        return confusion_matrix(self.predictions)

    @property
    def roc(self) -> DataFrame:
        """(point, fpr, tpr) of the hard predictions."""
        return roc_curve(self.predictions)

    @property
    def pr(self) -> DataFrame:
        """(point, recall, precision) of the hard predictions."""
        return pr_curve(self.predictions)

    @property
    def preview(self) -> DataFrame:
        """The first predictions, for looking at."""
        return preview(self.predictions)


@dataclass
class Trained(Judged):
    """A fitted chain from raw clean trips to predictions, and how it did on the test side."""

    model: PipelineModel
    threshold: float
    loss: DataFrame
    predictions: DataFrame
    tuning: DataFrame | None


def train(
    trips: DataFrame,
    kind: str,
    rules: CleanRules = CleanRules(),
    threshold: float | str | None = None,
    grid=None,
    params=None,
    folds: int = FOLDS,
    split: str = "hash",
    with_dropoff_time: bool = True,
    handle_invalid: str = "error",
    parallelism: int = 4,
) -> Trained:
    """Split, clean, encode, tune, fit and predict.

    kind: "dt", "nb" or "rf". threshold: seconds from which a trip is long, or "median" for the
    median of the clean training side (the default for "dt"). grid: settings to compare before
    the final fit, FULL_GRIDS[kind] by default. For "nb" and "rf" the grid also decides the final
    setting, for "dt" it is only reported. params: one setting to fit instead, without tuning,
    such as CHOICES[kind].
    split: "hash" (by id) or "random" (Spark's sampler, seed 0).
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    if grid is None and params is None:
        grid = FULL_GRIDS[kind]
    tune(trips.sparkSession)
    sides = hash_split(trips) if split == "hash" else random_split(trips)
    train_side, test_side, loss = clean_split(*sides, rules)
    if threshold is None:
        threshold = "median" if kind == "dt" else CLASS_THRESHOLD
    if threshold == "median":
        threshold = int(approx_median(train_side, "trip_duration"))

    encoder = feature_pipeline(
        threshold=threshold,
        shift=kind == "nb",
        with_dropoff_time=with_dropoff_time,
        handle_invalid=handle_invalid,
    ).fit(train_side)
    features = encoder.transform(train_side)
    if params is None:  # kept with the features, not hashed in every pass
        features = with_side(features) if kind == "dt" else with_fold(features, folds)
    with cached(features) as encoded:
        fitted, tuning = _fit(encoded, kind, grid, params, folds, parallelism)
    model = PipelineModel(encoder.stages + [fitted])
    predictions = model.transform(test_side).select("id", "probability", "prediction", "label")
    return Trained(model, threshold, loss, predictions, tuning)


def _fit(encoded: DataFrame, kind: str, grid, params, folds: int, parallelism: int):
    if kind == "dt":
        tuning = compare_trees(encoded, grid, parallelism) if grid else None
        return decision_tree(*(params or TREE_CHOICE)).fit(encoded), tuning
    if params is None and kind == "nb":
        tuning, _, params = tune_bayes(encoded, grid)
        return naive_bayes(**params).fit(encoded), tuning
    if params is None:
        tuned = cross_validate(random_forest(), grid, encoded, folds, parallelism)
        return tuned.bestModel, tuning_table(encoded.sparkSession, tuned)
    chosen = naive_bayes(**params) if kind == "nb" else random_forest(**params)
    return chosen.fit(encoded), None


@dataclass
class Scored(Judged):
    """Predictions for new trips, and what cleaning removed."""

    predictions: DataFrame
    loss: DataFrame


def score(trips: DataFrame, model: PipelineModel | str, rules: CleanRules = CleanRules()) -> Scored:
    """Clean new trips and predict them with a saved chain (a path or a loaded model)."""
    tune(trips.sparkSession)
    if isinstance(model, str):
        model = load_model(model)
    predictions = model.transform(clean(trips, rules))
    return Scored(
        predictions.select("id", "probability", "prediction", "label"), clean_loss(trips, rules)
    )


def score_csv(
    spark: SparkSession, csv_path: str, model_path: str, rules: CleanRules = CleanRules()
) -> Scored:
    """score for a trip file."""
    return score(read_trips_csv(spark, csv_path), model_path, rules)
