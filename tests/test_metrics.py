"""Metrics against published figures, against Spark's own classes and against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from tripmill.operators import metrics

# Confusion counts (label, prediction) -> n and the figures printed for them, which
# were computed with label and prediction exchanged.
PUBLISHED = {
    "bayes": (
        {(0, 0): 219989, (1, 0): 50058, (0, 1): 175017, (1, 1): 50330},
        {
            "error_rate": 0.454335,
            "weighted_precision": 0.531647,
            "weighted_fpr": 0.507688,
            "auc_roc": 0.518988,
            "auc_pr": 0.483309,
            "fpr": 0.185367732,
            "tpr": 0.223344442,
        },
    ),
    "forest": (
        {(0, 0): 384911, (1, 0): 58670, (0, 1): 10095, (1, 1): 41718},
        {
            "error_rate": 0.138809,
            "weighted_precision": 0.915991,
            "weighted_fpr": 0.188291,
            "auc_roc": 0.836450,
            "auc_pr": 0.385273,
            "fpr": 0.132264456,
            "tpr": 0.805164727,
        },
    ),
}
# The same with the roles as they should be.
UPRIGHT = {
    "bayes": {
        "weighted_precision": 0.694812,
        "weighted_fpr": 0.487384,
        "tpr": 0.501355,
        "fpr": 0.443074,
        "auc_roc": 0.529140,
        "auc_pr": 0.218183,
    },
    "forest": {
        "weighted_precision": 0.855056,
        "weighted_fpr": 0.471180,
        "tpr": 0.415568,
        "fpr": 0.025557,
        "auc_roc": 0.695006,
        "auc_pr": 0.629098,
    },
}


def frame(spark, cells, swap=False):
    rows = [(float(a), float(b), n) for (a, b), n in cells.items()]
    names = ["prediction", "label"] if swap else ["label", "prediction"]
    return spark.createDataFrame(rows, [*names, "n"])


def report(df):
    return {r["metric"]: r["value"] for r in metrics.metrics_from_confusion(df).collect()}


@pytest.mark.parametrize("name", PUBLISHED)
def test_published_figures(spark, name):
    cells, figures = PUBLISHED[name]
    got = report(frame(spark, cells, swap=True))
    for metric, value in figures.items():
        assert got[metric] == pytest.approx(value, abs=6e-7), metric
    upright = report(frame(spark, cells))
    for metric, value in UPRIGHT[name].items():
        assert upright[metric] == pytest.approx(value, abs=6e-7), metric


@pytest.mark.parametrize("name", PUBLISHED)
def test_curves_agree_with_the_closed_forms(spark, name):
    cells = frame(spark, PUBLISHED[name][0])
    counts = cells.groupBy(F.col("prediction").alias("score")).agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("neg"),
    )
    points = metrics.roc_from_running(metrics.running_counts(counts)).collect()
    expected = report(cells)
    assert [(p["fpr"], p["tpr"]) for p in points] == [
        (0.0, 0.0),
        (pytest.approx(expected["fpr"]), pytest.approx(expected["tpr"])),
        (1.0, 1.0),
        (1.0, 1.0),
    ]


def scored(spark, n=3000, seed=3):
    """Scores with ties, crowded near zero, and labels that follow them loosely."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        score = round(rng.random() ** 6, 5)
        label = 1.0 if rng.random() < 0.2 + score / 2 else 0.0
        rows.append((score, label, 1.0 if score > 0.3 else 0.0))
    return spark.createDataFrame(rows, ["score", "label", "prediction"]).repartition(5)


@pytest.mark.parametrize("slices", [1, 7, 200])
def test_areas_equal_sparks_own(spark, slices):
    df = scored(spark)
    own = BinaryClassificationMetrics(df.select("score", "label").rdd.map(tuple))
    assert metrics.auc_roc(df, "score", slices).head()[0] == pytest.approx(own.areaUnderROC)
    assert metrics.auc_pr(df, "score", slices).head()[0] == pytest.approx(own.areaUnderPR)


def test_slices_do_not_change_the_running_counts(spark):
    counts = metrics.score_counts(scored(spark), "score")
    one = sorted(metrics.running_counts(counts, 1).collect())
    many = sorted(metrics.running_counts(counts, 13).collect())
    assert one == many and [r["point"] for r in one] == list(range(1, len(one) + 1))


def test_one_score_for_a_third_of_the_rows(spark):
    df = scored(spark, 900).union(
        spark.range(450).selectExpr("0.5D score", "cast(id % 2 as double) label", "1D prediction")
    )
    own = BinaryClassificationMetrics(df.select("score", "label").rdd.map(tuple))
    assert metrics.auc_roc(df, "score", 10).head()[0] == pytest.approx(own.areaUnderROC)


def test_hard_prediction_areas_equal_the_report(spark):
    df = scored(spark)
    values = {r["metric"]: r["value"] for r in metrics.metric_report(df).collect()}
    assert metrics.auc_roc(df).head()[0] == pytest.approx(values["auc_roc"])
    assert metrics.auc_pr(df).head()[0] == pytest.approx(values["auc_pr"])


def test_swap_exchanges_rows_and_columns(spark):
    df = scored(spark, 200)
    straight = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    swapped = {
        (r["prediction"], r["label"]): r["n"]
        for r in metrics.confusion_matrix(df, swap=True).collect()
    }
    assert straight == swapped


def test_one_class_only(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], ["label", "prediction"])
    values = {r["metric"]: r["value"] for r in metrics.metric_report(df).collect()}
    assert values["error_rate"] == 0.0
    assert values["weighted_precision"] == 1.0
    assert values["tpr"] is None and values["auc_roc"] is None
    assert metrics.auc_roc(df).head()[0] is None


def test_error_rate_compares_numbers_not_digits(spark):
    df = spark.createDataFrame([(0.0, 10.0), (1.0, 1.0)], ["label", "prediction"])
    assert metrics.error_rate(df).head()["error_rate"] == 0.5


def test_no_predictions(spark):
    df = spark.createDataFrame([], "label double, prediction double")
    assert metrics.error_rate(df).head()["error_rate"] is None


def test_both_areas_come_from_one_sliced_aggregation(spark):
    rows = [(i % 7 / 7, float(i % 3 == 0)) for i in range(60)]
    scored = spark.createDataFrame(rows, "prediction double, label double")
    both = metrics.areas(scored).head()
    one = metrics.areas(scored, slices=1).head()
    assert abs(both["auc_roc"] - one["auc_roc"]) < 1e-12
    assert abs(both["auc_pr"] - one["auc_pr"]) < 1e-12
    # scores named prediction are sliced too: every window over them has a partition
    plan = metrics.roc_curve(scored)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line and "row_number" in line]
    assert windows and all("[slice#" in line for line in windows)
