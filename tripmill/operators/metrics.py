"""Evaluation of binary predictions: errors, confusion, weighted rates, ROC and PR curves.

Everything starts from one map-side aggregation of the predictions: four cells, or one row per
distinct score, over which the curves are exact running sums. The positive class is 1.0.
swap=True exchanges the roles of label and prediction, to compare with figures that were
published that way round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def error_rate(predictions: DataFrame) -> DataFrame:
    """(n_total, n_wrong, error_rate)."""
    wrong = F.count_if(F.col("prediction") != F.col("label"))
    return predictions.agg(F.count("*").alias("n_total"), wrong.alias("n_wrong")).withColumn(
        "error_rate", F.try_divide(F.col("n_wrong").cast("double"), F.col("n_total"))
    )


def confusion_matrix(predictions: DataFrame, swap: bool = False) -> DataFrame:
    """(label, prediction, n) of the pairs that occur."""
    label, prediction = ("prediction", "label") if swap else ("label", "prediction")
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def _cells(confusion: DataFrame) -> DataFrame:
    """One row of doubles: tp, fp, fn, tn, and the class sizes pos, neg and total."""
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    counts = confusion.selectExpr(
        *[
            f"cast(coalesce(sum(n) filter (where label = {a} and prediction = {b}), 0) as double)"
            f" as {name}"
            for name, (a, b) in cells.items()
        ]
    )
    return counts.selectExpr("*", "tp + fn as pos", "tn + fp as neg", "tp + fp + fn + tn as total")


def metrics_from_confusion(confusion: DataFrame) -> DataFrame:
    """(metric, value) for 0/1 predictions given as (label, prediction, n).

    weighted_precision, weighted_fpr: per-class rates weighted by class size. auc_roc, auc_pr:
    areas under the curves that the hard predictions span. A rate without its class is null.
    """
    rates = _cells(confusion).selectExpr(
        "*",
        "try_divide(tp, pos) as tpr",
        "try_divide(fp, neg) as fpr",
        "try_divide(pos, total) as base",
        "coalesce(try_divide(tp, tp + fp), 0D) as precision_long",
        "coalesce(try_divide(tn, tn + fn), 0D) as precision_short",
        "coalesce(try_divide(tp, tp + fp), try_divide(pos, total)) as first",
    )
    values = {
        "error_rate": "try_divide(fp + fn, total)",
        "weighted_precision": "try_divide(precision_long * pos + precision_short * neg, total)",
        "weighted_fpr": "try_divide(fpr * pos + (1 - tpr) * neg, total)",
        "auc_roc": "(tpr - fpr + 1) / 2",
        "auc_pr": "tpr * first + (1 - tpr) * (first + base) / 2",
        "tpr": "tpr",
        "fpr": "fpr",
    }
    rows = ", ".join(f"struct('{k}' as metric, {v} as value)" for k, v in values.items())
    return rates.selectExpr(f"inline(array({rows}))")


def metric_report(predictions: DataFrame, swap: bool = False) -> DataFrame:
    """(metric, value) of hard predictions, from one pass."""
    return metrics_from_confusion(confusion_matrix(predictions, swap))


def score_counts(
    predictions: DataFrame, score: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, score, pos, neg) per distinct score."""
    # not count_if: it gives every use its own names, and the shuffles would not be shared
    return predictions.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col("label") == 1.0, 1)).alias("pos"),
        F.count(F.when(F.col("label") != 1.0, 1)).alias("neg"),
    )


def _place(edges: Column, score: Column, most: int) -> Column:
    """How many of at most `most` sorted edges lie below a score, by bisection."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]

    def onward(at: Column, step: Column) -> Column:
        further = at + step
        # a step past the end gives null, which is not below
        below = F.coalesce(F.get(edges, further - 1) < score, F.lit(False))
        return F.when(below, further).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), onward)


def running_counts(counts: DataFrame, slices: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Exact cumulative counts by falling score, from rows of (keys, score, pos, neg).

    Gives point (1 for the highest score), points (their number), pos, neg, tp and fp (counts at
    or above the score) and the totals p and n, all per group of keys. With slices > 1 the
    distinct scores of a group are cut at their quantiles: each slice is summed by itself and
    lifted by the totals of the slices above it, so no task sees all scores.
    """
    keys = list(keys)
    everything = Window.partitionBy(*keys)
    if slices == 1:
        placed = counts.withColumns(
            {"k0": F.lit(0), "pos0": F.lit(0), "neg0": F.lit(0)}
            | {"points": F.count("*").over(everything)}
            | {"p": F.sum("pos").over(everything), "n": F.sum("neg").over(everything)}
        )
        order = everything.orderBy(F.desc("score"))
    else:
        cuts = [i / slices for i in range(1, slices)]
        # asking for pos and neg keeps this the same aggregation as below, so it runs only once
        occurring = counts.filter(F.col("pos") + F.col("neg") > 0)
        quantiles = F.percentile_approx("score", cuts, 10 * slices)
        if keys:
            edges = F.broadcast(occurring.groupBy(*keys).agg(quantiles.alias("edges")))
            edged = counts.join(edges, keys)  # a row per group
        else:
            edged = counts.withColumn("edges", occurring.agg(quantiles).scalar())
        # never null, or the join's null check on it would run on every prediction row
        place = F.coalesce(_place(F.col("edges"), F.col("score"), slices - 1), F.lit(0))
        sliced = edged.withColumn("slice", place).drop("edges")
        above = everything.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
        totals = sliced.groupBy(*keys, "slice").agg(
            F.count("*").alias("k"), F.sum("pos").alias("sp"), F.sum("neg").alias("sn")
        )
        lifts = totals.select(
            *keys,
            "slice",
            F.coalesce(F.sum("k").over(above), F.lit(0)).alias("k0"),
            F.coalesce(F.sum("sp").over(above), F.lit(0)).alias("pos0"),
            F.coalesce(F.sum("sn").over(above), F.lit(0)).alias("neg0"),
            F.sum("k").over(everything).alias("points"),
            F.sum("sp").over(everything).alias("p"),
            F.sum("sn").over(everything).alias("n"),
        )
        placed = sliced.join(F.broadcast(lifts), [*keys, "slice"])  # `slices` rows a group
        order = Window.partitionBy(*keys, "slice").orderBy(F.desc("score"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        *keys,
        (F.row_number().over(order) + F.col("k0")).cast("bigint").alias("point"),
        F.col("points"),
        F.col("pos").cast("double").alias("pos"),
        F.col("neg").cast("double").alias("neg"),
        (F.sum("pos").over(upto) + F.col("pos0")).cast("double").alias("tp"),
        (F.sum("neg").over(upto) + F.col("neg0")).cast("double").alias("fp"),
        F.col("p").cast("double").alias("p"),
        F.col("n").cast("double").alias("n"),
    )


def _slices(predictions: DataFrame) -> int:
    # a score may differ in every row, so there are as many slices as a shuffle has partitions
    return max(2, int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _curve_points(predictions: DataFrame, score: str, slices: int | None) -> DataFrame:
    return running_counts(score_counts(predictions, score), slices or _slices(predictions))


def roc_curve(
    predictions: DataFrame, score: str = "prediction", slices: int | None = None
) -> DataFrame:
    """(point, fpr, tpr) by falling score, with (0,0) put first and (1,1) put last."""
    return roc_from_running(_curve_points(predictions, score, slices))


def roc_from_running(running: DataFrame) -> DataFrame:
    """roc_curve from the rows of running_counts."""

    def at(point: Column, x: Column, y: Column) -> Column:
        return F.struct(point.cast("bigint").alias("point"), x.alias("fpr"), y.alias("tpr"))

    first, last = F.col("point") == 1, F.col("point") == F.col("points")
    here = at(F.col("point"), F.try_divide("fp", "n"), F.try_divide("tp", "p"))
    start = at(F.lit(0), F.lit(0.0), F.lit(0.0))
    end = at(F.col("points") + 1, F.lit(1.0), F.lit(1.0))
    around = F.array_compact(F.array(F.when(first, start), here, F.when(last, end)))
    return running.select(F.inline(around)).orderBy("point")


def auc_roc(
    predictions: DataFrame, score: str = "prediction", slices: int | None = None
) -> DataFrame:
    """(auc_roc): trapezoid area under roc_curve."""
    return areas(predictions, score, slices).select("auc_roc")


def auc_roc_by(counts: DataFrame, keys: Sequence[str], slices: int | None = None) -> DataFrame:
    """(keys, auc_roc): the exact area under the ROC curve of each group, from score_counts with
    the same keys; null without rows of both classes. The counts are read several times: keep
    them where they are dear."""
    running = running_counts(counts, slices or _slices(counts), keys)
    step = F.col("neg") * (F.col("tp") * 2 - F.col("pos")) / 2
    return (
        running.groupBy(*keys)
        .agg(F.sum(step).alias("area"), F.max(F.col("p") * F.col("n")).alias("whole"))
        .select(*keys, F.try_divide("area", "whole").alias("auc_roc"))
    )


def pr_curve(
    predictions: DataFrame, score: str = "prediction", slices: int | None = None
) -> DataFrame:
    """(point, recall, precision) by falling score; starts at recall 0 with the first precision."""
    points = _curve_points(predictions, score, slices).select(
        "point",
        F.try_divide("tp", "p").alias("recall"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )
    here = F.struct("point", "recall", "precision")
    start = F.struct(
        F.lit(0).cast("bigint").alias("point"), F.lit(0.0).alias("recall"), "precision"
    )
    around = F.when(F.col("point") == 1, F.array(start, here)).otherwise(F.array(here))
    return points.select(F.inline(around)).orderBy("point")


def auc_pr(
    predictions: DataFrame, score: str = "prediction", slices: int | None = None
) -> DataFrame:
    """(auc_pr): trapezoid area under pr_curve."""
    return areas(predictions, score, slices).select("auc_pr")


def areas(
    predictions: DataFrame, score: str = "prediction", slices: int | None = None
) -> DataFrame:
    """(auc_roc, auc_pr): both areas from one aggregation of the curve's points."""
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    # a step's start is the point less its own counts, so no neighbour is looked up
    step = neg * (tp * 2 - pos) / 2
    precision = F.try_divide(tp, tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, (tp - pos) + (fp - neg)), precision)
    return (
        _curve_points(predictions, score, slices)
        .agg(
            F.sum(step).alias("roc"),
            F.sum(pos * (precision + before) / 2).alias("pr"),
            F.max("p").alias("p"),
            F.max("n").alias("n"),
        )
        .select(
            F.try_divide(F.col("roc"), F.col("p") * F.col("n")).alias("auc_roc"),
            F.try_divide("pr", "p").alias("auc_pr"),
        )
    )
