"""Cross-validated tuning of Naive Bayes from sums instead of fits.

A discrete Naive Bayes model is a function of each class's row count and slot sums. One
aggregation takes them per fold and class; the model of a fold is that of all rows less the
fold's own, for every setting, and one more pass scores each row with the models that did not see
it. Two passes replace a fit and a scoring per fold and setting.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.metrics import auc_roc_by, score_counts

#: Digits of a margin that tell scores apart; what differs behind them is rounding.
DIGITS = 9


def class_sums(data: DataFrame, *keys: str) -> DataFrame:
    """(keys, label, n, sums) of encoded rows: a row per class and key, collapsed map-side."""
    return data.groupBy(*keys, "label").agg(
        F.count("*").alias("n"), vector_to_array(Summarizer.sum(F.col("features"))).alias("sums")
    )


def bayes_weights(
    sizes: Sequence[float], sums: Sequence[Sequence[float]], modelType: str, smoothing: float
) -> tuple[list[float], float]:
    """(weights, bias) of the margin of class 1 over class 0 of a model with these counts."""
    n, s = np.array(sizes, dtype=float), np.array(sums, dtype=float)
    slots = s.shape[1]
    if modelType == "multinomial":
        theta = np.log(s + smoothing) - np.log(s.sum(axis=1) + slots * smoothing)[:, None]
        pi = np.log(n + smoothing)
    elif modelType == "complement":
        # the other classes' shares, the rarer the better; the class sizes have no say
        rest = s.sum(axis=0) - s
        theta = np.log(rest.sum(axis=1) + slots * smoothing)[:, None] - np.log(rest + smoothing)
        pi = np.zeros(2)
    else:
        raise ValueError(f"no {modelType} model of sums")
    return (theta[1] - theta[0]).tolist(), float(pi[1] - pi[0])


def fold_scores(data: DataFrame, grid: dict[str, list]) -> DataFrame:
    """(label, fold, setting, score) of encoded rows with a column fold: the margin of each row by
    the model of every setting that its fold had no part in.

    setting: position in the grid. The sums are taken now: two rows per fold. A fold whose
    complement lacks a class has no scores.
    """
    rows = class_sums(data, "fold").collect()
    folds = sorted({r["fold"] for r in rows})
    whole = {r["label"]: np.zeros(len(r["sums"])) for r in rows}
    size = dict.fromkeys(whole, 0)
    for r in rows:
        whole[r["label"]] = whole[r["label"]] + np.array(r["sums"])
        size[r["label"]] += r["n"]
    own = {(r["fold"], r["label"]): r for r in rows}
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]

    models = []
    for fold in folds:
        counts = []
        for label in (0.0, 1.0):
            part = own.get((fold, label))
            if label in whole:
                outside = whole[label] - (np.array(part["sums"]) if part else 0)
                counts.append((size[label] - (part["n"] if part else 0), outside))
        if len(counts) == 2 and all(n for n, _ in counts):
            for i, setting in enumerate(settings):
                weights, bias = bayes_weights(*zip(*counts), **setting)
                models.append((fold, i, weights, bias))
    schema = "fold int, setting int, weights array<double>, bias double"
    # a row per fold and setting; the sum is a lambda, as it would be too long to compile written out
    model = F.broadcast(data.sparkSession.createDataFrame(models, schema))
    products = F.zip_with("f", "weights", lambda x, w: x * w)
    margin = F.aggregate(products, F.col("bias"), lambda total, x: total + x)
    return (
        data.select("label", "fold", vector_to_array("features").alias("f"))
        .join(model, "fold")
        .select("label", "fold", "setting", F.round(margin, DIGITS).alias("score"))
    )


def setting_names(grid: dict[str, list]) -> list[str]:
    """Settings as text, in grid order."""
    return [
        ", ".join(f"{k}={v}" for k, v in sorted(zip(grid, values))) for values in product(*grid.values())
    ]


def tune_bayes(data: DataFrame, grid: dict[str, list]) -> tuple[DataFrame, DataFrame, dict]:
    """((params, avg_auc, std_auc, chosen), (params, fold, auc), chosen setting), computed now.

    The setting with the greatest mean area over the folds wins, of equal ones the first.
    """
    spark, names, keys = data.sparkSession, setting_names(grid), ["setting", "fold"]
    counts = score_counts(fold_scores(data, grid), "score", keys).persist()
    areas = sorted(tuple(r) for r in auc_roc_by(counts, keys).collect())
    counts.unpersist()
    folds = data.select("fold").distinct().count()
    by = [[a for s, _, a in areas if s == i] for i in range(len(names))]
    if not areas or any(len(own) != folds or None in own for own in by):
        raise ValueError("every fold needs rows of both classes, inside and outside")
    # sums of equal areas may differ in their last digits; the first of equals is chosen
    means = [round(float(np.mean(own)), 12) for own in by]
    best = max(range(len(names)), key=means.__getitem__)
    table = [(names[i], means[i], float(np.std(own)), i == best) for i, own in enumerate(by)]
    values = list(product(*grid.values()))[best]
    return (
        spark.createDataFrame(table, "params string, avg_auc double, std_auc double, chosen boolean"),
        spark.createDataFrame(
            [(names[s], f, a) for s, f, a in areas], "params string, fold int, auc double"
        ),
        dict(zip(grid, values)),
    )
