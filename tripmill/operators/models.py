"""Classifiers, their tuning, and what a fitted model says about itself.

Inputs are frames of (id, features, label). Fits run as Spark ML jobs; tuning keeps one cached
copy of the features and hands independent fits to a few driver threads.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.split import with_fold, with_side
from tripmill.operators.trees import tree_nodes, truncated_errors

SEED = 0
FOLDS = 3

# Fixed values: (impurity, maxDepth, maxBins) of the tree comparison, and the chosen setting.
TREE_SETTINGS = [
    ("gini", 3, 10),
    ("gini", 3, 5),
    ("gini", 4, 5),
    ("gini", 5, 5),
    ("gini", 6, 5),
    ("gini", 7, 5),
    ("gini", 8, 5),
    ("gini", 9, 5),
    ("gini", 9, 32),
    ("gini", 9, 50),
]
TREE_CHOICE = ("gini", 9, 5)

# The full tuning grids.
BAYES_GRID = {"modelType": ["multinomial", "complement"], "smoothing": [1.0, 10.0, 100.0]}
FOREST_GRID = {
    "maxBins": [5, 10, 32, 50],
    "maxDepth": [3, 4, 5, 6, 7, 8, 9],
    "numTrees": [3, 4, 5],
    "minInfoGain": [0.0, 0.5],
}
# The settings the full grids are known to choose.
BAYES_CHOICE = {"modelType": "multinomial", "smoothing": 100.0}
FOREST_CHOICE = {"maxBins": 10, "maxDepth": 9, "numTrees": 5, "minInfoGain": 0.0}


@contextmanager
def cached(data: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for the passes of a fit, in memory and then on disk; lost parts recompute.

    A frame that is kept already stays as it is.
    """
    if data.is_cached:
        yield data
        return
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def decision_tree(impurity: str, max_depth: int, max_bins: int, seed: int = SEED):
    return DecisionTreeClassifier(
        impurity=impurity, maxDepth=max_depth, maxBins=max_bins, seed=seed
    )


def naive_bayes(**params) -> NaiveBayes:
    return NaiveBayes(**params)


def random_forest(seed: int = SEED, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        minInstancesPerNode=1, cacheNodeIds=False, checkpointInterval=10, seed=seed, **params
    )


def compare_trees(
    data: DataFrame,
    settings: Sequence[tuple[str, int, int]] = TREE_SETTINGS,
    parallelism: int = 4,
) -> DataFrame:
    """(impurity, max_depth, max_bins, n_valid, error_rate) per setting, computed now.

    Trees are fitted on two thirds of the data and judged on the rest. Settings that differ in
    depth alone share one fit at the greatest depth; the shallower trees are its upper levels.
    One pass over the validation rows counts rows per leaf and class of every fit.
    """
    if "inner" not in data.columns:
        data = with_side(data)
    deepest: dict[tuple[str, int], int] = {}
    for impurity, depth, bins in settings:
        deepest[impurity, bins] = max(depth, deepest.get((impurity, bins), 0))
    fits = [(impurity, depth, bins) for (impurity, bins), depth in deepest.items()]
    with cached(data) as data:
        models = _fit_all([decision_tree(*s) for s in fits], data.filter("inner"), parallelism)
        judged = data.filter("not inner").select("features", "label")
        for i, model in enumerate(models):
            model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("").setLeafCol(f"leaf{i}")
            judged = model.transform(judged)
        leaves = [F.struct(F.lit(i).alias("fit"), F.col(f"leaf{i}").alias("leaf")) for i in range(len(fits))]
        counts = (
            judged.select("label", F.explode(F.array(*leaves)).alias("at"))
            .groupBy("at.fit", "at.leaf", "label")
            .agg(F.count("*").alias("n"))
            .collect()  # at most two rows per leaf
        )
    spark = data.sparkSession
    n_valid = sum(r["n"] for r in counts if r["fit"] == 0)
    wrong = {}
    for i, (model, (impurity, _, bins)) in enumerate(zip(models, fits)):
        own = [(r["leaf"], r["label"], r["n"]) for r in counts if r["fit"] == i]
        depths = [d for kind, d, b in settings if (kind, b) == (impurity, bins)]
        for depth, n in truncated_errors(tree_nodes(spark, model), own, depths).items():
            wrong[impurity, depth, bins] = n
    rows = [(*s, n_valid, wrong[tuple(s)] / n_valid if n_valid else None) for s in settings]
    return spark.createDataFrame(
        rows, "impurity string, max_depth int, max_bins int, n_valid bigint, error_rate double"
    )


def _fit_all(estimators: list, data: DataFrame, parallelism: int) -> list:
    """Fit independent estimators on one frame, a few at a time."""
    fit = inheritable_thread_target(data.sparkSession)(lambda e: e.fit(data))
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(fit, estimators))


def param_grid(estimator, values: dict[str, list]) -> list:
    """All combinations of the named parameters' values."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), options)
    return builder.build()


def selection_metric() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        metricName="areaUnderROC", rawPredictionCol="probability", numBins=1000
    )


def cross_validate(
    estimator,
    grid: dict[str, list],
    data: DataFrame,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated choice from a grid by area under ROC; bestModel is refitted on all data.

    Every fold and the final fit read the features, so they are kept meanwhile, with their fold
    (a frame with a column fold keeps its own). Folds come from the row key, so a recomputed
    partition lands in the same fold.
    """
    if "fold" not in data.columns:
        data = with_fold(data, folds)
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid(estimator, grid),
        evaluator=selection_metric(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    with cached(data) as data:
        return validator.fit(data)


def tuning_table(spark, tuned: CrossValidatorModel) -> DataFrame:
    """(params, avg_auc, std_auc, chosen) per grid entry; as many rows as the grid has."""
    best = max(range(len(tuned.avgMetrics)), key=lambda i: tuned.avgMetrics[i])
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda e: e[0].name)),
            float(tuned.avgMetrics[i]),
            float(tuned.stdMetrics[i]),
            i == best,
        )
        for i, params in enumerate(tuned.getEstimatorParamMaps())
    ]
    return spark.createDataFrame(
        rows, "params string, avg_auc double, std_auc double, chosen boolean"
    )


def bayes_parameters(spark, model: NaiveBayesModel) -> DataFrame:
    """(label, feature, theta, pi): the fitted log-probabilities; classes x features rows."""
    theta, pi = model.theta.toArray(), model.pi.toArray()
    rows = [
        (float(c), f, float(theta[c, f]), float(pi[c]))
        for c in range(theta.shape[0])
        for f in range(theta.shape[1])
    ]
    return spark.createDataFrame(rows, "label double, feature int, theta double, pi double")


def model_rules(spark, model: PipelineModel) -> DataFrame:
    """(line, rule): the tree or forest as indented text; bounded by its number of nodes.
    trees.node_table has the same as data."""
    lines = model.stages[-1].toDebugString.rstrip("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line int, rule string")


def feature_importance(spark, model: PipelineModel) -> DataFrame:
    """(feature, importance) per slot of the feature vector."""
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(weights)], "feature int, importance double"
    )
