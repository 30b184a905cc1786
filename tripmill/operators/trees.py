"""Fitted trees and forests as tables of nodes and as SQL expressions.

A model's nodes are bounded by its depth: at most 2^(depth + 1) - 1 a tree. They are read from the
form in which Spark stores a model, numbered like a heap (root 1, children 2n and 2n + 1), and
compiled to CASE expressions over the feature slots, which Spark and other SQL engines evaluate
without the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.scratch import scratch_dir

NODES = (
    "tree int, node int, depth int, feature int, threshold double, category double,"
    " left int, right int, n_short double, n_long double, prediction double, gain double"
)


@dataclass(frozen=True)
class Node:
    """One node. Inner ones have a feature and either a threshold (left if at most that) or, for
    a 0/1 slot, the category that goes left; counts are the training rows of the two classes."""

    tree: int
    node: int
    feature: int | None
    threshold: float | None
    category: float | None
    counts: tuple[float, float]
    prediction: float
    gain: float | None

    @property
    def depth(self) -> int:
        return self.node.bit_length() - 1


def fitted_stage(model):
    """The classifier of a fitted chain, or the classifier itself."""
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def tree_nodes(spark: SparkSession, model) -> list[Node]:
    """All nodes of a fitted tree or forest, by tree and then in preorder."""
    path = scratch_dir(spark, "trees")
    fitted_stage(model).write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "treeID" in stored.columns:
        stored = stored.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        stored = stored.withColumn("tree", F.lit(0))
    rows = {(r["tree"], r["id"]): r for r in stored.collect()}  # bounded by the depth

    def below(tree: int, row, number: int) -> Iterable[Node]:
        inner = row["leftChild"] >= 0
        split = row["split"]
        values = split["leftCategoriesOrThreshold"] if inner else [None]
        discrete = inner and split["numCategories"] >= 0
        short, long = row["impurityStats"]
        yield Node(
            tree,
            number,
            split["featureIndex"] if inner else None,
            None if discrete else values[0],
            values[0] if discrete else None,
            (short, long),
            row["prediction"],
            row["gain"] if inner else None,
        )
        if inner:
            yield from below(tree, rows[tree, row["leftChild"]], 2 * number)
            yield from below(tree, rows[tree, row["rightChild"]], 2 * number + 1)

    trees = sorted({t for t, _ in rows})
    return [node for t in trees for node in below(t, rows[t, 0], 1)]


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, node, depth, feature, threshold, category, left, right, n_short, n_long,
    prediction, gain) per node of a fitted tree or forest; leaves have no feature."""
    rows = [
        (
            n.tree,
            n.node,
            n.depth,
            n.feature,
            n.threshold,
            n.category,
            None if n.feature is None else 2 * n.node,
            None if n.feature is None else 2 * n.node + 1,
            *map(float, n.counts),
            n.prediction,
            n.gain,
        )
        for n in tree_nodes(spark, model)
    ]
    return spark.createDataFrame(rows, NODES)


def _literal(value: float) -> str:
    return f"{value!r}E0" if "e" not in repr(value) else repr(value)


def case_expression(
    nodes: Iterable[Node], value: Callable[[Node], float], slot: str = "f{}", depth: int | None = None
) -> str:
    """One tree as a CASE expression of doubles over slots named f0, f1, ...

    value: what a leaf gives. depth: cut the tree there, as if it had been fitted no deeper.
    """
    by_number = {n.node: n for n in nodes}

    def text(number: int) -> str:
        node = by_number[number]
        if node.feature is None or node.depth == depth:
            return _literal(value(node))
        x = slot.format(node.feature)
        if node.threshold is not None:
            test = f"{x} <= {_literal(node.threshold)}"
        else:
            test = f"{x} = {_literal(node.category)}"
        return f"CASE WHEN {test} THEN {text(2 * number)} ELSE {text(2 * number + 1)} END"

    return text(1)


def vote_expressions(nodes: list[Node], slot: str = "f{}") -> tuple[str, str]:
    """SQL for the votes of all trees for the classes short and long: shares of a leaf's rows."""
    trees = sorted({n.tree for n in nodes})

    def votes(which: int) -> str:
        parts = [
            case_expression([n for n in nodes if n.tree == t], lambda n: n.counts[which] / sum(n.counts), slot)
            for t in trees
        ]
        return " + ".join(f"({p})" for p in parts)

    return votes(0), votes(1)


def prediction_expression(nodes: list[Node], slot: str = "f{}") -> str:
    """SQL for the predicted class, 0 or 1, of a tree or forest."""
    short, long = vote_expressions(nodes, slot)
    return f"CASE WHEN {long} > {short} THEN 1E0 ELSE 0E0 END"


def predict_by_sql(encoded: DataFrame, nodes: list[Node]) -> DataFrame:
    """(id, label, prediction) of encoded rows by the compiled expression, without the model."""
    used = sorted({n.feature for n in nodes if n.feature is not None})
    wide = encoded.select("id", "label", vector_to_array("features").alias("f")).select(
        "id", "label", *[F.col("f")[i].alias(f"f{i}") for i in used]
    )
    return wide.select("id", "label", F.expr(prediction_expression(nodes)).alias("prediction"))


def truncated_errors(
    nodes: list[Node], leaf_counts: Iterable[tuple[int, float, int]], depths: Iterable[int]
) -> dict[int, int]:
    """Wrong rows of one tree cut at each depth, from (leaf, label, rows) counts of the whole tree.

    leaf: position among the leaves from left to right. A tree that is fitted no deeper has the
    same nodes down to its depth, so the shallower trees need no fit and no pass of their own.
    """
    leaves = [n for n in nodes if n.feature is None]
    by_number = {n.node: n for n in nodes}
    wrong = dict.fromkeys(depths, 0)
    for leaf, label, n in leaf_counts:
        node = leaves[int(leaf)]
        for depth in wrong:
            at = by_number[node.node >> max(0, node.depth - depth)]
            wrong[depth] += n * (at.prediction != label)
    return wrong
