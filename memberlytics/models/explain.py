"""Contribution of every feature to a score: Shapley values of tree ensembles.

The value of a feature is its Shapley value when features outside a coalition follow the training rows down the tree
(path-dependent expectation).  For a leaf this is a game of products: each feature of its path is worth ``o`` inside a coalition
(1 if the row passes its tests) and ``z`` outside (share of training rows that do).  Its Shapley value is

    value * (o_i - z_i) * integral over t in 0..1 of the product over the other features of t * o + (1 - t) * z

because the weights of the coalitions are beta integrals.  The integrand is a polynomial, so a few Gauss-Legendre points give it
exactly.  One walk of a tree carries the products at these points down and the sums over leaves up; a feature's
part is settled at its edge for all leaves below.  The cost is linear in nodes times depth.

The ensemble is small (trees times leaves, set by the model's parameters) and travels with the
tasks; the scored table stays distributed and is processed in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from memberlytics.models.training import FEATURES, feature_names
from memberlytics.session import staging_path


def tree_nodes(model, spark) -> DataFrame:
    """The ensemble as a table of nodes, read from the saved model."""
    path = staging_path(spark, "model")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


class Node(NamedTuple):
    """A leaf has a value; another node has a test and two children, each with its share of the training rows."""

    value: float = 0.0
    feature: int = -1
    threshold: float | None = None
    left_set: list | None = None
    children: tuple[Node, ...] = ()
    shares: tuple[float, ...] = ()

    def passes(self, x: np.ndarray) -> np.ndarray:
        """Per row 1 if it goes to the first child."""
        column = x[:, self.feature]
        return (column <= self.threshold if self.left_set is None else np.isin(column, self.left_set)).astype(float)

    def depth(self) -> int:
        return 1 + max(c.depth() for c in self.children) if self.children else 0


def forest(model, spark, class_index: int = 1) -> list[Node]:
    """The trees of the ensemble; leaf values include the weight of the tree."""
    boosted = hasattr(model, "treeWeights") and type(model).__name__.startswith("GBT")
    trees: dict[int, dict[int, dict]] = {}
    for row in tree_nodes(model, spark).collect():
        trees.setdefault(row["treeID"], {})[row["id"]] = row.asDict(recursive=True)

    def build(nodes: dict[int, dict], node: dict, tree: int) -> Node:
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            return Node(node["prediction"] * model.treeWeights[tree] if boosted else stats[class_index] / sum(stats) / len(trees))
        split, below = node["split"], [nodes[node["leftChild"]], nodes[node["rightChild"]]]
        continuous = split["numCategories"] == -1
        return Node(
            0.0, split["featureIndex"], split["leftCategoriesOrThreshold"][0] if continuous else None,
            None if continuous else split["leftCategoriesOrThreshold"], tuple(build(nodes, n, tree) for n in below),
            tuple(max(n["rawCount"] / node["rawCount"], 1e-100) for n in below),
        )

    return [build(nodes, nodes[0], tree) for tree, nodes in sorted(trees.items())]


def shapley(x: np.ndarray, trees: Sequence[Node], n_features: int) -> tuple[np.ndarray, float]:
    """Contributions (rows x features) and the expected score."""
    out = np.zeros((len(x), n_features))
    points, weights = np.polynomial.legendre.leggauss(max(1, -(-max((t.depth() for t in trees), default=0) // 2)))
    t, w = (points + 1) / 2, weights / 2
    one = np.ones(len(x))

    def walk(node: Node, product: np.ndarray, open_: dict, reach: float) -> tuple[np.ndarray, float]:
        """Sums over the leaves below: value times product at the points, and value times share of rows."""
        if not node.children:
            return node.value * product, node.value * reach
        total, expected, goes = np.zeros_like(product), 0.0, node.passes(x)
        for child, share, passed in zip(node.children, node.shares, (goes, 1 - goes)):
            o_before, z_before, f_before = open_.get(node.feature, (one, 1.0, 1.0))
            o, z = o_before * passed, z_before * share
            factor = o[:, None] * t + (1 - t) * z
            below, e = walk(child, product * factor / f_before, {**open_, node.feature: (o, z, factor)}, reach * share)
            out[:, node.feature] += (o - z) * ((below / factor) @ w)
            if node.feature in open_:  # the test above settles these leaves as well, with what it knew of the feature
                out[:, node.feature] -= (o_before - z_before) * ((below / f_before) @ w)
            total, expected = total + below, expected + e
        return total, expected

    return out, sum(walk(tree, np.ones((len(x), len(t))), {}, 1.0)[1] for tree in trees)


def contributions(model, encoded: DataFrame, keys: Sequence[str], class_index: int = 1) -> DataFrame:
    """``keys``, one column ``c_{feature}`` per feature, ``bias`` and ``margin`` (their sum).

    The margin is the raw score of class 1 for boosted trees and the class probability for forests.
    """
    spark = encoded.sparkSession
    names = feature_names(encoded)
    trees = forest(model, spark, class_index)
    rows = encoded.select(*keys, vector_to_array(FEATURES).alias("_x"))
    fields = ", ".join(f"`c_{n}` double" for n in names)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_x")

    shared = rows.sparkSession.sparkContext.broadcast(trees)  # sent to each executor once

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            parts, bias = shapley(np.stack(pdf["_x"].to_numpy()), shared.value, len(names))
            out = pd.concat(
                [pdf.drop(columns="_x").reset_index(drop=True), pd.DataFrame(parts, columns=[f"c_{n}" for n in names])], axis=1
            )
            yield out.assign(bias=bias, margin=bias + parts.sum(axis=1))

    return rows.mapInPandas(explain, schema=f"{kept}, {fields}, bias double, margin double")
