"""Per-row attributions of a model and their mean size."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.boosting import NewtonTrees
from stayline.sources.store import scratch

ROWS = 65536  # rows that descend a tree at once
BELOW = 3  # height of the subtrees that rows enter as classes


def linear_contributions(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """weight * (value - mean) per feature: the exact attribution of a linear score."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in weights])).scalar()
    return df.withColumn("_means", means).select(
        "customer_id",
        *[((F.col(c) - F.col(f"_means.{c}")) * F.lit(float(w))).alias(c) for c, w in weights.items()],
    )


def mean_size(contributions: DataFrame, columns: list[str], top: int = 15) -> DataFrame:
    """Mean absolute attribution per feature, greatest first."""
    sums = contributions.agg(*[F.avg(F.abs(c)).alias(c) for c in columns])
    return (
        sums.unpivot([], columns, "feature", "mean_abs").orderBy(F.desc("mean_abs"), "feature").limit(top)
    )


def linear_weights(model: PipelineModel, columns: list[str]) -> dict[str, float]:
    """Weights on the unscaled features of a logistic model."""
    scaler, fitted = model.stages[-2], model.stages[-1]
    std = scaler.std.toArray()
    return {
        c: float(w / s) if s else 0.0
        for c, w, s in zip(columns, fitted.coefficients.toArray(), std)
    }


class TreeNodes(NamedTuple):
    """A tree as arrays over its nodes, node 0 the root: rows with feature <= cut go left, null ones
    where null_left says; leaves have feature -1; cover is how much of the training rows a node saw."""

    feature: np.ndarray
    cut: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


def model_trees(model: PipelineModel | NewtonTrees, spark) -> list[TreeNodes]:
    """Trees of a fitted tree or ensemble, their values weighted so that they add up to the
    score: a probability, or the margin of boosted trees (half of it for gradient-boosted ones)."""
    if isinstance(model, NewtonTrees):
        return [
            TreeNodes(
                np.array(t.feature), np.array([model.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)]),
                np.array(t.missing_left), np.array(t.left), np.array(t.right), np.array(t.value), np.array(t.cover))
            for t in model.trees
        ]
    fitted = model.stages[-1]
    path = scratch(spark, "trees")
    fitted.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    else:
        data = data.withColumn("treeID", F.lit(0))
    boosted = fitted.__class__.__name__.startswith("GBT")
    scale = fitted.treeWeights if hasattr(fitted, "treeWeights") else [1.0]
    total = 1.0 if boosted else float(sum(scale))
    by_tree: dict[int, dict] = {}
    for r in data.collect():  # as many rows as the model has nodes
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r
    out = []
    for tree_id, nodes in sorted(by_tree.items()):
        place = {node: i for i, node in enumerate(sorted(nodes))}
        rows = [nodes[node] for node in place]
        inner = [r["leftChild"] >= 0 for r in rows]

        def value(r):
            return r["prediction"] if boosted else r["impurityStats"][1] / sum(r["impurityStats"])

        out.append(TreeNodes(
            np.array([r["split"]["featureIndex"] if i else -1 for r, i in zip(rows, inner)]),
            np.array([r["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for r, i in zip(rows, inner)]),
            np.zeros(len(rows), bool),
            np.array([place[r["leftChild"]] if i else -1 for r, i in zip(rows, inner)]),
            np.array([place[r["rightChild"]] if i else -1 for r, i in zip(rows, inner)]),
            np.array([0.0 if i else scale[tree_id] / total * value(r) for r, i in zip(rows, inner)]),
            np.array([float(r["rawCount"]) for r in rows]),
        ))
    return out


def _unwound(weights: np.ndarray, share: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Path weights as they were before a feature came in, for several features at once: weights is
    (m + 1, rows), share (features, 1), inside (features, rows); the result (m, features, rows)."""
    m = len(weights) - 1
    out = np.empty((m, *inside.shape))
    after = np.broadcast_to(weights[m], inside.shape)
    for j in range(m - 1, -1, -1):
        part = share * ((m - j) / (m + 1))
        told = after * ((m + 1) / (j + 1))
        out[j] = np.where(inside, told, weights[j] / part)
        after = weights[j] - told * part
    return out


def _heights(tree: TreeNodes) -> np.ndarray:
    """Splits on the longest way from each node to a leaf."""
    order = [0]
    for node in order:
        if tree.feature[node] >= 0:
            order += [tree.left[node], tree.right[node]]
    out = np.zeros(len(tree.feature), int)
    for node in reversed(order):
        if tree.feature[node] >= 0:
            out[node] = 1 + max(out[tree.left[node]], out[tree.right[node]])
    return out


def tree_shapley(tree: TreeNodes, x: np.ndarray, out: np.ndarray) -> None:
    """Adds the path-dependent Shapley values of a tree, for all rows of x, to out (features, rows).

    One descent: entry k of the path weights is the weight of the subsets of k features of the
    path, in which a feature lets a row pass if it is in the subset and the row goes that way, and
    with the share of training rows that went that way if not. A split extends the weights; a
    feature that comes again is taken out first; at a leaf each feature is taken out in turn.
    Rows that went alike at all splits of a path so far are one pattern and share its weights. A
    subtree of height BELOW is entered by classes only, rows of one pattern that go alike at all
    of its splits: its values are added up for the classes and dealt to their rows once.
    """
    height = _heights(tree)

    def goes_left(node: int, x: np.ndarray) -> np.ndarray:
        values, cut = x[tree.feature[node]], tree.cut[node]
        return ~(values > cut) if tree.null_left[node] else values <= cut

    def by_class(
        node: int, path: list[int], share: list[float], inside: list[np.ndarray], weights: np.ndarray, pattern: np.ndarray,
        x: np.ndarray, out: np.ndarray,
    ) -> None:
        splits, under = [], [node]
        for n in under:
            if tree.feature[n] >= 0:
                splits.append(n)
                under += [tree.left[n], tree.right[n]]
        code = pattern << len(splits)
        for i, n in enumerate(splits):
            code |= goes_left(n, x).astype(np.int64) << i
        found = np.zeros(weights.shape[1] << len(splits), bool)
        found[code] = True
        place = np.cumsum(found) - 1
        group = place[code]
        row = np.empty(place[-1] + 1, np.int64)
        row[group] = np.arange(len(group))  # any row of a class stands for it
        sums = np.zeros((len(out), len(row)))
        descend(node, path, share, inside, weights, pattern[row], x[:, row], sums, True)
        for f in {*path, *(tree.feature[n] for n in splits)}:
            out[f] += sums[f][group]

    def descend(
        node: int, path: list[int], share: list[float], inside: list[np.ndarray], weights: np.ndarray, pattern: np.ndarray,
        x: np.ndarray, out: np.ndarray, classes: bool = False,
    ) -> None:
        m = len(path)
        feature = tree.feature[node]
        if not classes and 0 < height[node] <= BELOW:
            by_class(node, path, share, inside, weights, pattern, x, out)
            return
        if feature < 0:
            if m and tree.value[node]:
                passes, shares = np.stack(inside), np.array(share)[:, None]
                worth = _unwound(weights, shares, passes).sum(axis=0) * (passes - shares) * tree.value[node]
                for f, add in zip(path, worth):
                    out[f] += add[pattern]
            return
        was, had = 1.0, np.ones(weights.shape[1], bool)
        if feature in path:
            i = path.index(feature)
            was, had = share[i], inside[i]
            weights = _unwound(weights, np.array([[was]]), had[None])[:, 0]
            path, share, inside = path[:i] + path[i + 1 :], share[:i] + share[i + 1 :], inside[:i] + inside[i + 1 :]
            m -= 1
        finer = 2 * pattern + goes_left(node, x)
        present = np.bincount(finer, minlength=2 * len(had)) > 0
        pattern = (np.cumsum(present) - 1)[finer]
        source, went = np.divmod(np.flatnonzero(present), 2)
        inside, weights, had, went = [p[source] for p in inside], weights[:, source], had[source], went.astype(bool)
        grown = np.arange(1, m + 2)[:, None] / (m + 2)
        for child, there in ((tree.left[node], went), (tree.right[node], ~went)):
            passes = there & had
            part = max(was * tree.cover[child] / max(tree.cover[node], 1e-300), 1e-12)  # no row at all: as good as none
            more = np.zeros((m + 2, len(source)))
            more[:-1] = weights * (part * grown[::-1])
            more[1:] += weights * grown * passes
            descend(child, path + [feature], share + [part], inside + [passes], more, pattern, x, out, classes)

    if len(x):
        descend(0, [], [], [], np.ones((1, 1)), np.zeros(len(x), np.int64), np.ascontiguousarray(x.T), out)


def _larger(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches of at least so many rows each, the last one apart."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def tree_contributions(rows: DataFrame, trees: list[TreeNodes], columns: list[str]) -> DataFrame:
    """Path-dependent Shapley values of a tree ensemble for rows with a `features` array. The
    model is shared with all tasks; its size depends on the settings alone."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    key_type = dict(rows.dtypes)["customer_id"]
    schema = f"customer_id {key_type}, " + ", ".join(f"`{c}` double" for c in columns)

    def attribute(batches):
        for batch in _larger(batches, ROWS):
            x = np.array(batch["features"].tolist(), dtype=float).reshape(-1, len(columns))
            out = np.zeros((len(columns), len(x)))
            for at in range(0, len(x), 2 * ROWS):
                for tree in shared.value:
                    tree_shapley(tree, x[at : at + 2 * ROWS], out[:, at : at + 2 * ROWS])
            frame = pd.DataFrame(out.T, columns=columns)
            frame.insert(0, "customer_id", batch["customer_id"].to_numpy())
            yield frame

    return rows.mapInPandas(attribute, schema)


def shap_contributions(model: PipelineModel | NewtonTrees, test: DataFrame, columns: list[str]) -> DataFrame:
    """Attributions of every test row: closed form for the linear model, tree Shapley
    values otherwise. Rows are spread over tasks; each task descends each tree once a batch."""
    from pyspark.ml.functions import vector_to_array

    if isinstance(model, NewtonTrees):
        values = F.array(*[F.col(c).cast("double") for c in model.columns]).alias("features")
        rows = test.select("customer_id", values).repartition("customer_id")
        return tree_contributions(rows, model_trees(model, test.sparkSession), columns)
    if model.stages[-1].__class__.__name__.startswith("Logistic"):
        return linear_contributions(test, linear_weights(model, columns))
    scaled = PipelineModel(model.stages[:-1]).transform(test)
    rows = scaled.select("customer_id", vector_to_array("features").alias("features")).repartition("customer_id")
    return tree_contributions(rows, model_trees(model, test.sparkSession), columns)
