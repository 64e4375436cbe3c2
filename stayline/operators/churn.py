"""Churn models: training, comparison, scoring, importances."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import synth
from stayline.functions.scalars import predicted_flag
from stayline.operators import boosting, evaluation, features, labels
from stayline.operators.oversampling import smote
from stayline.session import freeze
from stayline.sources.store import exists

MODELS = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting"]
NEWTON = "Newton Boosting"  # may stand beside the others, or for Gradient Boosting
Model = PipelineModel | boosting.NewtonTrees
LEAST_PARTS = 8  # partitions of training rows that are not merged
TREES = ["Decision Tree", "Random Forest", "Gradient Boosting"]
TREE_BINS = 32  # bins of a feature in these trees
DRAWN = 10_000  # rows beyond which they look for cuts in a draw of max(DRAWN, maxBins ** 2) rows
MOST_BINS = 46_340  # the greatest maxBins whose square is an int


def leak_free_features(people: DataFrame, txn: DataFrame, engagement: DataFrame, cfg: Settings) -> DataFrame:
    """Features as of the split date, from purchases before it."""
    before = txn.filter(F.col("order_date") < F.lit(cfg.split_date))
    return features.customer_features(people, before, engagement, cfg, as_of=cfg.split_date)


def classifier(name: str, n_rows: int, cfg: Settings):
    common = {"featuresCol": "features", "labelCol": "churn", "weightCol": "weight"}
    if name == "Logistic Regression":
        return LogisticRegression(
            maxIter=cfg.max_iter, regParam=1.0 / max(n_rows, 1), standardization=False, **common
        )
    common["seed"] = cfg.seed
    if name == "Decision Tree":
        return DecisionTreeClassifier(maxDepth=cfg.tree_depth, **common)
    if name == "Random Forest":
        return RandomForestClassifier(numTrees=cfg.forest_trees, maxDepth=cfg.forest_depth, **common)
    if name == "Gradient Boosting":
        return GBTClassifier(
            maxIter=cfg.boosting_rounds, maxDepth=cfg.boosting_depth, stepSize=cfg.boosting_rate, **common
        )
    raise ValueError(f"unknown model {name}")


def weighted(train: DataFrame) -> DataFrame:
    """Adds the balanced class weight: two label values, so two constants."""
    weights = labels.class_weights(train).select("churn", "balanced_weight").collect()
    out = F.lit(1.0)
    for r in weights:
        out = F.when(F.col("churn") == r["churn"], F.lit(r["balanced_weight"])).otherwise(out)
    return train.withColumn("weight", out)


def tree_bins(train: DataFrame, columns: list[str], cfg: Settings) -> Bucketizer:
    """Numbers of the bins of each feature, whose cuts come from all rows; common values, such as the
    whole numbers between which oversampled rows lie, take one bin each.

    Spark's tree learners take their candidate cuts from a draw of rows. On numbers of at most TREE_BINS
    bins, maxBins may grow until the draw is the whole table: they find as many values, and
    keep as many bins, as there are numbers."""
    found = boosting.cut_points(train, columns, "customer_id", TREE_BINS, None, cfg.seed, capped=True)
    inf = float("inf")
    # a row equal to a cut goes left, and buckets begin with their lower end
    splits = [[-inf, *([math.nextafter(v, inf) for v in cuts] or [0.0]), inf] for cuts in found]
    return Bucketizer(splitsArray=splits, inputCols=columns, outputCols=bin_names(columns))


def bin_names(columns: list[str]) -> list[str]:
    return [f"{c}_bin" for c in columns]


def train_models(
    train: DataFrame, columns: list[str], cfg: Settings, names: list[str] | None = None
) -> dict[str, Model]:
    """One fitted pipeline (assemble, scale, classify) per model name; Newton-boosted trees need
    neither scaling nor class weights, as the positive weight follows from the labels.

    Tree learners ship the statistics of every open node once for each partition and run a task
    a partition for every level, so small partitions are merged before."""
    train = freeze(weighted(train))
    n_rows = train.count()
    train = train.coalesce(max(LEAST_PARTS, -(-n_rows // boosting.ROWS_A_TASK)))
    names = names or MODELS
    bins = tree_bins(train, columns, cfg) if n_rows > DRAWN and {*TREES} & {*names} else None

    def fit(name: str) -> Model:
        if name == NEWTON:
            return boosting.fit(
                train, columns, rounds=cfg.boosting_rounds, depth=cfg.boosting_depth, rate=cfg.boosting_rate, seed=cfg.seed)
        learner, first, inputs = classifier(name, n_rows, cfg), [], columns
        if bins and name in TREES:
            learner.setMaxBins(min(MOST_BINS, math.isqrt(n_rows) + 1))
            first, inputs = [bins], bin_names(columns)
        prepare = [
            VectorAssembler(inputCols=inputs, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        ]
        return Pipeline(stages=[*first, *prepare, learner]).fit(train)

    with ThreadPoolExecutor(len(names)) as pool:  # the models don't depend on one another
        return dict(zip(names, pool.map(fit, names)))


def save_model(model: Model, spark: SparkSession, path: str) -> None:
    """Write a fitted model of either kind; `load_model` reads it back."""
    if isinstance(model, boosting.NewtonTrees):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    pipeline = exists(spark, f"{path}/stages")
    return PipelineModel.load(path) if pipeline else boosting.NewtonTrees.load(spark, path)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Adds churn_prob; the vector columns are dropped."""
    if isinstance(model, boosting.NewtonTrees):
        return model.score(df)
    out = model.transform(df).withColumn("churn_prob", vector_to_array("probability")[1])
    made = [c for s in model.stages if isinstance(s, Bucketizer) for c in s.getOutputCols()]
    return out.drop(*made, "raw_features", "features", "rawPrediction", "probability", "prediction")


def score_all(model: Model, customers: DataFrame) -> DataFrame:
    """Probability and flag for every customer, labelled or not."""
    matrix = labels.feature_matrix(customers)
    scored = score(model, matrix).select("customer_id", "churn_prob")
    return customers.join(scored, "customer_id", "left").withColumn(
        "churn_predicted", predicted_flag("churn_prob")
    )


def feature_importance(models: dict[str, Model], columns: list[str], top: int | None = None) -> DataFrame:
    """Importances of the tree ensembles; as many rows as features."""
    rows = []
    for name, model in models.items():
        if isinstance(model, boosting.NewtonTrees):
            values = model.gains()
        elif (found := getattr(model.stages[-1], "featureImportances", None)) is not None:
            values = found.toArray().tolist()
        else:
            continue
        ranked = sorted(zip(columns, values), key=lambda p: (-p[1], p[0]))
        rows += [(name, place, c, float(v)) for place, (c, v) in enumerate(ranked[:top], start=1)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "model string, place int, feature string, importance double")


@dataclass
class Run:
    """What a training run leaves."""

    models: dict
    comparison: DataFrame
    best_name: str
    best: Model
    scored: DataFrame
    test: DataFrame
    columns: list
    train: DataFrame


def prepared(customers: DataFrame, target: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame, list[str]]:
    """Balanced training rows, made from all of the training share, untouched test rows, feature names."""
    matrix = freeze(labels.feature_matrix(labels.labelled(customers, target)))
    columns = labels.model_columns(matrix)
    split = freeze(labels.stratified_split(matrix, cfg))
    train = smote(split.filter("is_train").drop("is_train"), columns, cfg)
    return train, split.filter(~F.col("is_train")), columns


def bounded(train: DataFrame, cfg: Settings) -> DataFrame:
    """About fit_rows of the training rows, the same share of either label, by a hashed
    draw of the customer; all of them where there are fewer. For trials by hand: no query and
    no phase draws rows, all models are fitted on the whole training share."""
    share = cfg.fit_rows / max(1, train.count())
    return train.filter(synth.uniform(cfg.seed, "fit", "customer_id") < min(1.0, share))


def train_and_score(
    customers: DataFrame, target: DataFrame, cfg: Settings, names: list[str] | None = None
) -> Run:
    """Labels to scored customers: split, oversample, train, compare, score with the best."""
    train, test, columns = prepared(customers, target, cfg)
    models = train_models(train, columns, cfg, names)
    scored_test = {n: freeze(score(m, test).select("customer_id", "churn", "churn_prob")) for n, m in models.items()}
    comparison = freeze(evaluation.compare_models(scored_test))
    best_name = comparison.orderBy(F.desc("auc_roc"), "model").first()["model"]
    scored = labels.with_actual_label(score_all(models[best_name], customers), target)
    return Run(models, comparison, best_name, models[best_name], scored, test, columns, train)


# -- what must hold of fitted models -------------------------------------------------


def logistic_gradient(model: PipelineModel, train: DataFrame) -> dict[str, float]:
    """Slope of the fitted logistic model's penalised mean loss, for each coefficient and the
    intercept, over its training rows."""
    fitted = model.stages[-1]
    rows = PipelineModel(model.stages[:-1]).transform(weighted(train))
    rows = rows.withColumn("x", vector_to_array("features")).withColumn("w", F.col("weight"))
    beta = [float(b) for b in fitted.coefficients]
    margin = sum((F.get("x", F.lit(i)) * F.lit(b) for i, b in enumerate(beta)), F.lit(float(fitted.intercept)))
    off = (1 / (1 + F.exp(-margin)) - F.col("churn")) * F.col("w")
    sums = rows.withColumn("off", off).agg(
        F.sum("w").alias("w"), F.sum("off").alias("intercept"),
        *[F.sum(F.col("off") * F.get("x", F.lit(i))).alias(f"g{i}") for i in range(len(beta))]).first()
    penalty = fitted.getRegParam()
    out = {str(i): sums[f"g{i}"] / sums["w"] + penalty * b for i, b in enumerate(beta)}
    return out | {"intercept": sums["intercept"] / sums["w"]}


def replayed(tree, rows: DataFrame) -> DataFrame:
    """(node, n): how many rows of a `features` array pass each node of a tree."""
    feature, cut, left, right, null_left = tree.feature, tree.cut, tree.left, tree.right, tree.null_left

    def walked(batches):
        total = np.zeros(len(feature), np.int64)
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            at, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
            total[0] += len(x)
            while len(open_ := open_[feature[at[open_]] >= 0]):
                node = at[open_]
                value = x[open_, feature[node]]
                goes = np.where(np.isnan(value), null_left[node], value <= cut[node])
                at[open_] = np.where(goes, left[node], right[node])
                total += np.bincount(at[open_], minlength=len(feature))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["node", "n"])

    return rows.select("features").mapInArrow(walked, "node int, n long").groupBy("node").agg(F.sum("n").alias("n"))
