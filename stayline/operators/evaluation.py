"""Classification metrics as aggregates over scored rows.

Curves need a running count over falling scores. Rows are first counted per
distinct score, then summed with the range-partitioned running total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ordering import InOrder


def classification_metrics(
    scored: DataFrame, label: str = "churn", score: str = "churn_prob", threshold: float = 0.5
) -> DataFrame:
    """Accuracy, precision, recall and F1 in one pass; 0 where undefined."""
    truth, guess = F.col(label) == 1, F.col(score) >= threshold
    counts = scored.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return counts.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(
    scored: DataFrame, label: str = "churn", score: str = "churn_prob", threshold: float = 0.5
) -> DataFrame:
    """Counts of all four (actual, predicted) pairs."""
    truth, guess = F.col(label), F.col(score) >= threshold
    pairs = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = scored.agg(
        *[F.count_if((truth == a) & (guess == F.lit(bool(p)))).alias(f"c{a}{p}") for a, p in pairs]
    )
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n"))
        for a, p in pairs
    ]
    return counts.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def score_curve(scored: DataFrame, label: str = "churn", score: str = "churn_prob") -> DataFrame:
    """Per distinct score: positives and negatives at it (pos, neg) and at or above it (tp, fp)."""
    per_score = scored.filter(F.col(label).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )
    return InOrder(per_score, F.desc("threshold")).running({"tp": "pos", "fp": "neg"})


def _totals(curve: DataFrame):
    both = curve.agg(
        F.struct(F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    ).scalar()
    return both["p"], both["n"]


def roc_points(curve: DataFrame) -> DataFrame:
    positives, negatives = _totals(curve)
    return curve.select(
        "threshold",
        F.try_divide("fp", negatives).alias("fpr"),
        F.try_divide("tp", positives).alias("tpr"),
    )


def pr_points(curve: DataFrame) -> DataFrame:
    positives, _ = _totals(curve)
    return curve.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", positives).alias("recall"),
    )


def auc_roc(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    area = F.sum(
        F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos")).cast("double") / 2
    )
    return curve.agg(
        F.try_divide(
            area, F.sum("pos").cast("double") * F.sum("neg").cast("double")
        ).alias("auc_roc")
    )


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of recall steps times precision, without interpolation."""
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    return curve.agg(
        F.try_divide(
            F.sum(F.col("pos") * tp / (tp + fp)), F.sum("pos").cast("double")
        ).alias("average_precision")
    )


METRICS = ["accuracy", "precision", "recall", "f1", "auc_roc", "average_precision"]


def evaluate(scored: DataFrame, label: str = "churn", score: str = "churn_prob", model: str = "model") -> DataFrame:
    """One row with all six metrics."""
    curve = score_curve(scored, label, score)
    return classification_metrics(scored, label, score).select(
        F.lit(model).alias("model"),
        "*",
        auc_roc(curve).scalar().alias("auc_roc"),
        average_precision(curve).scalar().alias("average_precision"),
    )


def compare_models(scored: dict[str, DataFrame], label: str = "churn", score: str = "churn_prob") -> DataFrame:
    rows = [evaluate(df, label, score, name) for name, df in scored.items()]
    return reduce(DataFrame.unionByName, rows)
