"""Churn labels, the feature matrix and the train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S
from stayline.functions import synth
from stayline.operators.ingest import of_customers
from stayline.operators.ordering import group_cut

# Features of the churn models.
MODEL_FEATURES = [
    "recency_days", "frequency", "monetary", "avg_order_value", "median_order_value",
    "purchase_std", "categories_purchased", "category_concentration", "avg_quantity",
    "discount_usage_rate", "avg_discount_pct", "return_rate", "interpurchase_time_avg",
    "interpurchase_time_std", "spending_trend", "frequency_trend", "aov_trend",
    "engagement_score", "emails_opened_30d", "website_visits_30d", "campaign_clicks_30d",
    "app_sessions_30d", "support_tickets", "customer_tenure_days", "loyalty_program", "age",
]


def churn_labels(txn: DataFrame, split_date, as_of) -> DataFrame:
    """1 for customers who bought before the split and not in [split, as_of]."""
    day = F.col("order_date")
    seen = of_customers(txn).groupBy("customer_id").agg(
        F.max(day < F.lit(split_date)).alias("before"),
        F.max((day >= F.lit(split_date)) & (day <= F.lit(as_of))).alias("after"),
    )
    return seen.filter("before").select(
        "customer_id", F.when(F.col("after"), 0).otherwise(1).alias("churn")
    )


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.avg("churn").alias("churn_rate"),
        F.sum("churn").alias("churned"),
        F.count(F.lit(1)).alias("customers"),
    )


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, "customer_id")


def with_actual_label(scored: DataFrame, labels: DataFrame) -> DataFrame:
    return scored.join(
        labels.withColumnRenamed("churn", "churn_actual"), "customer_id", "left"
    )


def model_columns(df: DataFrame) -> list[str]:
    return [c for c in MODEL_FEATURES if c in df.columns]


def feature_matrix(df: DataFrame) -> DataFrame:
    """Model features present in df as finite doubles, keys and label kept."""
    keep = [c for c in ("customer_id", "churn") if c in df.columns]
    return df.select(*keep, *[S.finite_or_zero(c).alias(c) for c in model_columns(df)])


def stratified_split(df: DataFrame, cfg: Settings, label: str = "churn") -> DataFrame:
    """Adds is_train: exactly the training share of each label, by a hashed draw."""
    drawn = df.withColumn("_draw", synth.uniform(cfg.seed, "split", "customer_id"))
    inside = group_cut(drawn, label, "_draw", "customer_id", 1.0 - cfg.test_share)
    return drawn.withColumn("is_train", inside).drop("_draw")


def class_weights(labels: DataFrame, label: str = "churn") -> DataFrame:
    """Balanced weight n / (classes * class size) and the negative/positive ratio."""
    sizes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, classes = sizes.agg(F.sum("n")).scalar(), sizes.agg(F.count(F.lit(1))).scalar()
    positive = sizes.agg(F.sum(F.when(F.col(label) == 1, F.col("n")))).scalar()
    return sizes.select(
        label,
        "n",
        (total / (classes * F.col("n"))).alias("balanced_weight"),
        ((total - positive) / F.greatest(positive, F.lit(1))).alias("neg_pos_ratio"),
    )


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population spread; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        )
    ).scalar()
    mean, spread = (lambda c: F.col(f"_stats.{c}_m")), (lambda c: F.col(f"_stats.{c}_s"))
    scaled = {
        c: F.when(spread(c) > 0, (F.col(c) - mean(c)) / spread(c)).otherwise(0.0) for c in columns
    }
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")
