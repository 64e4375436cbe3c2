"""Retention economics, priority score, actions and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.config import RISK_TIERS, VALUE_TIERS, Settings
from stayline.functions import scalars as S
from stayline.functions.scalars import mean, total

# Columns of the target list.
REPORT_COLUMNS = [
    "priority_rank", "customer_id", "customer_profit", "churn_prob", "expected_retention_value",
    "intervention_cost", "expected_net_benefit", "retention_priority_score", "rfm_segment",
    "value_tier", "recommended_action",
]


def intervention_cost(df: DataFrame, cfg: Settings) -> DataFrame:
    costs = {k: float(v) for k, v in cfg.intervention_costs.items()}
    return df.withColumn("intervention_cost", S.lookup("value_tier", costs, costs["Low Value"]))


def success_probability(df: DataFrame, cfg: Settings) -> DataFrame:
    return df.withColumn(
        "success_prob",
        S.lookup("rfm_segment", cfg.success_probabilities, cfg.default_success_probability),
    )


def expected_values(df: DataFrame) -> DataFrame:
    value = F.col("customer_profit") * F.col("churn_prob") * F.col("success_prob")
    return df.withColumn("expected_retention_value", value).withColumn(
        "expected_net_benefit", F.col("expected_retention_value") - F.col("intervention_cost")
    )


PARTS = ["customer_profit", "churn_prob", "expected_net_benefit"]


def normalised(df: DataFrame, columns: list[str] | None = None, suffix: str = "_norm") -> DataFrame:
    """Each column scaled to [0, 1] over all rows; a constant column becomes 0.5."""
    columns = columns or PARTS
    span = df.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_low") for c in columns],
            *[F.max(c).alias(f"{c}_high") for c in columns],
        )
    ).scalar()
    scaled = {
        c + suffix: S.scale_to_unit(c, F.col(f"_span.{c}_low"), F.col(f"_span.{c}_high")) for c in columns
    }
    return df.withColumn("_span", span).withColumns(scaled).drop("_span")


def weighted_score(weights: tuple):
    parts = [F.lit(w) * F.col(f"{c}_norm") for w, c in zip(weights, PARTS)]
    return (parts[0] + parts[1] + parts[2]) * 100


def priority_rank(df: DataFrame) -> DataFrame:
    """Rank by falling score, equal scores share the smallest rank.

    The score has one decimal in 0..100, so there are at most 1,001 different
    scores: they are ranked instead of the customers and looked up by broadcast.
    """
    sizes = df.groupBy("retention_priority_score").count()
    ahead = (
        Window.orderBy(F.desc("retention_priority_score"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = sizes.filter(F.col("retention_priority_score").isNotNull()).select(
        "retention_priority_score",
        (F.coalesce(F.sum("count").over(ahead), F.lit(0)) + 1).alias("priority_rank"),
    )
    return df.join(F.broadcast(ranks), "retention_priority_score", "left")


def retention_economics(df: DataFrame, weights: tuple) -> DataFrame:
    """Expected value, net benefit, priority score, rank and action.

    df should be a stored table: score and rank read it more than once.
    """
    out = normalised(expected_values(df))
    out = out.withColumn("retention_priority_score", S.round_even(weighted_score(weights), 1))
    out = priority_rank(out.drop(*[f"{c}_norm" for c in PARTS]))
    return out.withColumn(
        "recommended_action",
        S.recommended_action("value_tier", "churn_prob", "expected_net_benefit"),
    )


def prioritise(df: DataFrame, cfg: Settings) -> DataFrame:
    """Customers with churn probability to the final retention table."""
    df = df.fillna(0, subset=["customer_profit"])
    df = success_probability(intervention_cost(df, cfg), cfg)
    out = retention_economics(df, cfg.priority_weights)
    return out.withColumn("risk_tier", S.risk_tier("churn_prob"))


# -- reports ------------------------------------------------------------------


def top_by_rank(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy("priority_rank", "customer_id").limit(n)


def top_targets(df: DataFrame, n: int = 20) -> DataFrame:
    top = top_by_rank(df, n).select(*[c for c in REPORT_COLUMNS if c in df.columns])
    whole = ["customer_profit", "expected_retention_value", "expected_net_benefit"]
    rounded = {c: S.round_even(c, 0) for c in whole if c in top.columns}
    if "churn_prob" in top.columns:
        rounded["churn_prob"] = S.round_even("churn_prob", 2)
    return top.withColumns(rounded)


def top_alerts(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc("retention_priority_score"), "customer_id").limit(n).select(
        "customer_id", "customer_profit", "churn_prob", "retention_priority_score",
        "recommended_action",
    )


def high_value_at_risk(df: DataFrame, n: int = 20, threshold: float = 0.5) -> DataFrame:
    """High-value customers likely to churn, greatest profit first."""
    risky = df.filter((F.col("value_tier") == "High Value") & (F.col("churn_prob") >= threshold))
    return risky.orderBy(F.desc("customer_profit"), "customer_id").limit(n).select(
        "customer_id", "customer_profit", "churn_prob", "recommended_action"
    )


def highest_risk_segment(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("rfm_segment").agg(mean("churn_prob").alias("avg_churn_prob"))
        .orderBy(F.desc("avg_churn_prob"), "rfm_segment").limit(1)
    )


def decision_matrix(df: DataFrame) -> DataFrame:
    """Value tier x risk tier; every risk tier appears for each observed value tier."""
    known = df.filter(F.col("value_tier").isNotNull())
    cells = known.filter(F.col("risk_tier").isNotNull()).groupBy("value_tier", "risk_tier").agg(
        F.count("customer_id").alias("n"),
        mean("customer_profit").alias("profit"),
        mean("churn_prob").alias("prob"),
        total("expected_retention_value").alias("value"),
        mean("retention_priority_score").alias("score"),
    )
    grid = known.select("value_tier").distinct().select(
        "value_tier", F.explode(F.array(*[F.lit(t) for t in RISK_TIERS])).alias("risk_tier")
    )
    return grid.join(cells, ["value_tier", "risk_tier"], "left").select(
        "value_tier",
        "risk_tier",
        F.coalesce("n", F.lit(0)).alias("customer_count"),
        S.round_even("profit", 0).alias("avg_profit"),
        S.round_even("prob", 2).alias("avg_churn_prob"),
        S.round_even(F.coalesce("value", F.lit(0.0)), 0).alias("total_profit_at_risk"),
        S.round_even("score", 1).alias("avg_priority"),
    )


def decision_pivot(df: DataFrame) -> DataFrame:
    """Customers (and mean net benefit) per value tier, one column per risk tier."""
    tiers = F.array_position(F.array(*[F.lit(t) for t in VALUE_TIERS]), F.col("value_tier"))
    counts = (
        df.filter(F.col("value_tier").isNotNull())
        .groupBy("value_tier").pivot("risk_tier", RISK_TIERS)
        .agg(F.count("customer_id").alias("customers"), F.avg("expected_net_benefit").alias("benefit"))
    )
    short = {t: t.split()[0].lower() for t in RISK_TIERS}
    return counts.select(
        "value_tier",
        *[F.coalesce(F.col(f"{t}_customers"), F.lit(0)).alias(f"{s}_risk") for t, s in short.items()],
        *[F.col(f"{t}_benefit").alias(f"{s}_risk_benefit") for t, s in short.items()],
    ).orderBy(tiers)


def retention_summary(df: DataFrame) -> DataFrame:
    gain = F.col("expected_net_benefit") > 0

    def gaining(column: str):
        return F.coalesce(S.inexact(F.sum(F.when(gain, S.exact(column, 6))), 6), F.lit(0.0))

    out = df.agg(
        total("expected_retention_value").alias("total_erv"),
        gaining("intervention_cost").alias("budget"),
        gaining("expected_net_benefit").alias("net_benefit"),
        F.count_if(gain).alias("positive_roi"),
        F.count_if(F.col("expected_net_benefit") <= 0).alias("negative_roi"),
        F.count(F.lit(1)).alias("customers"),
    )
    return out.withColumns(
        {
            "positive_share": F.try_divide(F.col("positive_roi").cast("double"), "customers"),
            "roi_pct": F.try_divide("net_benefit", "budget") * 100,
        }
    )


def split_by_roi(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    gain = F.col("expected_net_benefit")
    return df.filter(gain > 0), df.filter(gain <= 0)


def action_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("customers")).orderBy(
        F.desc("customers"), "recommended_action"
    )


def segment_net_benefit(df: DataFrame) -> DataFrame:
    return df.groupBy("rfm_segment").agg(
        mean("expected_net_benefit").alias("avg_net_benefit")
    ).orderBy("avg_net_benefit")


def segment_churn(df: DataFrame) -> DataFrame:
    return df.groupBy("rfm_segment").agg(
        mean("churn_prob").alias("avg_churn_prob"),
        F.avg("churn_predicted").alias("predicted_rate"),
    ).orderBy(F.desc("avg_churn_prob"))


# -- sensitivity ---------------------------------------------------------------


def scores_by_weights(df: DataFrame, cfg: Settings) -> DataFrame:
    """One row per customer and weight set."""
    sets = [
        F.struct(F.lit(name).alias("weights"), weighted_score(w).alias("score"))
        for name, w in cfg.weight_sets.items()
    ]
    return normalised(df).select("customer_id", F.explode(F.array(*sets)).alias("s")).select(
        "customer_id", "s.weights", "s.score"
    )


def top_sets(scores: DataFrame, n: int = 20) -> DataFrame:
    """The n best customers per weight set; only n rows per task and set are shuffled,
    since the row number filter is applied before the exchange as well."""
    best = Window.partitionBy("weights").orderBy(F.desc("score"), "customer_id")
    return scores.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)


def topk_overlap(scores: DataFrame, cfg: Settings, n: int = 20) -> DataFrame:
    """How many of the best n are also best with the first weight set.

    The lists have n rows for each weight set, so whether a customer is on the first list is
    found among these rows, and the scores are computed once.
    """
    default = next(iter(cfg.weight_sets))
    same = F.max(F.col("weights") == default).over(Window.partitionBy("customer_id"))
    return (
        top_sets(scores, n).withColumn("same", same)
        .filter(F.col("weights") != default)
        .groupBy("weights")
        .agg(F.count_if("same").alias("overlap"))
        .withColumn("overlap_share", F.col("overlap") / F.lit(float(n)))
    )


def sensitivity_analysis(df: DataFrame, cfg: Settings, n: int = 20) -> DataFrame:
    """Mean score and overlap of the top lists per weight set; the means come from one
    aggregate over all customers, one column for each weight set."""
    sets = {f"s{i}": (name, weights) for i, (name, weights) in enumerate(cfg.weight_sets.items())}
    means = normalised(df).agg(*[F.avg(weighted_score(w)).alias(c) for c, (_, w) in sets.items()])
    means = means.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("weights"), F.col(c).alias("avg_score")) for c, (name, _) in sets.items()
    ])).alias("m")).select("m.*")
    overlap = topk_overlap(scores_by_weights(df, cfg), cfg, n)
    return means.join(overlap, "weights", "left").fillna(n, subset=["overlap"]).fillna(
        1.0, subset=["overlap_share"]
    )
