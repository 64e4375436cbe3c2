"""Dashboard measures over the final customer table.

Every measure takes the filtered table a slicer would leave, so any slicer is a
filter in front of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.functions.scalars import mean, total
from stayline.operators.profitability import COSTS
from stayline.operators.segmentation import share_of_total

def rows() -> Column:
    return F.count(F.lit(1))


def _where(condition: Column, column: str) -> Column:
    """Exact sum of a money column over the rows that meet a condition."""
    return F.coalesce(S.inexact(F.sum(F.when(condition, S.exact(column, 6))), 6), F.lit(0.0))


def _divide(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def overview(df: DataFrame) -> DataFrame:
    leaving, risky = F.col("churn_predicted") == 1, F.col("churn_prob") >= 0.5
    return df.agg(
        rows().alias("total_customers"),
        total("gross_revenue").alias("total_revenue"),
        total("customer_profit").alias("total_profit"),
        mean("customer_profit").alias("avg_customer_profit"),
        F.count_if(F.col("churn_predicted") == 0).alias("active_customers"),
        _divide(F.count_if(leaving), rows()).alias("overall_churn_rate"),
        F.count_if(risky).alias("at_risk_customers"),
        _where(risky, "expected_retention_value").alias("profit_at_risk"),
    )


def active_90d(df: DataFrame, days: int = 90) -> DataFrame:
    return df.agg(
        F.count_if(F.col("recency_days") <= days).alias("active_customers"),
        _divide(F.count_if(F.col("churn_prob") > 0.5), rows()).alias("churn_risk_share"),
    )


def margin(df: DataFrame) -> DataFrame:
    return df.agg(
        _divide(total("customer_profit"), total("gross_revenue")).alias("profit_margin"),
        mean("profit_margin").alias("avg_profit_margin"),
    )


def by_segment(df: DataFrame) -> DataFrame:
    return df.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customers"),
        mean("gross_revenue").alias("avg_revenue"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("recency_days").alias("avg_recency"),
        mean("monetary").alias("avg_monetary"),
        mean("avg_order_value").alias("avg_aov"),
        mean("engagement_score").alias("avg_engagement"),
        mean("profit_margin").alias("avg_margin"),
        F.count_if(F.col("value_tier") == "High Value").alias("high_value_count"),
    )


def segment_share(df: DataFrame) -> DataFrame:
    """Shares with the segment filter removed."""
    out = df.groupBy("rfm_segment").agg(total("gross_revenue").alias("revenue"), rows().alias("customers"))
    out = share_of_total(out, "revenue", "revenue_share", 1.0)
    return share_of_total(out, "customers", "customer_share", 1.0)


def unprofitable(df: DataFrame) -> DataFrame:
    loss = F.count_if(F.col("customer_profit") < 0)
    return df.agg(loss.alias("unprofitable"), _divide(loss, rows()).alias("unprofitable_share"))


def cost_components(df: DataFrame) -> DataFrame:
    names = ["total_cogs", "total_discount_cost", "return_cost", "service_cost", "acquisition_cost"]
    return df.agg(*[total(c).alias(c) for c in names])


def profit_identity(df: DataFrame) -> DataFrame:
    """Gross revenue minus all costs; returned revenue stays in, unlike customer_profit."""
    value = total("gross_revenue")
    for name, column in COSTS.items():
        if name != "Freight":
            value = value - total(column)
    return df.agg(value.alias("customer_profit_calc"))


def clv(df: DataFrame) -> DataFrame:
    return df.agg(
        (
            mean("customer_profit") * F.avg("frequency")
            * F.try_divide(F.lit(365.0), F.avg("interpurchase_time_avg"))
        ).alias("avg_clv")
    )


def top_quartile_profit(df: DataFrame) -> DataFrame:
    return df.agg(_where(F.col("profit_quartile") == 4, "customer_profit").alias("q4_profit"))


def churn(df: DataFrame) -> DataFrame:
    at_risk = _where(F.col("churn_prob") >= 0.5, "gross_revenue")
    return df.agg(
        F.count_if(F.col("churn_predicted") == 1).alias("predicted_churners"),
        F.count_if(F.col("churn_prob") >= 0.6).alias("high_risk"),
        at_risk.alias("at_risk_revenue"),
        _divide(at_risk, total("gross_revenue")).alias("revenue_at_risk_share"),
    )


def roi(df: DataFrame) -> DataFrame:
    gain = F.col("expected_net_benefit") > 0
    budget = _where(gain, "intervention_cost")
    back = _where(gain, "expected_retention_value")
    return df.agg(
        F.count_if(gain).alias("positive_roi_customers"),
        budget.alias("budget"),
        back.alias("expected_return"),
        _divide(back - budget, budget).alias("campaign_roi"),
    )


def roi_variants(df: DataFrame) -> DataFrame:
    """Return on cost over everybody, and over customers with a gain (in percent)."""
    gain = F.col("expected_net_benefit") > 0
    return df.agg(
        _divide(total("expected_net_benefit"), total("intervention_cost")).alias("retention_roi"),
        (
            _divide(_where(gain, "expected_net_benefit"), _where(gain, "intervention_cost")) * 100
        ).alias("expected_roi_pct"),
    )


def priority(df: DataFrame, score: float = 75, buffer: float = 1.2) -> DataFrame:
    cost = total("intervention_cost")
    return df.agg(
        F.count_if(F.col("retention_priority_score") >= score).alias("high_priority"),
        cost.alias("intervention_cost"),
        (cost * buffer).alias("campaign_budget"),
        mean("success_prob").alias("avg_success_prob"),
    )


def action_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("recommended_action").agg(rows().alias("customers"))


def geo_category(geo: DataFrame, categories: DataFrame) -> DataFrame:
    """Totals over the geographic export, mean return rate of the category export."""
    rate = categories.agg(F.avg("return_rate")).scalar()
    return geo.agg(
        F.sum("total_revenue").alias("state_revenue"),
        F.sum("customer_count").alias("state_customers"),
    ).withColumn("category_return_rate", rate)


def what_if(df: DataFrame, success_rate: float, budget_multiplier: float, score: float = 75) -> DataFrame:
    """Customers kept if a share of the high-priority ones is reached."""
    return df.agg(
        (F.count_if(F.col("retention_priority_score") >= score) * success_rate * budget_multiplier)
        .alias("projected_retentions")
    )


# -- frames behind visuals -------------------------------------------------------


def churn_by_bin(df: DataFrame, column: str, width: float) -> DataFrame:
    """Average churn probability per bin of a column."""
    start = F.floor(F.col(column) / width) * width
    return df.groupBy(start.cast("double").alias("bin_start")).agg(
        mean("churn_prob").alias("avg_churn_prob"), rows().alias("customers")
    )


def segment_by_tier(df: DataFrame) -> DataFrame:
    return df.groupBy("rfm_segment", "value_tier").agg(
        mean("customer_profit").alias("avg_profit"), rows().alias("customers")
    )


def channel_mix(df: DataFrame) -> DataFrame:
    return share_of_total(
        df.groupBy("acquisition_channel").agg(rows().alias("customers")), "customers", "pct"
    )


def segment_radar(df: DataFrame) -> DataFrame:
    """Segment means scaled to 0..1 across the segments."""
    axes = {
        "recency": "recency_days", "frequency": "frequency", "monetary": "monetary",
        "engagement": "engagement_score", "profit": "customer_profit",
    }
    means = df.groupBy("rfm_segment").agg(*[F.avg(c).alias(a) for a, c in axes.items()])
    span = means.agg(
        F.struct(
            *[F.min(a).alias(f"{a}_low") for a in axes], *[F.max(a).alias(f"{a}_high") for a in axes]
        )
    ).scalar()
    scaled = {a: S.scale_to_unit(a, F.col(f"_span.{a}_low"), F.col(f"_span.{a}_high")) for a in axes}
    return means.withColumn("_span", span).withColumns(scaled).drop("_span")


def monthly_totals(txn: DataFrame) -> DataFrame:
    """Revenue, customers and orders per month; customers are counted from grouped keys."""
    per_customer = txn.groupBy(S.year_month("order_date").alias("year_month"), "customer_id").agg(
        F.sum(S.cents("revenue")).alias("cents"),
        S.line_total("cost_of_goods", 4).alias("cost"),
    )
    return per_customer.groupBy("year_month").agg(
        S.inexact(F.sum(F.col("cents").cast("decimal(20,0)")), 2).alias("revenue"),
        F.count("customer_id").alias("customers"),
        total("cost").alias("cost"),
    ).withColumn("profit", F.col("revenue") - F.col("cost")).drop("cost")


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Relative change to the previous month and to the same place a year earlier.

    The window runs over one row per month.
    """
    by_month = Window.orderBy("year_month")
    out = {}
    for column in ("revenue", "customers", "profit"):
        for name, back in (("mom", 1), ("yoy", 12)):
            before = F.lag(column, back).over(by_month)
            out[f"{column}_{name}"] = F.try_divide(F.col(column) - before, before)
    return monthly.withColumns(out)


def segment_month_trend(summary: DataFrame, master: DataFrame) -> DataFrame:
    """Monthly revenue per segment: the monthly summary joined with the master table."""
    return (
        summary.join(master.select("customer_id", "rfm_segment"), "customer_id")
        .groupBy("rfm_segment", "year_month")
        .agg(total("total_revenue").alias("revenue"))
    )


def calendar_months(dates: DataFrame, summary: DataFrame) -> DataFrame:
    """Revenue per calendar month; months without orders show 0."""
    monthly = summary.groupBy("year_month").agg(
        total("total_revenue").alias("revenue"), F.sum("order_count").alias("orders")
    )
    return dates.select("year_month").distinct().join(monthly, "year_month", "left").fillna(0)
