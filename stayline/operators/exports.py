"""The tables a dashboard reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.operators.ingest import available, of_customers
from stayline.operators.priority import top_by_rank
from stayline.functions.scalars import mean, total

# Columns of the exported tables, in order.
MASTER_COLUMNS = [
    "customer_id", "age", "gender", "region", "acquisition_channel", "customer_tenure_days",
    "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score",
    "avg_order_value", "median_order_value", "categories_purchased", "category_concentration",
    "discount_usage_rate", "avg_discount_pct", "return_rate", "interpurchase_time_avg",
    "spending_trend", "frequency_trend", "aov_trend", "engagement_score", "emails_opened_30d",
    "website_visits_30d", "campaign_clicks_30d", "app_sessions_30d", "support_tickets",
    "loyalty_program", "avg_review_score", "review_count", "rfm_segment", "kmeans_segment",
    "cluster", "gross_revenue", "net_revenue", "customer_profit", "profit_margin",
    "profit_quartile", "value_tier", "churn_prob", "churn_predicted", "churn_actual",
    "intervention_cost", "success_prob", "expected_retention_value", "expected_net_benefit",
    "retention_priority_score", "priority_rank", "recommended_action", "risk_tier",
]

DECISION_COLUMNS = [
    "priority_rank", "customer_id", "rfm_segment", "value_tier", "customer_profit", "churn_prob",
    "success_prob", "expected_retention_value", "intervention_cost", "expected_net_benefit",
    "retention_priority_score", "recommended_action", "recency_days", "frequency", "monetary",
    "engagement_score", "spending_trend", "profit_margin",
]


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Every double column rounded half to even."""
    return df.select(
        *[S.round_even(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def customer_master(df: DataFrame) -> DataFrame:
    return rounded(available(df, MASTER_COLUMNS))


def transactions_summary(txn: DataFrame) -> DataFrame:
    """Per customer and month: orders, revenue, items, mean line revenue, returns.

    Lines are summed per order first, so counting orders needs no distinct.
    """
    per_order = of_customers(txn).groupBy(
        "customer_id", S.year_month("order_date").alias("year_month"), "transaction_id"
    ).agg(
        F.sum(S.cents("revenue")).alias("cents"),
        F.sum("quantity").alias("items"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("is_return").alias("returned"),
    )
    out = per_order.groupBy("customer_id", "year_month").agg(
        F.count(F.lit(1)).alias("order_count"),
        S.money(F.sum("cents")).alias("total_revenue"),
        F.sum("items").alias("total_quantity"),
        S.money(F.sum("cents") / F.sum("lines")).alias("avg_order_value"),
        F.sum("returned").alias("return_count"),
    )
    return rounded(out)


def retention_decisions(df: DataFrame, n: int = 100) -> DataFrame:
    return rounded(available(top_by_rank(df, n), DECISION_COLUMNS))


def segment_summary(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    everyone = df.agg(F.count(F.lit(1))).scalar()
    out = df.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customer_count"),
        (n / everyone * 100).alias("pct_of_total"),
        mean("gross_revenue").alias("avg_revenue"),
        total("gross_revenue").alias("total_revenue"),
        mean("customer_profit").alias("avg_profit"),
        total("customer_profit").alias("total_profit"),
        mean("profit_margin").alias("avg_profit_margin"),
        mean("churn_prob").alias("avg_churn_prob"),
        F.sum("churn_predicted").alias("churn_count"),
        mean("engagement_score").alias("avg_engagement"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        mean("avg_order_value").alias("avg_aov"),
        total("expected_retention_value").alias("total_erv"),
        mean("retention_priority_score").alias("avg_priority"),
    )
    return rounded(out)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar columns of a `date` column."""
    d = F.col("date")
    return days.select(
        "date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        S.year_month(d).alias("year_month"),
        F.weekday(d).isin(5, 6).cast("int").alias("is_weekend"),
    )


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from start to end, both included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    return calendar(days)


def date_dimension_of(txn: DataFrame, as_of) -> DataFrame:
    """Every day from the first order to the analysis date."""
    span = txn.agg(F.min("order_date").alias("first"))
    return calendar(span.select(F.explode(F.sequence("first", F.lit(as_of))).alias("date")))


def geographic_summary(df: DataFrame, by: str = "customer_state", regions: dict | None = None) -> DataFrame:
    """Per state (with its region) or per region."""
    by = by if by in df.columns else "region"
    out = df.groupBy(by).agg(
        F.count("customer_id").alias("customer_count"),
        total("gross_revenue").alias("total_revenue"),
        mean("customer_profit").alias("avg_profit"),
        mean("churn_prob").alias("avg_churn_prob"),
    )
    out = rounded(out)
    if by == "customer_state" and regions is not None:
        out = out.withColumn("region", S.lookup(by, regions))
    return out


def category_performance(txn: DataFrame) -> DataFrame:
    """Per super-category: orders, items, revenue, price, returns, customers.

    Distinct orders and customers are counted from grouped keys, one grouping
    each, so no set of ids is held per category.
    """
    by = "product_super_category" if "product_super_category" in txn.columns else "product_category"
    sums = txn.groupBy(by).agg(
        F.sum("quantity").alias("total_items"),
        S.line_total("revenue", 2).alias("total_revenue"),
        (S.line_total("unit_price", 2) / F.count("unit_price")).alias("avg_price"),
        F.avg("is_return").alias("return_rate"),
    )
    orders = txn.select(by, "transaction_id").distinct().groupBy(by).agg(
        F.count("transaction_id").alias("total_orders")
    )
    people = txn.select(by, "customer_id").distinct().groupBy(by).agg(
        F.count("customer_id").alias("unique_customers")
    )
    out = sums.join(orders, by).join(people, by)
    return rounded(out).orderBy(F.desc("total_revenue"))
