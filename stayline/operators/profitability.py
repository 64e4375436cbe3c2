"""Profit statement per customer and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S
from stayline.functions.scalars import mean, total
from stayline.operators.ingest import of_customers
from stayline.operators.ordering import InOrder, quantile_buckets, quantiles
from stayline.operators.segmentation import share_of_total
from stayline.session import freeze

# Columns of the profit statement.
PROFIT_COLUMNS = [
    "customer_id", "gross_revenue", "net_revenue", "total_cogs", "total_discount_cost",
    "return_cost", "service_cost", "acquisition_cost", "customer_profit", "profit_margin",
    "profit_quartile", "value_tier", "total_freight",
]


def profit_components(txn: DataFrame) -> DataFrame:
    """Revenue, cost, returns and discounts per customer in one pass; returns included."""
    returned = F.col("is_return") == 1
    freight = F.col("freight_value") if "freight_value" in txn.columns else F.lit(0.0)
    discount = F.col("revenue") * F.col("discount_pct") / 100
    return of_customers(txn).groupBy("customer_id").agg(
        S.money(F.sum(S.cents("revenue"))).alias("gross_revenue"),
        S.line_total("cost_of_goods", 4).alias("total_cogs"),
        F.sum("is_return").alias("total_returns"),
        S.line_total(freight, 4).alias("total_freight"),
        S.money(F.coalesce(F.sum(F.when(returned, S.cents("revenue"))), F.lit(0))).alias(
            "returned_revenue"
        ),
        F.coalesce(S.line_total(discount, 6), F.lit(0.0)).alias("total_discount_cost"),
    ).withColumn(
        "net_revenue", S.money(S.cents("gross_revenue") - S.cents("returned_revenue"))
    )


def acquisition_costs(people: DataFrame, cfg: Settings) -> DataFrame:
    costs = {name: float(cost) for name, (_, cost) in cfg.channels.items()}
    return people.select(
        "customer_id", "acquisition_channel",
        S.lookup("acquisition_channel", costs, 0.0).alias("acquisition_cost"),
    )


def side_costs(parts: DataFrame, engagement: DataFrame, people: DataFrame, cfg: Settings) -> DataFrame:
    """Adds return, service and acquisition cost."""
    tickets = engagement.select("customer_id", "support_tickets")
    channels = acquisition_costs(people, cfg).select("customer_id", "acquisition_cost")
    return (
        parts.join(tickets, "customer_id", "left")
        .join(channels, "customer_id", "left")
        .fillna(0, subset=["support_tickets", "acquisition_cost"])
        .withColumns(
            {
                "return_cost": F.col("total_returns") * cfg.return_cost,
                "service_cost": F.col("support_tickets") * cfg.ticket_cost,
            }
        )
    )


def profit_statement(parts: DataFrame) -> DataFrame:
    costs = ["total_cogs", "total_discount_cost", "return_cost", "service_cost", "acquisition_cost"]
    profit = F.col("net_revenue")
    for cost in costs:
        profit = profit - F.col(cost)
    return parts.withColumn("customer_profit", profit).withColumn(
        "profit_margin", S.safe_ratio("customer_profit", "net_revenue")
    )


def profit_quartile(statement: DataFrame) -> DataFrame:
    return quantile_buckets(
        statement, "customer_id", {"profit_quartile": ("customer_profit", 4)}, alone=1
    )


def value_tier(statement: DataFrame) -> DataFrame:
    """Tiers cut at the exact 33 % and 66 % quantiles of profit."""
    low, high = quantiles(statement, {"customer_profit": [0.33, 0.66]}, "customer_id")["customer_profit"]
    profit = F.col("customer_profit")
    return statement.withColumn(
        "value_tier",
        F.when(profit >= F.lit(high), "High Value")
        .when(profit >= F.lit(low), "Medium Value")
        .otherwise("Low Value"),
    )


def customer_profitability(
    txn: DataFrame, people: DataFrame, engagement: DataFrame, cfg: Settings
) -> DataFrame:
    """The whole statement; stored once, since quartile and tier need several looks."""
    parts = side_costs(profit_components(txn), engagement, people, cfg)
    return value_tier(profit_quartile(freeze(profit_statement(parts))))


def add_profitability(
    segmented: DataFrame, txn: DataFrame, people: DataFrame, engagement: DataFrame, cfg: Settings
) -> DataFrame:
    """Profit columns next to the segmented customers; null without transactions."""
    profit = customer_profitability(txn, people, engagement, cfg)
    columns = [c for c in PROFIT_COLUMNS if c in profit.columns]
    return segmented.join(profit.select(*columns), "customer_id", "left")


# -- reports -------------------------------------------------------------------


def profit_summary(df: DataFrame) -> DataFrame:
    loss = F.col("customer_profit") < 0
    return df.agg(
        total("gross_revenue").alias("total_revenue"),
        total("customer_profit").alias("total_profit"),
        mean("profit_margin").alias("avg_margin"),
        F.count_if(loss).alias("unprofitable"),
        F.avg(F.coalesce(loss, F.lit(False)).cast("double")).alias("unprofitable_share"),
    )


def unprofitable(df: DataFrame) -> DataFrame:
    return profit_summary(df).select("unprofitable", "unprofitable_share")


def high_revenue_low_margin(df: DataFrame) -> DataFrame:
    """Gross revenue above its 75 % quantile and margin below its 25 % quantile."""
    cuts = quantiles(df, {"gross_revenue": [0.75], "profit_margin": [0.25]}, "customer_id")
    revenue, margin = cuts["gross_revenue"][0], cuts["profit_margin"][0]
    return df.filter((F.col("gross_revenue") > F.lit(revenue)) & (F.col("profit_margin") < F.lit(margin)))


def segment_profit(df: DataFrame) -> DataFrame:
    return df.groupBy("rfm_segment").agg(
        mean("customer_profit").alias("avg_profit"),
        mean("profit_margin").alias("avg_margin"),
        F.count("customer_id").alias("customers"),
    )


def value_tier_summary(df: DataFrame) -> DataFrame:
    out = df.filter(F.col("value_tier").isNotNull()).groupBy("value_tier").agg(
        F.count("customer_id").alias("customers"),
        total("customer_profit").alias("total_profit"),
        mean("customer_profit").alias("avg_profit"),
        mean("profit_margin").alias("avg_margin"),
    )
    return share_of_total(out, "customers", "pct")


COSTS = {
    "COGS": "total_cogs",
    "Discounts": "total_discount_cost",
    "Returns": "return_cost",
    "Service": "service_cost",
    "Acquisition": "acquisition_cost",
    "Freight": "total_freight",
}


def cost_breakdown(df: DataFrame) -> DataFrame:
    """Sum of each cost, one row per cost."""
    names = {k: c for k, c in COSTS.items() if c in df.columns}
    sums = df.agg(*[total(c).alias(k) for k, c in names.items()])
    return sums.unpivot([], list(names), "cost", "amount")


def pareto(df: DataFrame) -> DataFrame:
    """Customers by falling profit with cumulative shares of profit and customers."""
    known = df.filter(F.col("customer_profit").isNotNull()).select(
        "customer_id", "customer_profit", S.exact("customer_profit", 6).alias("units"),
        F.lit(1).alias("one"),
    )
    ordered = InOrder(known, F.desc("customer_profit"), F.asc("customer_id"))
    everything = ordered.rows.agg(F.sum("units").cast("double")).scalar()
    running = ordered.running({"profit": "units", "position": "one"})
    return running.select(
        "customer_id",
        "customer_profit",
        S.inexact("profit", 6).alias("cumulative_profit"),
        (F.col("profit").cast("double") / everything * 100).alias("cumulative_pct"),
        (F.col("position") / F.lit(float(max(ordered.count, 1))) * 100).alias("customer_pct"),
    )


def top_share(curve: DataFrame, share_pct: float = 20.0) -> DataFrame:
    """Share of all profit that the first share_pct of the customers make."""
    inside = F.col("customer_pct") <= share_pct
    units = S.exact("customer_profit", 6)
    return curve.agg(
        (
            F.sum(F.when(inside, units)).cast("double") / F.sum(units).cast("double") * 100
        ).alias("top_share_pct")
    )
