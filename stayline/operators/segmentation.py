"""Rule-based segments and how two labelings compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.functions.scalars import mean
from stayline.operators.ordering import quantile_buckets


def rfm_score(features: DataFrame) -> DataFrame:
    """Quintile scores by rank (ties split by customer id), their sum and the segment."""
    scored = quantile_buckets(
        features,
        "customer_id",
        {"r": ("recency_days", 5), "f_score": ("frequency", 5), "m_score": ("monetary", 5)},
        alone=3,
    )
    return (
        scored.withColumn("r_score", 6 - F.col("r"))
        .drop("r")
        .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
        .withColumn("rfm_segment", S.rfm_segment("r_score", "f_score", "m_score"))
    )


def equal_width_scores(df: DataFrame, column: str, name: str, bins: int = 5) -> DataFrame:
    """Equal-width bins of a column, for when quantile bins cannot be used."""
    span = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high = (F.col(f"_span.{edge}").cast("double") for edge in ("low", "high"))
    return df.withColumn("_span", span).withColumn(
        name, S.equal_width_bin(column, low, high, bins)
    ).drop("_span")


def share_of_total(grouped: DataFrame, column: str, name: str, scale: float = 100.0) -> DataFrame:
    """Value of each group over the sum of all groups."""
    total = grouped.agg(F.sum(column)).scalar()
    return grouped.withColumn(name, F.try_divide(F.col(column).cast("double"), total) * scale)


def segment_profile(scored: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Size and averages per segment."""
    out = scored.groupBy(by).agg(
        F.count("customer_id").alias("customers"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        mean("monetary").alias("avg_monetary"),
        mean("engagement_score").alias("avg_engagement"),
        mean("avg_order_value").alias("avg_aov"),
    )
    return share_of_total(out, "customers", "pct")


def segment_revenue_share(scored: DataFrame) -> DataFrame:
    out = scored.groupBy("rfm_segment").agg(
        S.money(F.sum(S.cents("monetary"))).alias("revenue")
    )
    return share_of_total(out, "revenue", "revenue_pct").orderBy(F.desc("revenue"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of label pairs with totals, in long form."""
    total = F.lit("Total")
    return df.groupBy(a, b).count().cube(a, b).agg(
        F.grouping(a).alias("ga"), F.grouping(b).alias("gb"), F.sum("count").alias("customers")
    ).select(
        F.when(F.col("ga") == 1, total).otherwise(F.col(a)).alias(a),
        F.when(F.col("gb") == 1, total).otherwise(F.col(b)).alias(b),
        "customers",
    )


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two labelings, 1 for identical ones, from pair counts."""

    def pairs(n):
        n = F.col(n).cast("double") if isinstance(n, str) else n.cast("double")
        return n * (n - 1) / 2

    cells = df.groupBy(a, b).count()
    rows = cells.groupBy(a).agg(F.sum("count").alias("n")).agg(F.sum(pairs("n"))).scalar()
    cols = cells.groupBy(b).agg(F.sum("count").alias("n")).agg(F.sum(pairs("n"))).scalar()
    both = cells.agg(F.sum(pairs("count")).alias("both"), F.sum("count").alias("n"))
    expected = F.col("rows") * F.col("cols") / pairs("n")
    highest = (F.col("rows") + F.col("cols")) / 2
    return both.withColumns({"rows": rows, "cols": cols}).select(
        F.when(highest == expected, 1.0)
        .otherwise((F.col("both") - expected) / (highest - expected))
        .alias("adjusted_rand_index")
    )


def compare(df: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    return crosstab(df, a, b), adjusted_rand_index(df, a, b)
