"""Profiles of tables and columns: nulls, counts, distributions, correlations."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.operators.ingest import map_super_category, translate_category
from stayline.operators.ordering import quantiles
from stayline.operators.segmentation import share_of_total


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns and columns that hold a null."""
    has_null = [(F.count_if(F.col(c).isNull()) > 0).cast("int") for c in df.columns]
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        reduce(lambda a, b: a + b, has_null).alias("null_columns"),
    )


def union_profiles(profiles: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, profiles)


def with_rejects(profiles: DataFrame, rejects: DataFrame | None) -> DataFrame:
    """Profiles with `rejected`, how many lines of each table could not be read."""
    if rejects is None:
        return profiles.withColumn("rejected", F.lit(0).cast("long"))
    lines = rejects.groupBy("table_name", "file", "line", "column").count()  # equal lines once a copy
    most = lines.groupBy("table_name", "file", "line").agg(F.max("count").alias("n"))
    counts = most.groupBy("table_name").agg(F.sum("n").alias("rejected"))
    return profiles.join(counts, "table_name", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0).cast("long")))


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    return union_profiles([table_profile(df, name) for name, df in tables.items()])


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "nulls").filter("nulls > 0")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequencies of a column, most frequent first, with their share of all rows."""
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    out = share_of_total(out, "n", "pct").orderBy(F.desc("n"), column)
    return out.limit(top) if top else out


def describe(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """count, mean, spread, min, quartiles, max per column; the quartiles are exact."""
    marks = quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, key)
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("low"),
                *[
                    F.lit(v).cast("double").alias(name)
                    for name, v in zip(("q25", "q50", "q75"), marks[c])
                ],
                F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*")


# Columns of the correlation matrix.
CORRELATED = [
    "recency_days", "frequency", "monetary", "avg_order_value", "categories_purchased",
    "discount_usage_rate", "return_rate", "spending_trend", "frequency_trend",
    "engagement_score", "customer_tenure_days", "support_tickets",
]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of columns (lower triangle), one pass."""
    columns = [c for c in (columns or CORRELATED) if c in df.columns]
    pairs = list(combinations(columns, 2))
    names = [f"p{i}" for i in range(len(pairs))]
    stats = df.agg(*[F.corr(a, b).alias(n) for n, (a, b) in zip(names, pairs)])
    cells = [
        F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.col(n).alias("r"))
        for n, (a, b) in zip(names, pairs)
    ]
    return stats.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def histogram(
    df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None,
    by: str | None = None,
) -> DataFrame:
    """Counts in equal-width bins, the last one closed; values are clamped to
    [low, high] where given. Empty bins count 0."""
    value = F.col(column).cast("double")
    if low is not None or high is not None:
        value = S.clip(value, float("-inf") if low is None else low, float("inf") if high is None else high)
    keys = [by] if by else []
    data = df.select(*keys, value.alias("v")).filter(F.col("v").isNotNull())
    if by:
        data = data.filter(F.col(by).isNotNull())
    span = data.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # One bin grid per group; the edges travel with the grid, so counting needs
    # only the group's own span.
    if by:
        data = data.join(span, by)
    else:
        one = data.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
        data = data.withColumn("_span", one).select("v", "_span.lo", "_span.hi")
    lo, hi = F.col("lo"), F.col("hi")
    lo, hi = F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)
    width = (hi - lo) / bins
    bin_no = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / width)).cast("int")
    counted = data.groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = span.select(
        *keys, lo.alias("lo"), width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    return grid.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histograms(df: DataFrame, specs: list[tuple]) -> DataFrame:
    """Histograms of several columns of one table: (name, bin, left_edge, n).

    specs are (column, bins, name, low, high), as for `histogram`. One aggregate finds all
    spans, a row, and one pass counts all bins, so the table is read twice however many
    columns are asked for.
    """
    def clamped(column, low, high):
        value = F.col(column).cast("double")
        if low is None and high is None:
            return value
        return S.clip(value, float("-inf") if low is None else low, float("inf") if high is None else high)

    values = [clamped(c, low, high) for c, _, _, low, high in specs]
    ends = df.agg(*[F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias(f"s{i}") for i, v in enumerate(values)]).first()
    cells, grid = [], []
    for i, (v, (_, bins, name, _, _)) in enumerate(zip(values, specs)):
        lo, hi = ends[f"s{i}"]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        width = None if lo is None else (hi - lo) / bins
        grid += [(name, b, None if lo is None else lo + b * width) for b in range(bins)]
        if lo is not None:
            place = F.least(F.lit(bins - 1), F.floor((v - lo) / width)).cast("int")
            cells.append(F.struct(F.lit(name).alias("name"), F.when(v.isNotNull(), place).alias("bin")))
    bars = df.sparkSession.createDataFrame(grid, "name string, bin int, left_edge double")
    if not cells:
        return bars.withColumn("n", F.lit(0).cast("long"))
    counted = df.select(F.inline(F.array(*cells))).filter(F.col("bin").isNotNull()).groupBy("name", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    return bars.join(counted, ["name", "bin"], "left").fillna(0, subset=["n"])


def monthly_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(S.year_month(F.col("order_purchase_timestamp").cast("date")).alias("year_month"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("year_month")
    )


def category_revenue(raw: dict, cfg, top: int | None = None) -> DataFrame:
    """Revenue per product category over all items, greatest first."""
    items = translate_category(raw["order_items"], raw, cfg)
    out = items.groupBy("product_category").agg(
        S.line_total("price", 2).alias("revenue")
    ).orderBy(F.desc("revenue"), "product_category")
    return out.limit(top) if top else out


def top_categories(raw: dict, cfg, n: int = 15) -> DataFrame:
    """Translated categories only."""
    named = raw["products"].join(
        raw["category_translation"].withColumnRenamed("product_category_name_english", "product_category"),
        "product_category_name",
    ).select("product_id", "product_category")
    return (
        raw["order_items"].join(named, "product_id")
        .groupBy("product_category")
        .agg(S.line_total("price", 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "product_category").limit(n)
    )


def super_category_revenue(raw: dict, cfg) -> DataFrame:
    """Revenue per super-category, smallest first."""
    items = map_super_category(translate_category(raw["order_items"], raw, cfg), cfg)
    return items.groupBy("product_super_category").agg(
        S.line_total("price", 2).alias("revenue")
    ).orderBy("revenue")
