"""Customer features from transactions and engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S
from stayline.operators.ingest import of_customers
from stayline.operators.ordering import group_medians
from stayline.session import freeze

ENGAGEMENT_COLUMNS = [
    "emails_opened_30d", "website_visits_30d", "campaign_clicks_30d", "app_sessions_30d",
    "support_tickets", "loyalty_program",
]


def baskets(txn: DataFrame) -> DataFrame:
    """One row per (customer, order): everything the order-level features need.

    Sums over returned lines are kept apart, so returns are not filtered twice.
    """
    kept = F.col("is_return") == 0
    aggs = [
        F.count(F.lit(1)).alias("lines"),
        F.sum("is_return").alias("returned"),
        F.count_if(kept).alias("kept_lines"),
        F.min(F.when(kept, F.col("order_date"))).alias("order_date"),
        F.max(F.when(kept, F.col("order_date"))).alias("last_date"),
        F.sum(F.when(kept, S.cents("revenue"))).alias("cents"),
    ]
    if "quantity" in txn.columns:
        aggs.append(F.sum(F.when(kept, F.col("quantity"))).alias("quantity"))
    if "discount_pct" in txn.columns:
        aggs.append(F.count_if(kept & (F.col("discount_pct") > 0)).alias("discounted"))
        aggs.append(F.sum(F.when(kept, F.col("discount_pct"))).alias("discount_sum"))
    return of_customers(txn).groupBy("customer_id", "transaction_id").agg(*aggs)


def _kept(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("kept_lines") > 0)


# -- recency, frequency, monetary ------------------------------------------


def _by_customer(orders: DataFrame, columns: dict) -> DataFrame:
    """One grouping of all orders for any set of features; customers whose lines
    were all returned are left out. Orders without kept lines add nulls and zeros."""
    out = orders.groupBy("customer_id").agg(
        _n_orders().alias("_orders"), *[c.alias(name) for name, c in columns.items()]
    )
    return out.filter(F.col("_orders") > 0).drop("_orders")


def _n_orders():
    return F.count_if(F.col("kept_lines") > 0)


def _rfm(as_of) -> dict:
    return {
        "recency_days": F.datediff(F.lit(as_of), F.max("last_date")),
        "frequency": _n_orders(),
        "monetary": S.money(F.sum("cents")),
    }


def rfm_metrics(txn: DataFrame, as_of) -> DataFrame:
    """Days since the last purchase, distinct orders and revenue, without returns."""
    return _by_customer(baskets(txn), _rfm(as_of))


# -- purchase behaviour ------------------------------------------------------


def order_totals(txn: DataFrame) -> DataFrame:
    return _kept(baskets(txn)).select(
        "customer_id", "transaction_id", S.money("cents").alias("order_value"),
        F.col("quantity").alias("order_quantity"), "order_date",
    )


def _spread(c):
    return F.coalesce(F.stddev_samp(c), F.lit(0.0))


def _order_stats() -> dict:
    return {
        "avg_order_value": S.money(F.try_divide(F.sum("cents"), _n_orders())),
        "purchase_std": _spread(S.money("cents")),
        "avg_quantity": F.try_divide(F.sum("quantity"), _n_orders()),
    }


def _medians(orders: DataFrame) -> DataFrame:
    middle = group_medians(_kept(orders), "customer_id", "cents", "transaction_id", "median_cents")
    return middle.select("customer_id", S.money("median_cents").alias("median_order_value"))


def order_value_stats(txn: DataFrame) -> DataFrame:
    """Mean, median and spread of order values, mean order quantity."""
    orders = freeze(baskets(txn))
    return _by_customer(orders, _order_stats()).join(_medians(orders), "customer_id", "left")


def _category_revenue(txn: DataFrame, by: str) -> DataFrame:
    return (
        of_customers(txn).filter(F.col("is_return") == 0)
        .groupBy("customer_id", by)
        .agg(F.sum(S.cents("revenue")).alias("cents"))
    )


def category_diversity(txn: DataFrame) -> DataFrame:
    return _category_revenue(txn, "product_category").groupBy("customer_id").agg(
        F.count("product_category").alias("categories_purchased")
    )


def super_category_diversity(txn: DataFrame) -> DataFrame:
    return _category_revenue(txn, "product_super_category").groupBy("customer_id").agg(
        F.count("product_super_category").alias("super_categories_purchased")
    )


def _concentration():
    """Sum of squared shares = sum of squares over square of the sum."""
    total = F.sum("cents").cast("double")
    return F.try_divide(F.sum(F.pow(F.col("cents").cast("double"), 2)), total * total)


def category_hhi(txn: DataFrame) -> DataFrame:
    """Herfindahl index of revenue over categories; null when revenue is 0."""
    spend = _category_revenue(txn, "product_category").filter(F.col("product_category").isNotNull())
    return spend.groupBy("customer_id").agg(_concentration().alias("category_concentration"))


def _category_features(txn: DataFrame) -> DataFrame:
    """Diversity, concentration and super-categories from one grouping."""
    has_super = "product_super_category" in txn.columns
    keys = ["product_category"] + (["product_super_category"] if has_super else [])
    spend = (
        of_customers(txn).filter(F.col("is_return") == 0)
        .groupBy("customer_id", *keys)
        .agg(F.sum(S.cents("revenue")).alias("cents"))
    )
    aggs = [
        F.count("product_category").alias("categories_purchased"),
        _concentration().alias("category_concentration"),
    ]
    if has_super:
        # one super-category per category, so a set of a few names per customer
        aggs.append(F.count_distinct("product_super_category").alias("super_categories_purchased"))
    return spend.filter(F.col("product_category").isNotNull()).groupBy("customer_id").agg(*aggs)


def _discounts() -> dict:
    lines = F.sum("kept_lines")
    return {
        "discount_usage_rate": F.try_divide(F.sum("discounted"), lines),
        "avg_discount_pct": F.try_divide(F.sum("discount_sum"), lines),
    }


def _returns() -> dict:
    return {"return_rate": F.sum("returned") / F.sum("lines")}


def discount_usage(txn: DataFrame) -> DataFrame:
    """Share of lines with a discount and mean discount."""
    return _by_customer(baskets(txn), _discounts())


def return_rate(txn: DataFrame) -> DataFrame:
    """Returned lines over all lines."""
    return of_customers(txn).groupBy("customer_id").agg(
        (F.sum("is_return") / F.count(F.lit(1))).alias("return_rate")
    )


def _gaps(orders: DataFrame) -> DataFrame:
    """Days between consecutive orders: mean and spread.

    Orders of the same day have gap 0, so rows are first counted per day. A
    customer then has at most one row per calendar day in the window, however
    many orders there are.
    """
    daily = _kept(orders).groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    before = F.lag("order_date").over(Window.partitionBy("customer_id").orderBy("order_date"))
    gap = F.datediff("order_date", "before").cast("double")
    total, squares = F.sum(gap), F.sum(gap * gap)
    n = F.sum("n") - 1
    variance = (squares - total * total / n) / (n - 1)
    return (
        daily.withColumn("before", before)
        .groupBy("customer_id")
        .agg(
            F.when(n >= 1, F.coalesce(total, F.lit(0.0)) / n).otherwise(0.0).alias("interpurchase_time_avg"),
            F.when(n >= 2, F.sqrt(F.greatest(F.coalesce(variance, F.lit(0.0)), F.lit(0.0))))
            .otherwise(0.0)
            .alias("interpurchase_time_std"),
        )
    )


def interpurchase_time(txn: DataFrame) -> DataFrame:
    return _gaps(baskets(txn))


def _behaviour_parts(orders: DataFrame, txn: DataFrame) -> list[DataFrame]:
    """Behaviour features that need another grain than the order."""
    return [_medians(orders), _category_features(txn), _gaps(orders)]


def purchase_behavior(txn: DataFrame) -> DataFrame:
    """All behaviour features of customers with at least one kept line.

    txn should be a stored table: orders and categories are read from it apart.
    """
    orders = freeze(baskets(txn))
    out = _by_customer(orders, {**_order_stats(), **_discounts(), **_returns()})
    for part in _behaviour_parts(orders, txn):
        out = out.join(part, "customer_id", "left")
    return out


# -- trends -------------------------------------------------------------------


def _windows(as_of, days: int) -> dict:
    edge, start = F.date_sub(F.lit(as_of), days), F.date_sub(F.lit(as_of), 2 * days)
    d = F.col("order_date")
    out = {}
    for name, inside in {"recent": d >= edge, "prev": (d >= start) & (d < edge)}.items():
        cents = F.coalesce(F.sum(F.when(inside, F.col("cents"))), F.lit(0))
        lines = F.sum(F.when(inside, F.col("kept_lines")))
        out[f"{name}_spend"] = S.money(cents)
        out[f"{name}_orders"] = F.count_if(inside)
        out[f"{name}_aov"] = F.coalesce(S.money(F.try_divide(cents.cast("double"), lines)), F.lit(0.0))
    return out


def trend_windows(txn: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Spend, orders and mean line revenue of the last and the previous window."""
    return _by_customer(baskets(txn), _windows(as_of, days))


TRENDS = {"spending_trend": "spend", "frequency_trend": "orders", "aov_trend": "aov"}


def _trends(windows: DataFrame) -> DataFrame:
    """Trend columns in place of the window columns."""
    made = windows.withColumns({t: S.trend(f"recent_{c}", f"prev_{c}") for t, c in TRENDS.items()})
    return made.drop(*[f"{w}_{c}" for w in ("recent", "prev") for c in TRENDS.values()])


def trend_features(txn: DataFrame, as_of, days: int = 90) -> DataFrame:
    return _trends(trend_windows(txn, as_of, days))


# -- engagement ---------------------------------------------------------------


def _scored(engagement: DataFrame, cfg: Settings) -> DataFrame:
    names = [c for c in cfg.engagement_weights if c in engagement.columns]
    tops = engagement.agg(F.struct(*[F.max(c).alias(c) for c in names])).scalar()
    score = F.lit(0.0)
    for name in names:
        top = F.col(f"_tops.{name}").cast("double")
        share = F.when(top > 0, F.col(name) / top).otherwise(0.0)
        score = score + share * cfg.engagement_weights[name] * 100
    scored = engagement.withColumn("_tops", tops).withColumn("engagement_score", S.round_even(score, 2))
    return scored.drop("_tops")


def engagement_score(engagement: DataFrame, cfg: Settings) -> DataFrame:
    """Weighted sum of counters, each relative to its greatest value, times 100."""
    return _scored(engagement, cfg).select("customer_id", "engagement_score")


# -- one row per customer -------------------------------------------------------


def customer_features(
    people: DataFrame, txn: DataFrame, engagement: DataFrame, cfg: Settings, as_of=None
) -> DataFrame:
    """The feature table. `as_of` below the split date gives leak-free features.

    The inputs should be stored tables; only the order grain is stored here.
    """
    as_of = as_of or cfg.as_of
    orders = freeze(baskets(txn))
    out = people.withColumn(
        "customer_tenure_days", F.datediff(F.lit(as_of), "signup_date")
    )
    raw = [c for c in ENGAGEMENT_COLUMNS + ["avg_review_score", "review_count"] if c in engagement.columns]
    columns = {
        **_rfm(as_of), **_order_stats(), **_discounts(), **_returns(), **_windows(as_of, cfg.trend_days)
    }
    parts = [
        _trends(_by_customer(orders, columns)),
        *_behaviour_parts(orders, txn),
        _scored(engagement, cfg).select("customer_id", "engagement_score", *raw),
    ]
    for part in parts:
        out = out.join(part, "customer_id", "left")
    if cfg.null_recency == "worst":
        worst = orders.filter(F.col("kept_lines") > 0).agg(
            F.datediff(F.lit(as_of), F.min("order_date"))
        ).scalar()
        out = out.withColumn("recency_days", F.coalesce("recency_days", worst))
    numeric = [
        c for c, t in out.dtypes
        if c != "customer_id" and t in ("int", "bigint", "double", "float", "smallint", "tinyint")
    ]
    return out.fillna(0, subset=numeric)
