"""Raw tables to customers, transactions and engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S
from stayline.functions import synth

# Columns of the transaction table.
TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "order_date", "product_category",
    "product_super_category", "product_id", "quantity", "unit_price", "revenue",
    "discount_pct", "is_return", "cost_of_goods", "freight_value",
]


def _day(df: DataFrame, name: str):
    kind = dict(df.dtypes)[name]
    return S.to_day(name) if kind == "string" else F.col(name).cast("date")


# -- filters and projections ----------------------------------------------


def kept_orders(orders: DataFrame, cfg: Settings) -> DataFrame:
    """Orders that were delivered, shipped or invoiced."""
    return orders.filter(F.col("order_status").isin(*cfg.order_statuses))


def valid_lines(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("is_return") == 0)


def returned_lines(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("is_return") == 1)


def drop_null_dates(txn: DataFrame) -> DataFrame:
    """Lines whose date parses."""
    return txn.withColumn("order_date", _day(txn, "order_date")).dropna(subset=["order_date"])


def since(txn: DataFrame, as_of, days: int) -> DataFrame:
    """Lines of the last `days` days; later lines stay in."""
    return txn.filter(F.col("order_date") >= F.date_sub(F.lit(as_of), days))


def between_days(txn: DataFrame, as_of, far: int, near: int) -> DataFrame:
    """Lines in [as_of - far, as_of - near)."""
    return txn.filter(
        (F.col("order_date") >= F.date_sub(F.lit(as_of), far))
        & (F.col("order_date") < F.date_sub(F.lit(as_of), near))
    )


def available(df: DataFrame, columns: list[str]) -> DataFrame:
    """The requested columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])


def revenue_and_cost(lines: DataFrame, cfg: Settings) -> DataFrame:
    return lines.withColumns(
        {"revenue": F.col("price"), "cost_of_goods": F.col("price") * cfg.cogs_share}
    )


# -- identity and customers -----------------------------------------------


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct first: a customer with very many orders is one row before the shuffle."""
    return customers.join(orders.select("customer_id").distinct(), "customer_id", "left_semi")


def of_customers(txn: DataFrame) -> DataFrame:
    """Lines that belong to a customer. Orders whose customer is unknown count in
    category and month totals, but they are no customer."""
    return txn.filter(F.col("customer_id").isNotNull())


def resolve_identity(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Replace the per-order customer id by the unique one, if the two differ."""
    if "customer_unique_id" not in customers.columns:
        return orders
    ids = customers.select("customer_id", "customer_unique_id")
    return (
        orders.join(ids, "customer_id", "left")
        .withColumn("customer_id", F.col("customer_unique_id"))
        .drop("customer_unique_id")
    )


def one_row_per_customer(customers: DataFrame) -> DataFrame:
    """The row with the smallest per-order id for each unique id.

    An aggregate, not a window: partial results are combined before the shuffle.
    """
    if "customer_unique_id" not in customers.columns:
        return customers
    rest = [c for c in customers.columns if c != "customer_unique_id"]
    return (
        customers.groupBy("customer_unique_id")
        .agg(F.min_by(F.struct(*rest), "customer_id").alias("row"))
        .select(F.col("customer_unique_id").alias("customer_id"),
                *[F.col(f"row.{c}").alias(c) for c in rest if c != "customer_id"])
    )


def map_region(customers: DataFrame, cfg: Settings) -> DataFrame:
    return customers.withColumn(
        "region", S.lookup("customer_state", cfg.regions, cfg.default_region)
    )


def signup_dates(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """First order date per customer, the overall first date without orders.

    Both inputs use the same customer id.
    """
    dated = orders.select("customer_id", _day(orders, "order_purchase_timestamp").alias("day"))
    first = dated.groupBy("customer_id").agg(F.min("day").alias("signup_date"))
    overall = dated.agg(F.min("day")).scalar()
    return customers.join(first, "customer_id", "left").withColumn(
        "signup_date", F.coalesce("signup_date", overall)
    )


def customers(raw: dict, cfg: Settings) -> DataFrame:
    """The customer table: one row per real customer with at least one order."""
    people = one_row_per_customer(customers_with_orders(raw["customers"], raw["orders"]))
    if "region" not in people.columns:
        people = map_region(people, cfg)
    if "acquisition_channel" not in people.columns:
        people = people.withColumn(
            "acquisition_channel", synth.channel(cfg.seed, "customer_id", cfg.channels)
        )
    people = people.withColumns(
        {
            "age": synth.age(cfg.seed, "customer_id"),
            "gender": synth.gender(cfg.seed, "customer_id", cfg.genders),
        }
    )
    people = signup_dates(people, resolve_identity(raw["orders"], raw["customers"]))
    return people.select(
        "customer_id", "age", "gender", "region", "signup_date", "acquisition_channel",
        "customer_city", "customer_state",
    )


# -- transactions ----------------------------------------------------------


def translated_products(raw: dict, cfg: Settings) -> DataFrame:
    """Product with its English category; products without one keep null."""
    names = raw["category_translation"].select(
        "product_category_name",
        F.col("product_category_name_english").alias("product_category"),
    )
    # The translation holds one row per category name; the size check of the
    # planner decides on broadcasting it.
    return (
        raw["products"].select("product_id", "product_category_name")
        .join(names, "product_category_name", "left")
        .select("product_id", "product_category")
    )


def translate_category(items: DataFrame, raw: dict, cfg: Settings) -> DataFrame:
    return items.join(translated_products(raw, cfg), "product_id", "left").withColumn(
        "product_category", F.coalesce("product_category", F.lit(cfg.default_category))
    )


def map_super_category(items: DataFrame, cfg: Settings) -> DataFrame:
    name = S.normalise_category("product_category")
    return items.withColumn(
        "product_super_category",
        S.lookup(name, cfg.super_categories, cfg.default_super_category),
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Per order: total paid, mean instalments, most frequent type (ties: smallest).

    Counts per (order, type) come first, so the mode is a maximum over a few rows.
    """
    by_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum(S.exact("payment_value", 6)).alias("paid"),
        F.sum("payment_installments").alias("instalments"),
        F.count("payment_installments").alias("n_instalments"),
        F.count(F.lit(1)).alias("n"),
    )
    smallest = F.when(F.col("payment_type").isNotNull(), F.struct(-F.col("n"), "payment_type"))
    return by_type.groupBy("order_id").agg(
        S.inexact(F.sum("paid"), 6).alias("total_payment"),
        F.try_divide(F.sum("instalments"), F.sum("n_instalments")).alias("payment_installments"),
        F.coalesce(F.min(smallest)["payment_type"], F.lit("unknown")).alias("payment_type"),
    )


def join_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Order-level payments next to order lines."""
    return orders.join(payment_summary(payments), "order_id", "left")


def order_discounts(items: DataFrame, payments: DataFrame, cfg: Settings) -> DataFrame:
    """Per order: how far payments stay below the item prices, in percent."""
    priced = items.groupBy("order_id").agg(F.sum(S.exact("price", 6)).alias("price_units"))
    paid = payments.groupBy("order_id").agg(F.sum(S.exact("payment_value", 6)).alias("paid_units"))
    price, payment = F.col("price_units"), F.col("paid_units")
    share = (price - payment).cast("double") / price.cast("double") * 100
    return (
        priced.join(paid, "order_id", "left")
        .withColumn(
            "discount_pct",
            F.when(price > payment, S.clip(share, 0.0, cfg.max_discount_pct)).otherwise(0.0),
        )
        .select("order_id", "discount_pct")
    )


def transactions(raw: dict, cfg: Settings, columns: list[str] | None = None) -> DataFrame:
    """The line-grain transaction table; only joins what `columns` need.

    Order attributes (customer, date, discount) are put together first at order
    grain, where keys are unique. The joins of lines with orders and products can
    meet a hot order or product: they feed no aggregate on the same key, so the
    runtime skew join can split them.
    """
    wanted = columns or TRANSACTION_COLUMNS
    items = raw["order_items"]
    orders = resolve_identity(kept_orders(raw["orders"], cfg), raw["customers"]).select(
        "order_id", "customer_id",
        _day(raw["orders"], "order_purchase_timestamp").alias("order_date"),
    ).filter(F.col("order_date").isNotNull())
    if "discount_pct" in wanted:
        discounts = order_discounts(items, raw["payments"], cfg)
        orders = orders.join(discounts, "order_id", "left").withColumn(
            "discount_pct", F.coalesce("discount_pct", F.lit(0.0))
        )
    lines = items.join(orders, "order_id")
    synthetic_returns = "is_return" in wanted and "is_return" not in items.columns
    if {"product_category", "product_super_category"} & set(wanted) or synthetic_returns:
        lines = map_super_category(translate_category(lines, raw, cfg), cfg)
    if synthetic_returns:
        rate = S.first_contained("product_category", cfg.return_rates, cfg.default_return_rate)
        key = [c for c in ("order_id", "order_item_id", "product_id") if c in items.columns]
        lines = lines.withColumn("is_return", synth.is_return(cfg.seed, rate, *key))
    # after the joins, so that no shuffle carries what follows from the price
    lines = revenue_and_cost(lines, cfg)
    made = {
        "transaction_id": F.col("order_id"),
        "product_id": S.prefixed("P_", "product_id"),
        "quantity": F.lit(1),
        "unit_price": F.col("price"),
    }
    return lines.select(*[made.get(c, F.col(c)).alias(c) for c in wanted])


# -- engagement and reviews -------------------------------------------------


def recent_activity(txn: DataFrame, cfg: Settings) -> DataFrame:
    """Orders, revenue and items per customer in the last days; returns included."""
    per_order = (
        of_customers(since(txn, cfg.as_of, cfg.recent_days))
        .groupBy("customer_id", "transaction_id")
        .agg(F.sum(S.cents("revenue")).alias("cents"), F.sum("quantity").alias("items"))
    )
    return per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("recent_orders"),
        S.money(F.sum("cents")).alias("recent_revenue"),
        F.sum("items").alias("recent_items"),
    )


def activity_of_all(people: DataFrame, txn: DataFrame, cfg: Settings) -> DataFrame:
    return people.select("customer_id").join(recent_activity(txn, cfg), "customer_id", "left").fillna(0)


def engagement_proxy(people: DataFrame, txn: DataFrame, cfg: Settings) -> DataFrame:
    """Synthetic engagement counters that grow with recent orders."""
    active = activity_of_all(people, txn, cfg)
    orders = F.col("recent_orders")
    counters = {
        name: synth.proxy_counter(cfg.seed, name, "customer_id", orders)
        for name in synth.PROXY_COUNTERS
    }
    return active.select(
        "customer_id",
        *[c.alias(name) for name, c in counters.items()],
        synth.support_tickets(cfg.seed, "customer_id", orders).alias("support_tickets"),
        synth.loyalty(cfg.seed, "customer_id", orders).alias("loyalty_program"),
    )


def review_scores(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean score (2 digits) and number of reviews per customer.

    Reviews are summed per order before the join, so its keys are unique.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored"),
        F.count("review_id").alias("n"),
    )
    return (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(
            S.round_even(F.try_divide(F.sum("score"), F.sum("scored")), 2).alias("avg_review_score"),
            F.sum("n").alias("review_count"),
        )
    )


def enrich_with_reviews(engagement: DataFrame, reviews: DataFrame | None, orders: DataFrame) -> DataFrame:
    """Adds the review pair; orders must carry the resolved customer id."""
    if reviews is None:
        return engagement
    return engagement.join(review_scores(reviews, orders), "customer_id", "left").fillna(
        0, subset=["avg_review_score", "review_count"]
    )


def engagement(people: DataFrame, txn: DataFrame, raw: dict, cfg: Settings) -> DataFrame:
    out = engagement_proxy(people, txn, cfg)
    if raw.get("reviews") is None:
        return out
    return enrich_with_reviews(
        out, raw["reviews"], resolve_identity(raw["orders"], raw["customers"])
    )


# -- summaries ---------------------------------------------------------------


def distinct_customers(txn: DataFrame) -> DataFrame:
    return of_customers(txn).select("customer_id").distinct()


def dataset_summary(txn: DataFrame, people: DataFrame) -> DataFrame:
    """Date range, distinct counts and revenue in one row."""

    def n_distinct(df: DataFrame, column: str):
        # grouped first: each distinct value is counted once, in parallel
        return df.groupBy(column).count().filter(F.col(column).isNotNull()).agg(
            F.count(F.lit(1))
        ).scalar()

    totals = txn.agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        S.line_total("revenue", 2).alias("total_revenue"),
    )
    return totals.select(
        "first_date",
        "last_date",
        n_distinct(people, "customer_id").alias("customers"),
        n_distinct(txn, "product_id").alias("products"),
        n_distinct(txn, "product_category").alias("categories"),
        n_distinct(txn, "product_super_category").alias("super_categories"),
        "total_revenue",
    )
