"""Binds the star-schema test tables to the raw tables of this library."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S

AS_OF = dt.date(2001, 8, 2)
SPLIT = dt.date(2001, 5, 2)
START = dt.date(1995, 1, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Market segment -> acquisition channel.
SEGMENT_CHANNELS = {
    "HOUSEHOLD": "Organic",
    "MACHINERY": "Paid Search",
    "FURNITURE": "Social",
    "BUILDING": "Referral",
    "AUTOMOBILE": "Email",
}

# Brand -> category; three brands have none.
BRAND_CATEGORIES = {
    "Brand#1": "computers_accessories",
    "Brand#2": "telephony",
    "Brand#3": "audio",
    "Brand#4": "fashion_shoes",
    "Brand#5": "fashio_female_clothing",
    "Brand#6": "watches_gifts",
    "Brand#7": "furniture_decor",
    "Brand#8": "garden_tools",
    "Brand#9": "housewares",
    "Brand#10": "health_beauty",
    "Brand#11": "perfumery",
    "Brand#12": "sports_leisure",
    "Brand#13": "baby",
    "Brand#14": "toys",
    "Brand#15": "books_technical",
    "Brand#16": "food_drink",
    "Brand#17": "drinks",
    "Brand#18": "auto",
    "Brand#19": "stationery",
    "Brand#20": "pet_shop",
    "Brand#21": "bed_bath_table",
    "Brand#22": "electronics",
}

# Order status letter -> status.
STATUSES = {"F": "delivered", "O": "shipped", "P": "canceled"}

REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def settings() -> Settings:
    """Dates of the test tables; the last three nations have no region."""
    regions = {f"NATION_{i}": REGION_NAMES[i % 5] for i in range(22)}
    return Settings(start_date=START, as_of=AS_OF, split_date=SPLIT, regions=regions)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
            F.col("r_name").alias("region"),
            S.lookup("c_mktsegment", SEGMENT_CHANNELS).alias("acquisition_channel"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        S.lookup("o_orderstatus", STATUSES).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers keyed by a per-order id, to exercise identity resolution."""
    people = customers(spark, sf_dir).withColumnRenamed("customer_id", "customer_unique_id")
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("customer_id"), F.col("o_custkey").alias("customer_unique_id"))
        .join(people, "customer_unique_id")
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_return"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        paid.alias("payment_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category_name")
    )


def category_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(BRAND_CATEGORIES.items()),
        "product_category_name string, product_category_name_english string",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_linenumber") % 5).alias("review_score"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict:
    return {
        "customers": customers(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "products": products(spark, sf_dir),
        "category_translation": category_translation(spark),
        "reviews": reviews(spark, sf_dir),
    }


def engagement(spark: SparkSession, sf_dir: str, people: DataFrame) -> DataFrame:
    """Engagement counters counted from the event table.

    Events are counted per (user, day) first, so the number of active days needs
    no list of days per user.
    """

    def n(kind: str):
        return F.count_if(F.col("event_type") == kind)

    recent = table(spark, sf_dir, "events").filter(
        F.col("ts") >= F.date_sub(F.lit(EVENTS_AS_OF), 30).cast("timestamp_ntz")
    )
    daily = recent.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        n("purchase").alias("emails"), n("view").alias("visits"), n("click").alias("clicks"),
        n("error").alias("tickets"), n("signup").alias("signups"),
    )
    counted = daily.groupBy(F.col("user_id").alias("customer_id")).agg(
        S.clip(F.sum("emails"), 0, 25).cast("int").alias("emails_opened_30d"),
        S.clip(F.sum("visits"), 0, 60).cast("int").alias("website_visits_30d"),
        S.clip(F.sum("clicks"), 0, 20).cast("int").alias("campaign_clicks_30d"),
        S.clip(F.count(F.lit(1)), 0, 50).cast("int").alias("app_sessions_30d"),
        S.clip(F.sum("tickets"), 0, 8).cast("int").alias("support_tickets"),
        (F.sum("signups") > 0).cast("int").alias("loyalty_program"),
    )
    return people.select("customer_id").join(counted, "customer_id", "left").fillna(0)
