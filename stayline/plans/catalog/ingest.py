"""Sources, sinks, filters, projections, ingest joins and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.config import GENDERS, CHANNELS, SUCCESS_PROBABILITIES, INTERVENTION_COSTS
from stayline.functions import scalars as S
from stayline.functions import synth
from stayline.operators import exports, ingest, ordering, profiling
from stayline.plans import pipeline
from stayline.plans.catalog.base import Tables, query
from stayline.plans.catalog.sql import (
    AS_OF, RETURN_RATE_CASE, case, cents, even, u,
)
from stayline.sources import fixtures
from stayline.sources.store import RAW_SCHEMAS, REQUIRED, load_raw, save, scratch, split_csv

TXN = (
    "transaction_id:i customer_id:i order_date:d product_category:s product_super_category:s "
    "product_id:s quantity:i unit_price:f revenue:f discount_pct:f is_return:i cost_of_goods:f "
    "freight_value:f"
)
PEOPLE = (
    "customer_id:i age:i gender:s region:s signup_date:d acquisition_channel:s customer_city:s "
    "customer_state:s"
)


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
               F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# -- sources and sinks ---------------------------------------------------------

@query(
    "scan_required", "table_name:s n_rows:i n_columns:i",
    """SELECT 'customers' AS table_name, count(*) AS n_rows, 5 AS n_columns FROM customer
       UNION ALL SELECT 'orders', count(*), 4 FROM orders
       UNION ALL SELECT 'order_items', count(*), 5 FROM lineitem
       UNION ALL SELECT 'payments', count(*), 4 FROM lineitem
       UNION ALL SELECT 'products', count(*), 2 FROM part
       UNION ALL SELECT 'category_translation', count(*), 2 FROM brand_map""",
)
def _(t: Tables):
    """The six required tables, stored and read by the loader; without one of them the
    loader refuses (see the tests)."""
    raw = load_raw(t.spark, stored_raw(t), "parquet")
    return counted({n: raw[n] for n in REQUIRED})


def stored_raw(t: Tables) -> str:
    """A folder with the raw tables."""
    folder = scratch(t.spark, "raw")
    for name in (*REQUIRED, "reviews"):
        save(t.raw[name], f"{folder}/{name}.parquet")
    return folder


@query(
    "scan_optional", "table_name:s n_rows:i n_columns:i",
    """SELECT 'reviews' AS table_name, count(*) AS n_rows, 3 AS n_columns FROM lineitem""",
)
def _(t: Tables):
    """Optional tables are read when present and None otherwise."""
    raw = load_raw(t.spark, stored_raw(t), "parquet")
    found = {n: raw[n] for n in ("reviews", "sellers", "geolocation") if raw[n] is not None}
    return counted(found)


_HARM = "l_orderkey * 7 + l_linenumber"
_HEADER = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"


@query(
    "rejected_lines", "column_name:s n:i",
    f"""WITH x AS (SELECT ({_HARM}) % 50 AS harm FROM lineitem)
        SELECT 'good' AS column_name, count(*) AS n FROM x WHERE harm NOT IN (0, 1, 2, 3)
        UNION ALL SELECT 'price', count(*) FROM x WHERE harm IN (0, 2) UNION ALL SELECT 'freight_value', count(*) FROM x WHERE harm = 2
        UNION ALL SELECT 'order_item_id', count(*) FROM x WHERE harm = 1 UNION ALL SELECT 'line', count(*) FROM x WHERE harm = 3""",
)
def _(t: Tables):
    """Line items written as CSV with damage in some lines, read by the loader: good rows, and the
    rejects of each column (of the line, where fields are missing)."""
    harm = F.expr(f"({_HARM}) % 50")
    price = F.when(harm == 0, "12,5").when(harm == 2, "much").when(harm == 4, "").otherwise(F.col("l_extendedprice").cast("string"))
    fields = [
        F.col("l_orderkey").cast("string"), F.when(harm == 1, "first").otherwise(F.col("l_linenumber").cast("string")),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_shipdate").cast("string"),
        F.concat(F.lit('"'), price, F.lit('"')), F.when(harm == 2, "?").otherwise("1.5"),
    ]
    line = F.when(harm == 3, F.concat_ws(",", *fields[:5])).otherwise(F.concat_ws(",", *fields))
    path = scratch(t.spark, "lines")
    lines = t.table("lineitem").select(line.alias(_HEADER))  # one column, its name the header of every file
    lines.write.options(header=True, quote="", sep="\x01").csv(path)
    good, rejects = split_csv(t.spark, path, RAW_SCHEMAS["order_items"])
    counts = rejects.groupBy(F.coalesce("column", F.lit("line")).alias("column_name")).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(good.agg(F.lit("good").alias("column_name"), F.count(F.lit(1)).alias("n")))


@query(
    "table_inventory", "table_name:s n_rows:i n_columns:i null_columns:i",
    """SELECT 'customers' AS table_name, count(*) AS n_rows, 5 AS n_columns, 0 AS null_columns FROM customer
       UNION ALL SELECT 'orders', count(*), 4, 0 FROM orders
       UNION ALL SELECT 'order_items', count(*), 5, 0 FROM lineitem
       UNION ALL SELECT 'payments', count(*), 4, 0 FROM lineitem
       UNION ALL SELECT 'products', count(*), 2, CASE WHEN count(*) > count(translated) THEN 1 ELSE 0 END FROM prod
       UNION ALL SELECT 'category_translation', count(*), 2, 0 FROM brand_map
       UNION ALL SELECT 'reviews', count(*), 3, 0 FROM lineitem""",
)
def _(t: Tables):
    shown = {n: t.raw[n] for n in ("customers", "orders", "order_items", "payments")}
    shown["products"] = ingest.translated_products(t.raw, t.cfg)
    shown |= {n: t.raw[n] for n in ("category_translation", "reviews")}
    return profiling.table_inventory(shown)


@query(
    "null_profile", "column_name:s nulls:i",
    """SELECT 'product_category' AS column_name, count(*) - count(translated) AS nulls
       FROM lineitem JOIN prod ON l_partkey = product_id HAVING count(*) > count(translated)""",
)
def _(t: Tables):
    products = ingest.translated_products(t.raw, t.cfg)
    return profiling.null_profile(t.raw["order_items"].join(products, "product_id"))


@query(
    "union_profiles", "table_name:s n_rows:i n_columns:i null_columns:i",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, 6 AS n_columns, 0 AS null_columns FROM orders
       UNION ALL SELECT 'lineitem', count(*), 11, 0 FROM lineitem
       UNION ALL SELECT 'events', count(*), 6, 0 FROM events""",
)
def _(t: Tables):
    return profiling.union_profiles(
        [profiling.table_profile(t.table(n), n) for n in ("orders", "lineitem", "events")]
    )


@query(
    "sink_base_tables", "table_name:s n_rows:i n_columns:i",
    """SELECT 'customers' AS table_name, count(*) AS n_rows, 8 AS n_columns FROM people
       UNION ALL SELECT 'transactions', count(*), 13 FROM txn
       UNION ALL SELECT 'engagement', count(*), 7 FROM people""",
)
def _(t: Tables):
    """Write the three base tables and read them back."""
    folder = scratch(t.spark, "base")
    return counted(pipeline.save_base_tables(
        {"customers": t.people, "transactions": t.txn(), "engagement": t.engagement}, folder
    ))


PHASES = [("features", "customer_features", "features"), ("segmentation", "customer_segmented", "segmented"),
          ("profitability", "customer_profitable", "profitable"), ("churn", "customer_churn", "scored")]


@query(
    "sink_phase_tables", "phase:s table_name:s n_rows:i",
    " UNION ALL ".join(f"SELECT '{p}' AS phase, '{n}' AS table_name, count(*) AS n_rows FROM people" for p, n, _ in PHASES)
    + """ UNION ALL SELECT 'priority', 'customer_retention_final', count(*) FROM people
          UNION ALL SELECT 'priority', 'decision_matrix', 3 * count(DISTINCT value_tier) FROM fin
          UNION ALL SELECT 'priority', 'sensitivity', 4
          UNION ALL SELECT 'priority', 'top_targets', least(20, count(*)) FROM fin WHERE customer_profit IS NOT NULL""",
)
def _(t: Tables):
    """Tables that finished phases have stored, as their manifests name them: those of the catalogue
    up to the scores, and what the priority phase of the pipeline makes of them."""
    run = pipeline.Pipeline(t.spark, t.cfg, scratch(t.spark, "phases"))
    for phase, name, attribute in PHASES:
        run.adopt(phase, {name: getattr(t, attribute)})
    run.priority()
    rows = [
        t.spark.read.parquet(path).agg(F.lit(m["phase"]).alias("phase"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for m in run.phases.manifests().values() for name, path in m["tables"].items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "rehydrate_phase", "rfm_segment:s customers:i",
    "SELECT rfm_segment, count(*) AS customers FROM rfm_scored GROUP BY 1",
)
def _(t: Tables):
    """Segmentation started from the stored feature table."""
    run = pipeline.Pipeline(t.spark, t.cfg, scratch(t.spark, "phases"))
    run.adopt("features", {"customer_features": t.features})
    return run.segmentation().groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query(
    "date_dimension",
    "date:d year:i month:i month_name:s quarter:i quarter_name:s day_of_week:i day_name:s year_month:s is_weekend:i",
    f"""SELECT day AS date, year(day) AS year, month(day) AS month, monthname(day) AS month_name,
               quarter(day) AS quarter, 'Q' || quarter(day) AS quarter_name, isodow(day) - 1 AS day_of_week,
               dayname(day) AS day_name, strftime(day, '%Y-%m') AS year_month,
               CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT CAST(unnest(generate_series((SELECT min(order_date) FROM txn), {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS day)""",
)
def _(t: Tables):
    """Calendar from the first order to the analysis date."""
    return exports.date_dimension_of(t.transactions, t.cfg.as_of)


@query(
    "lookup_relations", "acquisition_channel:s cost:f customers:i",
    f"""SELECT acquisition_channel, {case('acquisition_channel', {k: v[1] for k, v in CHANNELS.items()})} AS cost,
               count(*) AS customers FROM people GROUP BY 1, 2""",
)
def _(t: Tables):
    """A lookup dictionary as a relation, joined by broadcast (a handful of rows)."""
    costs = pipeline.lookup_frame(t.spark, {k: float(v[1]) for k, v in t.cfg.channels.items()},
                                  "acquisition_channel", "cost")
    return t.people.join(F.broadcast(costs), "acquisition_channel").groupBy(
        "acquisition_channel", "cost").agg(F.count(F.lit(1)).alias("customers"))


# -- filters and projections -----------------------------------------------------


@query(
    "filter_order_status", "order_id:i customer_id:i order_status:s",
    "SELECT order_id, customer_id, order_status FROM ord_all WHERE order_status IN ('delivered', 'shipped', 'invoiced')",
)
def _(t: Tables):
    return ingest.kept_orders(t.raw["orders"], t.cfg)


@query("filter_valid_lines", TXN, "SELECT * FROM kept")
def _(t: Tables):
    return ingest.valid_lines(t.txn())


@query(
    "filter_returned_lines", "transaction_id:i customer_id:i revenue:f",
    "SELECT transaction_id, customer_id, revenue FROM txn WHERE is_return = 1",
)
def _(t: Tables):
    return ingest.returned_lines(t.txn("transaction_id", "customer_id", "revenue", "is_return"))


@query("project_customers", PEOPLE, "SELECT * FROM people")
def _(t: Tables):
    return t.people


@query("project_transactions", TXN, "SELECT * FROM txn")
def _(t: Tables):
    return t.txn()


@query(
    "derive_revenue_cogs", "order_id:i product_id:i revenue:f cost_of_goods:f",
    "SELECT order_id, product_id, price AS revenue, price * 0.55 AS cost_of_goods FROM items",
)
def _(t: Tables):
    return ingest.revenue_and_cost(t.raw["order_items"], t.cfg)


@query(
    "drop_null_dates", "order_id:i order_date:d",
    """SELECT order_id, order_date FROM (
         SELECT order_id, try_cast(CASE WHEN order_id % 7 = 0 THEN 'unknown' ELSE CAST(order_date AS VARCHAR) END AS DATE) AS order_date
         FROM ord_all) WHERE order_date IS NOT NULL""",
)
def _(t: Tables):
    """Dates as text, some of them unreadable."""
    dated = t.raw["orders"].select(
        "order_id",
        F.when(F.col("order_id") % 7 == 0, "unknown")
        .otherwise(F.col("order_purchase_timestamp").cast("date").cast("string")).alias("order_date"),
    )
    return ingest.drop_null_dates(dated)


@query(
    "range_filter_recent", "transaction_id:i customer_id:i order_date:d",
    f"SELECT transaction_id, customer_id, order_date FROM txn WHERE order_date >= {AS_OF} - INTERVAL 30 DAY",
)
def _(t: Tables):
    return ingest.since(t.txn("transaction_id", "customer_id", "order_date"), t.cfg.as_of, t.cfg.recent_days)


@query(
    "range_filter_previous", "transaction_id:i customer_id:i order_date:d",
    f"""SELECT transaction_id, customer_id, order_date FROM txn
        WHERE order_date >= {AS_OF} - INTERVAL 180 DAY AND order_date < {AS_OF} - INTERVAL 90 DAY""",
)
def _(t: Tables):
    return ingest.between_days(t.txn("transaction_id", "customer_id", "order_date"), t.cfg.as_of, 180, 90)


@query(
    "filter_available_columns", "customer_id:i region:s",
    "SELECT customer_id, region FROM people",
)
def _(t: Tables):
    return ingest.available(t.people, ["customer_id", "loyalty_card", "region", "shoe_size"])


# -- joins -----------------------------------------------------------------------


@query(
    "semi_customers_with_orders", "customer_id:i customer_city:s",
    "SELECT c_custkey AS customer_id, c_name AS customer_city FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
)
def _(t: Tables):
    return ingest.customers_with_orders(t.raw["customers"], t.raw["orders"])


@query(
    "identity_resolution", "order_id:i customer_id:i",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders",
)
def _(t: Tables):
    """Orders that know only a per-order customer id."""
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderkey").alias("customer_id")
    )
    return ingest.resolve_identity(orders, fixtures.order_ids(t.spark, t.sf_dir))


@query(
    "dedupe_customers", "customer_id:i customer_city:s customer_state:s",
    """SELECT o_custkey AS customer_id, customer_city, customer_state FROM (
         SELECT o_custkey, c_name AS customer_city, n_name AS customer_state,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) WHERE rn = 1""",
)
def _(t: Tables):
    return ingest.one_row_per_customer(fixtures.order_ids(t.spark, t.sf_dir))


@query(
    "join_orders_items", "order_id:i customer_id:i product_id:i price:f",
    """SELECT o.order_id, customer_id, product_id, price FROM ord_all o JOIN items i ON o.order_id = i.order_id
       WHERE order_status <> 'canceled'""",
)
def _(t: Tables):
    return ingest.kept_orders(t.orders, t.cfg).join(t.raw["order_items"], "order_id")


@query(
    "translate_category", "order_id:i product_id:i product_category:s",
    """SELECT order_id, i.product_id, product_category FROM items i JOIN prod p ON i.product_id = p.product_id""",
)
def _(t: Tables):
    return ingest.translate_category(t.raw["order_items"], t.raw, t.cfg)


@query(
    "map_super_category", "product_category:s product_super_category:s n:i",
    """SELECT product_category, product_super_category, count(*) AS n FROM items i
       JOIN prod p ON i.product_id = p.product_id GROUP BY 1, 2""",
)
def _(t: Tables):
    items = ingest.map_super_category(ingest.translate_category(t.raw["order_items"], t.raw, t.cfg), t.cfg)
    return items.groupBy("product_category", "product_super_category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_region", "customer_id:i region:s",
    """SELECT c_custkey AS customer_id, CASE WHEN n_nationkey < 22 THEN r_name ELSE 'Other' END AS region
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    return ingest.map_region(t.raw["customers"].drop("region"), t.cfg)


PAY_SUM = """
 SELECT order_id, CAST(sum(paid) AS DOUBLE) AS total_payment, sum(inst) / CAST(sum(n) AS DOUBLE) AS payment_installments,
        min_by(payment_type, (-n, payment_type)) AS payment_type
 FROM (SELECT order_id, payment_type, count(*) AS n, sum(payment_installments) AS inst,
              sum(CAST(payment_value AS DECIMAL(20, 6))) AS paid FROM pay GROUP BY 1, 2) GROUP BY 1"""


@query("payment_summary", "order_id:i total_payment:f payment_installments:f payment_type:s", PAY_SUM)
def _(t: Tables):
    return ingest.payment_summary(t.raw["payments"])


@query(
    "join_payments", "order_id:i product_id:i price:f total_payment:f payment_type:s",
    f"""SELECT i.order_id, product_id, price, total_payment, payment_type FROM items i LEFT JOIN ({PAY_SUM}) s ON i.order_id = s.order_id""",
)
def _(t: Tables):
    return ingest.join_payments(t.raw["order_items"], t.raw["payments"])


@query(
    "signup_date", "customer_id:i signup_date:d",
    """SELECT c_custkey AS customer_id, coalesce(first_day, (SELECT min(order_date) FROM ord_all)) AS signup_date
       FROM customer LEFT JOIN (SELECT customer_id, min(order_date) AS first_day FROM ord_all GROUP BY 1) ON customer_id = c_custkey""",
)
def _(t: Tables):
    return ingest.signup_dates(t.raw["customers"], t.orders)


RECENT = f"""
 SELECT customer_id, count(DISTINCT transaction_id) AS recent_orders, {cents('revenue')} AS recent_revenue,
        sum(quantity) AS recent_items FROM txn WHERE order_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1"""
ACTIVE = f"""
 SELECT customer_id, coalesce(recent_orders, 0) AS recent_orders, coalesce(recent_revenue, 0) AS recent_revenue,
        coalesce(recent_items, 0) AS recent_items FROM people LEFT JOIN ({RECENT}) USING (customer_id)"""
RECENT_COLUMNS = ("transaction_id", "customer_id", "order_date", "revenue", "quantity")


@query("engagement_recent", "customer_id:i recent_orders:i recent_revenue:f recent_items:i", RECENT)
def _(t: Tables):
    return ingest.recent_activity(t.txn(*RECENT_COLUMNS), t.cfg)


@query("join_engagement_all", "customer_id:i recent_orders:i recent_revenue:f recent_items:i", ACTIVE)
def _(t: Tables):
    return ingest.activity_of_all(t.people, t.txn(*RECENT_COLUMNS), t.cfg)


REVIEWS = f"""
 SELECT customer_id, {even('sum(1 + l_linenumber % 5) / CAST(count(*) AS DOUBLE)', 2)} AS avg_review_score, count(*) AS review_count
 FROM lineitem JOIN ord_all ON l_orderkey = order_id GROUP BY 1"""


@query(
    "review_enrichment", "customer_id:i visits:i avg_review_score:f review_count:i",
    f"""SELECT customer_id, website_visits_30d AS visits, coalesce(avg_review_score, 0) AS avg_review_score,
               coalesce(review_count, 0) AS review_count FROM eng LEFT JOIN ({REVIEWS}) USING (customer_id)""",
)
def _(t: Tables):
    return ingest.enrich_with_reviews(t.engagement, t.raw["reviews"], t.orders).withColumnRenamed(
        "website_visits_30d", "visits")


@query(
    "discount_estimate", "order_id:i discount_pct:f", "SELECT order_id, discount_pct FROM disc",
)
def _(t: Tables):
    return ingest.order_discounts(t.raw["order_items"], t.raw["payments"], t.cfg)


@query("distinct_customers", "customer_id:i", "SELECT DISTINCT customer_id FROM txn")
def _(t: Tables):
    return ingest.distinct_customers(t.txn("customer_id"))


@query(
    "dataset_summary",
    "first_date:d last_date:d customers:i products:i categories:i super_categories:i total_revenue:f",
    f"""SELECT min(order_date) AS first_date, max(order_date) AS last_date,
               (SELECT count(*) FROM people) AS customers, count(DISTINCT product_id) AS products,
               count(DISTINCT product_category) AS categories, count(DISTINCT product_super_category) AS super_categories,
               {cents('revenue')} AS total_revenue FROM txn""",
)
def _(t: Tables):
    return ingest.dataset_summary(t.overview, t.customers)


@query("ingest_customers", PEOPLE, "SELECT * FROM people")
def _(t: Tables):
    """Customers of orders that know only a per-order customer id."""
    orders = t.raw["orders"].withColumn("customer_id", F.col("order_id"))
    raw = {**t.raw, "orders": orders, "customers": fixtures.order_ids(t.spark, t.sf_dir)}
    return ingest.customers(raw, t.cfg)


@query("ingest_transactions", TXN, "SELECT * FROM txn")
def _(t: Tables):
    orders = t.raw["orders"].withColumn("customer_id", F.col("order_id"))
    raw = {**t.raw, "orders": orders, "customers": fixtures.order_ids(t.spark, t.sf_dir)}
    return ingest.transactions(raw, t.cfg)


# -- synthetic columns --------------------------------------------------------------


def poisson_sql(draw: str, rate: float) -> str:
    """Number of CDF steps at or below the draw, from an explicit table of steps."""
    return f"""(SELECT count(*) FROM (SELECT k, sum(p) OVER (ORDER BY k) AS cdf FROM
      (SELECT k, exp(-{rate}) * pow({rate}, k) / factorial(CAST(k AS INTEGER)) AS p FROM range(0, 33) r(k))) WHERE cdf <= {draw})"""


def counter_sql(name: str) -> str:
    per_order, mean, most = synth.PROXY_COUNTERS[name]
    return (
        f"CAST(floor(least(recent_orders * {per_order} + {poisson_sql('d_' + name, mean)}, {most})) AS BIGINT) AS {name}"
    )


TICKETS = " + ".join(
    f"CASE WHEN d_tickets >= (SELECT sum(exp(-0.1 * recent_orders) * pow(0.1 * recent_orders, k) / factorial(CAST(k AS INTEGER))) "
    f"FROM range(0, {k + 1}) r(k)) THEN 1 ELSE 0 END"
    for k in range(8)
)
PROXY = f"""
 SELECT customer_id, {', '.join(counter_sql(n) for n in synth.PROXY_COUNTERS)},
        {TICKETS} AS support_tickets,
        CASE WHEN {u('loyalty', 'customer_id')} < least(recent_orders / 10.0, 0.8) THEN 1 ELSE 0 END AS loyalty_program
 FROM (SELECT *, {', '.join(u(n, 'customer_id') + ' AS d_' + n for n in synth.PROXY_COUNTERS)},
              {u('tickets', 'customer_id')} AS d_tickets FROM ({ACTIVE}))"""
PROXY_COLUMNS = (
    "customer_id:i emails_opened_30d:i website_visits_30d:i campaign_clicks_30d:i app_sessions_30d:i "
    "support_tickets:i loyalty_program:i"
)


@query("engagement_proxy", PROXY_COLUMNS, PROXY)
def _(t: Tables):
    return ingest.engagement_proxy(t.people, t.txn(*RECENT_COLUMNS), t.cfg)


@query(
    "ingest_engagement", PROXY_COLUMNS + " avg_review_score:f review_count:i",
    f"""SELECT p.*, coalesce(avg_review_score, 0) AS avg_review_score, coalesce(review_count, 0) AS review_count
        FROM ({PROXY}) p LEFT JOIN ({REVIEWS}) r ON p.customer_id = r.customer_id""",
)
def _(t: Tables):
    return ingest.engagement(t.people, t.txn(*RECENT_COLUMNS), t.raw, t.cfg)


@query("synth_age", "customer_id:i age:i", "SELECT customer_id, age FROM people")
def _(t: Tables):
    return t.people.select("customer_id", synth.age(t.cfg.seed, "customer_id").alias("age"))


@query("synth_gender", "customer_id:i gender:s", "SELECT customer_id, gender FROM people")
def _(t: Tables):
    return t.people.select("customer_id", synth.gender(t.cfg.seed, "customer_id", GENDERS).alias("gender"))


@query(
    "synth_channel", "customer_id:i channel:s",
    f"""SELECT c_custkey AS customer_id, CASE WHEN d < 0.3 THEN 'Organic' WHEN d < 0.55 THEN 'Paid Search'
        WHEN d < 0.75 THEN 'Social' WHEN d < 0.9 THEN 'Referral' ELSE 'Email' END AS channel
        FROM (SELECT c_custkey, {u('channel', 'c_custkey')} AS d FROM customer)""",
)
def _(t: Tables):
    return t.raw["customers"].select(
        "customer_id", synth.channel(t.cfg.seed, "customer_id", CHANNELS).alias("channel"))


@query(
    "synth_is_return", "order_id:i product_id:i is_return:i",
    f"""SELECT order_id, product_id, CASE WHEN {u('return', "order_id || ':' || product_id")} < rate THEN 1 ELSE 0 END AS is_return
        FROM (SELECT i.order_id, i.product_id, {RETURN_RATE_CASE} AS rate FROM items i JOIN prod p ON i.product_id = p.product_id)""",
)
def _(t: Tables):
    lines = ingest.translate_category(t.raw["order_items"].drop("is_return"), t.raw, t.cfg)
    rate = S.first_contained("product_category", t.cfg.return_rates, t.cfg.default_return_rate)
    return lines.withColumn("is_return", synth.is_return(t.cfg.seed, rate, "order_id", "product_id"))


@query(
    "synth_support_tickets", "customer_id:i support_tickets:i",
    f"SELECT customer_id, support_tickets FROM ({PROXY})",
)
def _(t: Tables):
    active = ingest.activity_of_all(t.people, t.txn(*RECENT_COLUMNS), t.cfg)
    return active.select("customer_id", synth.support_tickets(
        t.cfg.seed, "customer_id", F.col("recent_orders")).alias("support_tickets"))


@query(
    "synth_loyalty", "customer_id:i loyalty_program:i",
    f"SELECT customer_id, loyalty_program FROM ({PROXY})",
)
def _(t: Tables):
    active = ingest.activity_of_all(t.people, t.txn(*RECENT_COLUMNS), t.cfg)
    return active.select("customer_id", synth.loyalty(
        t.cfg.seed, "customer_id", F.col("recent_orders")).alias("loyalty_program"))


@query(
    "fixed_size_sample", "customer_id:i",
    f"SELECT c_custkey AS customer_id FROM customer ORDER BY {u('sample', 'c_custkey')}, c_custkey LIMIT 1000",
)
def _(t: Tables):
    """1,000 customers chosen by hash, the same whatever the partitioning."""
    draw = synth.uniform(t.cfg.seed, "sample", "customer_id")
    return ordering.sample_exact(t.raw["customers"].select("customer_id"), "customer_id", 1000, draw)


# -- scalar functions ------------------------------------------------------------------


@query(
    "fn_lower_trim", "p_type:s cleaned:s",
    "SELECT p_type, lower(trim('  ' || p_type || ' ')) AS cleaned FROM part",
)
def _(t: Tables):
    padded = F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))
    return t.table("part").select("p_type", S.normalise_category(padded).alias("cleaned"))


@query(
    "fn_contains_first_match", "product_category:s rate:f n:i",
    f"SELECT product_category, {RETURN_RATE_CASE} AS rate, count(*) AS n FROM prod GROUP BY 1, 2",
)
def _(t: Tables):
    products = ingest.translate_category(t.raw["products"].select("product_id"), t.raw, t.cfg)
    rate = S.first_contained("product_category", t.cfg.return_rates, t.cfg.default_return_rate)
    return products.groupBy("product_category", rate.alias("rate")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_concat_prefix", "product_id:s", "SELECT 'P_' || p_partkey AS product_id FROM part")
def _(t: Tables):
    return t.raw["products"].select(S.prefixed("P_", "product_id").alias("product_id"))


@query(
    "fn_to_timestamp", "order_id:i ts:s",
    """SELECT order_id, strftime(try_cast(CASE WHEN order_id % 5 = 0 THEN 'n/a' ELSE CAST(order_date AS VARCHAR) || ' 10:30:00' END
       AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts FROM ord_all""",
)
def _(t: Tables):
    day = F.col("order_purchase_timestamp").cast("date").cast("string")
    raw = F.when(F.col("order_id") % 5 == 0, "n/a").otherwise(F.concat(day, F.lit(" 10:30:00")))
    return t.raw["orders"].select(
        "order_id", F.date_format(F.try_to_timestamp(raw), "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query(
    "fn_format_date", "order_id:i day:s",
    "SELECT order_id, strftime(order_date, '%Y-%m-%d') AS day FROM ord_all",
)
def _(t: Tables):
    return t.raw["orders"].select(
        "order_id", F.date_format("order_purchase_timestamp", "yyyy-MM-dd").alias("day"))


@query(
    "fn_year_month", "year_month:s n:i",
    "SELECT strftime(order_date, '%Y-%m') AS year_month, count(*) AS n FROM ord_all GROUP BY 1",
)
def _(t: Tables):
    month = S.year_month(F.col("order_purchase_timestamp").cast("date"))
    return t.raw["orders"].groupBy(month.alias("year_month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_calendar_parts", "order_id:i year:i month:i quarter:i day_of_week:i month_name:s day_name:s is_weekend:i",
    """SELECT order_id, year(order_date) AS year, month(order_date) AS month, quarter(order_date) AS quarter,
              isodow(order_date) - 1 AS day_of_week, monthname(order_date) AS month_name, dayname(order_date) AS day_name,
              CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM ord_all""",
)
def _(t: Tables):
    d = F.col("order_purchase_timestamp").cast("date")
    return t.raw["orders"].select(
        "order_id", F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        F.weekday(d).alias("day_of_week"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"), F.weekday(d).isin(5, 6).cast("int").alias("is_weekend"),
    )


@query(
    "fn_datediff", "order_id:i days:i",
    f"SELECT order_id, date_diff('day', order_date, {AS_OF}) AS days FROM ord_all",
)
def _(t: Tables):
    return t.raw["orders"].select(
        "order_id", F.datediff(F.lit(t.cfg.as_of), F.col("order_purchase_timestamp").cast("date")).alias("days"))


@query(
    "fn_date_sub", "order_id:i day:d",
    "SELECT order_id, order_date - INTERVAL 90 DAY AS day FROM ord_all",
)
def _(t: Tables):
    return t.raw["orders"].select(
        "order_id", F.date_sub(F.col("order_purchase_timestamp").cast("date"), 90).alias("day"))


@query(
    "fn_clip", "event_id:i clipped:f",
    "SELECT event_id, least(greatest(value, 2.0), 40.0) AS clipped FROM events",
)
def _(t: Tables):
    return t.table("events").select("event_id", S.clip("value", 2.0, 40.0).alias("clipped"))


@query(
    "fn_safe_ratio", "c_custkey:i ratio:f",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_nationkey / c_acctbal ELSE 0 END AS ratio FROM customer",
)
def _(t: Tables):
    return t.table("customer").select("c_custkey", S.safe_ratio("c_nationkey", "c_acctbal").alias("ratio"))


@query(
    "fn_round", "event_id:i r0:f r1:f r2:f",
    f"SELECT event_id, {even('value', 0)} AS r0, {even('value', 1)} AS r1, {even('value / 3', 2)} AS r2 FROM events",
)
def _(t: Tables):
    v = F.col("value")
    return t.table("events").select(
        "event_id", S.round_even(v, 0).alias("r0"), S.round_even(v, 1).alias("r1"),
        S.round_even(v / 3, 2).alias("r2"))


@query(
    "fn_fillna", "customer_id:i orders:i revenue:f",
    """SELECT c_custkey AS customer_id, coalesce(n, 0) AS orders, coalesce(r, 0) AS revenue FROM customer LEFT JOIN
       (SELECT customer_id, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS r
        FROM ord_all JOIN orders ON order_id = o_orderkey WHERE order_status = 'shipped' GROUP BY 1) ON customer_id = c_custkey""",
)
def _(t: Tables):
    shipped = t.table("orders").filter("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("orders"), S.money(F.sum(S.cents("o_totalprice"))).alias("revenue"))
    return t.raw["customers"].select("customer_id").join(shipped, "customer_id", "left").fillna(
        0, subset=["orders", "revenue"])


@query(
    "fn_replace_inf", "c_custkey:i x:f",
    "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 0 ELSE c_acctbal / c_nationkey END AS x FROM customer",
)
def _(t: Tables):
    """Infinite (x / 0) and missing values become 0."""
    nation = F.col("c_nationkey").cast("double")
    raw = F.when(nation == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal") / nation)
    return t.table("customer").select("c_custkey", S.finite_or_zero(raw).alias("x"))


@query(
    "fn_map_intervention_cost", "value_tier:s cost:f n:i",
    f"SELECT coalesce(value_tier, 'none') AS value_tier, {case('value_tier', INTERVENTION_COSTS, 5)} AS cost, count(*) AS n FROM seg_prof GROUP BY 1, 2, seg_prof.value_tier",
)
def _(t: Tables):
    costs = {k: float(v) for k, v in t.cfg.intervention_costs.items()}
    cost = S.lookup("value_tier", costs, costs["Low Value"])
    return t.profitable.groupBy(
        F.coalesce("value_tier", F.lit("none")).alias("value_tier"), cost.alias("cost")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_map_success_prob", "rfm_segment:s p:f n:i",
    f"SELECT rfm_segment, {case('rfm_segment', SUCCESS_PROBABILITIES, 0.35)} AS p, count(*) AS n FROM rfm_scored GROUP BY 1, 2",
)
def _(t: Tables):
    p = S.lookup("rfm_segment", t.cfg.success_probabilities, t.cfg.default_success_probability)
    return t.segmented.groupBy("rfm_segment", p.alias("p")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_format_money", "c_custkey:i money_text:s pct_text:s",
    """SELECT c_custkey, CASE WHEN x >= 1000000 THEN 'R$ ' || format('{:,.1f}', x / 1000000) || 'M'
                              WHEN x >= 1000 THEN 'R$ ' || format('{:,.1f}', x / 1000) || 'K'
                              ELSE 'R$ ' || format('{:,.0f}', x) END AS money_text,
              format('{:,.1f}', c_nationkey / 25.0 * 100) || '%' AS pct_text
       FROM (SELECT *, (c_custkey % 4000) * 1024.0 + c_custkey % 999 AS x FROM customer)""",
)
def _(t: Tables):
    key = F.col("c_custkey")
    x = (key % 4000) * F.lit(1024.0) + key % 999
    return t.table("customer").select(
        "c_custkey", S.format_money(x).alias("money_text"),
        S.format_percent(F.col("c_nationkey") / F.lit(25.0)).alias("pct_text"))


# -- reports on raw tables -------------------------------------------------------------


@query(
    "monthly_orders", "year_month:s orders:i",
    "SELECT strftime(order_date, '%Y-%m') AS year_month, count(*) AS orders FROM ord_all GROUP BY 1",
)
def _(t: Tables):
    return profiling.monthly_orders(t.raw["orders"])


@query(
    "value_counts", "column_name:s value:s n:i pct:f",
    """SELECT 'order_status' AS column_name, order_status AS value, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM ord_all GROUP BY 2
       UNION ALL SELECT * FROM (SELECT 'customer_state', n_name, count(*), count(*) * 100.0 / (SELECT count(*) FROM customer)
         FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)
       UNION ALL SELECT 'region', r_name, count(*), count(*) * 100.0 / sum(count(*)) OVER () FROM customer
         JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 2
       UNION ALL SELECT 'payment_type', l_returnflag, count(*), count(*) * 100.0 / sum(count(*)) OVER () FROM lineitem GROUP BY 2
       UNION ALL SELECT 'review_score', CAST(1 + l_linenumber % 5 AS VARCHAR), count(*), count(*) * 100.0 / sum(count(*)) OVER () FROM lineitem GROUP BY 2""",
)
def _(t: Tables):
    asked = [("orders", "order_status", None), ("customers", "customer_state", 15), ("customers", "region", None),
             ("payments", "payment_type", None), ("reviews", "review_score", None)]
    parts = [
        profiling.value_counts(t.raw[name], column, top).select(
            F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"), "n", "pct")
        for name, column, top in asked
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "payment_describe", "column_name:s n:i mean:f4 std:f3 low:f q25:f q50:f q75:f high:f",
    """SELECT 'payment_value' AS column_name, count(*) AS n, avg(payment_value) AS mean, stddev_samp(payment_value) AS std,
              min(payment_value) AS low, quantile_cont(payment_value, 0.25) AS q25, quantile_cont(payment_value, 0.5) AS q50,
              quantile_cont(payment_value, 0.75) AS q75, max(payment_value) AS high FROM pay""",
)
def _(t: Tables):
    """Lines of one order tie only with equal keys and values, which are interchangeable."""
    return profiling.describe(t.raw["payments"], ["payment_value"], "order_id")


@query(
    "top_categories_15", "product_category:s revenue:f",
    f"""SELECT translated AS product_category, {cents('price')} AS revenue FROM items i JOIN prod p ON i.product_id = p.product_id
        WHERE translated IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def _(t: Tables):
    return profiling.top_categories(t.raw, t.cfg)


@query(
    "super_category_sorted", "product_super_category:s revenue:f",
    f"""SELECT product_super_category, {cents('price')} AS revenue FROM items i JOIN prod p ON i.product_id = p.product_id GROUP BY 1""",
)
def _(t: Tables):
    return profiling.super_category_revenue(t.raw, t.cfg)
