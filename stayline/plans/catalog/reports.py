"""Dashboard tables and measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import exports, measures
from stayline.plans import pipeline
from stayline.plans.catalog.base import Tables, query
from stayline.plans.catalog.sql import case, even, units
from stayline.sources.store import scratch

_MASTER = [
    ("customer_id", "i"), ("age", "i"), ("gender", "s"), ("region", "s"), ("acquisition_channel", "s"),
    ("customer_tenure_days", "i"), ("recency_days", "i"), ("frequency", "i"), ("monetary", "f"), ("r_score", "i"),
    ("f_score", "i"), ("m_score", "i"), ("rfm_score", "i"), ("avg_order_value", "f2"), ("median_order_value", "f2"),
    ("categories_purchased", "i"), ("category_concentration", "f2"), ("discount_usage_rate", "f2"),
    ("avg_discount_pct", "f2"), ("return_rate", "f2"), ("interpurchase_time_avg", "f2"), ("spending_trend", "f2"),
    ("frequency_trend", "f2"), ("aov_trend", "f2"), ("engagement_score", "f"),
    ("emails_opened_30d", "i"), ("website_visits_30d", "i"), ("campaign_clicks_30d", "i"), ("app_sessions_30d", "i"),
    ("support_tickets", "i"), ("loyalty_program", "i"), ("rfm_segment", "s"), ("gross_revenue", "f"),
    ("net_revenue", "f"), ("customer_profit", "f"), ("profit_margin", "f"), ("profit_quartile", "i"), ("value_tier", "s"),
    ("churn_prob", "f"), ("churn_predicted", "i"), ("churn_actual", "i"), ("intervention_cost", "f"), ("success_prob", "f"),
    ("expected_retention_value", "f"), ("expected_net_benefit", "f"), ("retention_priority_score", "f"),
    ("priority_rank", "i"), ("recommended_action", "s"), ("risk_tier", "s"),
]
_SPEC = " ".join(f"{n}:{k}" for n, k in _MASTER)


def _rounded(columns) -> str:
    return ", ".join(f"{even(n, 2)} AS {n}" if k[0] == "f" else n for n, k in columns)


@query("export_customer_master", _SPEC, f"SELECT {_rounded(_MASTER)} FROM fin")
def _(t: Tables):
    return exports.customer_master(t.final)


SUMMARY = "customer_id:i year_month:s order_count:i total_revenue:f total_quantity:i avg_order_value:f return_count:i"


@query("export_transactions_summary", SUMMARY, "SELECT * FROM tsum")
def _(t: Tables):
    return t.summary


_DECISIONS = [
    ("priority_rank", "i"), ("customer_id", "i"), ("rfm_segment", "s"), ("value_tier", "s"), ("customer_profit", "f"),
    ("churn_prob", "f"), ("success_prob", "f"), ("expected_retention_value", "f"), ("intervention_cost", "f"),
    ("expected_net_benefit", "f"), ("retention_priority_score", "f"), ("recommended_action", "s"), ("recency_days", "i"),
    ("frequency", "i"), ("monetary", "f"), ("engagement_score", "f"), ("spending_trend", "f"), ("profit_margin", "f"),
]


@query(
    "export_retention_decisions", " ".join(f"{n}:{k}" for n, k in _DECISIONS),
    f"SELECT {_rounded(_DECISIONS)} FROM (SELECT * FROM fin ORDER BY priority_rank, customer_id LIMIT 100)",
)
def _(t: Tables):
    return exports.retention_decisions(t.final)


def avg2(c: str) -> str:
    return even(f"avgx({c})", 2)


@query(
    "export_segment_summary",
    "rfm_segment:s customer_count:i pct_of_total:f avg_revenue:f total_revenue:f avg_profit:f total_profit:f "
    "avg_profit_margin:f avg_churn_prob:f churn_count:i avg_engagement:f avg_recency:f avg_frequency:f avg_aov:f "
    "total_erv:f avg_priority:f",
    f"""SELECT rfm_segment, count(*) AS customer_count, {even('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fin) * 100', 2)} AS pct_of_total,
        {avg2('gross_revenue')} AS avg_revenue, {even(units('gross_revenue'), 2)} AS total_revenue, {avg2('customer_profit')} AS avg_profit,
        {even(units('customer_profit'), 2)} AS total_profit, {avg2('profit_margin')} AS avg_profit_margin, {avg2('churn_prob')} AS avg_churn_prob,
        sum(churn_predicted) AS churn_count, {avg2('engagement_score')} AS avg_engagement, {avg2('recency_days')} AS avg_recency,
        {avg2('frequency')} AS avg_frequency, {avg2('avg_order_value')} AS avg_aov, {even(units('expected_retention_value'), 2)} AS total_erv,
        {avg2('retention_priority_score')} AS avg_priority FROM fin GROUP BY 1""",
)
def _(t: Tables):
    return exports.segment_summary(t.final)


GEO_SPEC = "customer_count:i total_revenue:f avg_profit:f avg_churn_prob:f"


def geo_sql(by: str) -> str:
    return f"""SELECT {by}, count(*) AS customer_count, {even(units('gross_revenue'), 2)} AS total_revenue,
        {avg2('customer_profit')} AS avg_profit, {avg2('churn_prob')} AS avg_churn_prob FROM fin GROUP BY 1"""


@query(
    "export_geographic_summary", "customer_state:s " + GEO_SPEC + " region:s",
    f"""SELECT g.*, CASE WHEN n_nationkey < 22 THEN r_name END AS region FROM ({geo_sql('customer_state')}) g
        JOIN nation ON n_name = customer_state JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    return exports.geographic_summary(t.final, regions=t.cfg.regions)


@query("export_geographic_by_region", "region:s " + GEO_SPEC, geo_sql("region"))
def _(t: Tables):
    return exports.geographic_summary(t.final, by="region")


CATEGORY = f"""SELECT product_super_category, count(DISTINCT transaction_id) AS total_orders, sum(quantity) AS total_items,
   {even(units('revenue', 2), 2)} AS total_revenue, {even(units('unit_price', 2) + ' / count(*)', 2)} AS avg_price,
   {avg2('is_return')} AS return_rate, count(DISTINCT customer_id) AS unique_customers FROM txn GROUP BY 1"""
CATEGORY_COLUMNS = ("transaction_id", "customer_id", "product_super_category", "quantity", "revenue", "unit_price", "is_return")


@query(
    "export_category_performance",
    "product_super_category:s total_orders:i total_items:i total_revenue:f avg_price:f return_rate:f unique_customers:i",
    CATEGORY,
)
def _(t: Tables):
    return exports.category_performance(t.transactions.select(*CATEGORY_COLUMNS))


EXPORTS_SQL = """
 SELECT 'customer_master' AS table_name, count(*) AS n_rows FROM people
 UNION ALL SELECT 'transactions_summary', count(*) FROM tsum
 UNION ALL SELECT 'retention_decisions', least(100, count(*)) FROM people
 UNION ALL SELECT 'segment_summary', count(DISTINCT rfm_segment) FROM rfm_scored
 UNION ALL SELECT 'date_dimension', date_diff('day', DATE '1995-01-01', DATE '2001-08-02') + 1
 UNION ALL SELECT 'geographic_summary', count(DISTINCT customer_state) FROM people
 UNION ALL SELECT 'category_performance', count(DISTINCT product_super_category) FROM txn"""


def _exported(t: Tables) -> DataFrame:
    folder = scratch(t.spark, "exports")
    made = pipeline.export_tables(t.final, t.transactions, t.spark, t.cfg)
    pipeline.write_exports(made, folder)
    return pipeline.read_back(t.spark, list(made), folder)


@query("export_catalogue", "table_name:s n_rows:i", EXPORTS_SQL)
def _(t: Tables):
    """All seven tables written as CSV."""
    return _exported(t)


_WIDTHS = {"customer_master": len(exports.MASTER_COLUMNS) - 4, "transactions_summary": 7, "retention_decisions": 18,
           "segment_summary": 16, "date_dimension": 10, "geographic_summary": 6, "category_performance": 7}


@query(
    "export_readback", "table_name:s n_rows:i n_columns:i has_bytes:i",
    f"SELECT table_name, n_rows, {case('table_name', _WIDTHS)} AS n_columns, 1 AS has_bytes FROM ({EXPORTS_SQL})",
)
def _(t: Tables):
    """Rows, columns and size of every written table."""
    return _exported(t).withColumn("has_bytes", (F.col("n_bytes") > 0).cast("int"))


# -- joins of exported tables -----------------------------------------------------


@query(
    "segment_month_trend", "rfm_segment:s year_month:s revenue:f",
    f"""SELECT rfm_segment, year_month, {units('total_revenue')} AS revenue FROM tsum
        JOIN rfm_scored USING (customer_id) GROUP BY 1, 2""",
)
def _(t: Tables):
    return measures.segment_month_trend(t.summary, t.final)


@query(
    "calendar_join", "year_month:s revenue:f orders:i",
    f"""SELECT m.year_month, coalesce(revenue, 0) AS revenue, coalesce(orders, 0) AS orders FROM
        (SELECT DISTINCT strftime(CAST(d AS DATE), '%Y-%m') AS year_month FROM
           (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-02', INTERVAL 1 DAY)) AS d)) m
        LEFT JOIN (SELECT year_month, {units('total_revenue')} AS revenue, sum(order_count) AS orders FROM tsum GROUP BY 1) s
        ON m.year_month = s.year_month""",
)
def _(t: Tables):
    dates = exports.date_dimension(t.spark, t.cfg.start_date, t.cfg.as_of)
    return measures.calendar_months(dates, t.summary)


MONTHLY = f"""SELECT strftime(order_date, '%Y-%m') AS year_month, {units('revenue', 2)} AS revenue,
   count(DISTINCT customer_id) AS customers, {units('revenue', 2)} - {units('cost_of_goods', 4)} AS profit FROM txn GROUP BY 1"""


@query(
    "monthly_mom",
    "year_month:s revenue:f4 customers:i profit:f4 revenue_mom:f revenue_yoy:f customers_mom:f customers_yoy:f profit_mom:f profit_yoy:f",
    "SELECT *, " + ", ".join(
        f"({c} - lag({c}, {n}) OVER w) / CAST(lag({c}, {n}) OVER w AS DOUBLE) AS {c}_{s}"
        for c in ("revenue", "customers", "profit") for s, n in (("mom", 1), ("yoy", 12))
    ) + f" FROM ({MONTHLY}) WINDOW w AS (ORDER BY year_month)",
)
def _(t: Tables):
    txn = t.txn("customer_id", "order_date", "revenue", "cost_of_goods")
    return measures.month_over_month(measures.monthly_totals(txn))


_AXES = {"recency": "recency_days", "frequency": "frequency", "monetary": "monetary",
         "engagement": "engagement_score", "profit": "customer_profit"}


@query(
    "segment_radar", "rfm_segment:s " + " ".join(f"{a}:f4" for a in _AXES),
    "SELECT rfm_segment, " + ", ".join(f"({a} - min({a}) OVER ()) / (max({a}) OVER () - min({a}) OVER ()) AS {a}" for a in _AXES)
    + " FROM (SELECT rfm_segment, " + ", ".join(f"avg({c}) AS {a}" for a, c in _AXES.items()) + " FROM fin GROUP BY 1)",
)
def _(t: Tables):
    return measures.segment_radar(t.final)


# -- measures ------------------------------------------------------------------------


def where(condition: str, column: str) -> str:
    return units(f"CASE WHEN {condition} THEN {column} ELSE 0 END")


@query(
    "kpi_overview",
    "total_customers:i total_revenue:f4 total_profit:f4 avg_customer_profit:f3 active_customers:i overall_churn_rate:f at_risk_customers:i profit_at_risk:f3",
    f"""SELECT count(*) AS total_customers, {units('gross_revenue')} AS total_revenue, {units('customer_profit')} AS total_profit,
        avgx(customer_profit) AS avg_customer_profit, count(*) FILTER (churn_predicted = 0) AS active_customers,
        avg(churn_predicted) AS overall_churn_rate, count(*) FILTER (churn_prob >= 0.5) AS at_risk_customers,
        {where('churn_prob >= 0.5', 'expected_retention_value')} AS profit_at_risk FROM fin""",
)
def _(t: Tables):
    return measures.overview(t.final)


@query(
    "kpi_active_90d", "active_customers:i churn_risk_share:f",
    """SELECT count(*) FILTER (recency_days <= 90) AS active_customers,
        count(*) FILTER (churn_prob > 0.5) / CAST(count(*) AS DOUBLE) AS churn_risk_share FROM fin""",
)
def _(t: Tables):
    return measures.active_90d(t.final)


@query(
    "kpi_margin", "profit_margin:f avg_profit_margin:f",
    f"SELECT {units('customer_profit')} / {units('gross_revenue')} AS profit_margin, avgx(profit_margin) AS avg_profit_margin FROM fin",
)
def _(t: Tables):
    return measures.margin(t.final)


@query(
    "kpi_segment",
    "rfm_segment:s customers:i avg_revenue:f3 avg_frequency:f avg_recency:f4 avg_monetary:f3 avg_aov:f3 avg_engagement:f4 avg_margin:f high_value_count:i",
    """SELECT rfm_segment, count(*) AS customers, avgx(gross_revenue) AS avg_revenue, avg(frequency) AS avg_frequency,
        avg(recency_days) AS avg_recency, avgx(monetary) AS avg_monetary, avgx(avg_order_value) AS avg_aov,
        avgx(engagement_score) AS avg_engagement, avgx(profit_margin) AS avg_margin,
        count(*) FILTER (value_tier = 'High Value') AS high_value_count FROM fin GROUP BY 1""",
)
def _(t: Tables):
    return measures.by_segment(t.final)


@query(
    "kpi_segment_share", "rfm_segment:s revenue_share:f customer_share:f",
    f"""SELECT rfm_segment, {units('gross_revenue')} / (SELECT {units('gross_revenue')} FROM fin) AS revenue_share,
        CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fin) AS customer_share FROM fin GROUP BY 1""",
)
def _(t: Tables):
    return measures.segment_share(t.final)


@query(
    "kpi_unprofitable", "unprofitable:i unprofitable_share:f",
    """SELECT count(*) FILTER (customer_profit < 0) AS unprofitable,
        count(*) FILTER (customer_profit < 0) / CAST(count(*) AS DOUBLE) AS unprofitable_share FROM fin""",
)
def _(t: Tables):
    return measures.unprofitable(t.final)


_PARTS = ["total_cogs", "total_discount_cost", "return_cost", "service_cost", "acquisition_cost"]


@query(
    "kpi_cost_components", " ".join(f"{c}:f4" for c in _PARTS),
    "SELECT " + ", ".join(f"{units(c)} AS {c}" for c in _PARTS) + " FROM fin",
)
def _(t: Tables):
    return measures.cost_components(t.final)


@query(
    "kpi_profit_identity", "customer_profit_calc:f3",
    f"SELECT {units('gross_revenue')} - " + " - ".join(units(c) for c in _PARTS) + " AS customer_profit_calc FROM fin",
)
def _(t: Tables):
    return measures.profit_identity(t.final)


@query(
    "kpi_clv", "avg_clv:f2",
    "SELECT avgx(customer_profit) * avg(frequency) * 365 / avg(interpurchase_time_avg) AS avg_clv FROM fin",
)
def _(t: Tables):
    return measures.clv(t.final)


@query("kpi_q4_profit", "q4_profit:f4", f"SELECT {where('profit_quartile = 4', 'customer_profit')} AS q4_profit FROM fin")
def _(t: Tables):
    return measures.top_quartile_profit(t.final)


@query(
    "kpi_churn", "predicted_churners:i high_risk:i at_risk_revenue:f4 revenue_at_risk_share:f",
    f"""SELECT sum(churn_predicted) AS predicted_churners, count(*) FILTER (churn_prob >= 0.6) AS high_risk,
        {where('churn_prob >= 0.5', 'gross_revenue')} AS at_risk_revenue,
        {where('churn_prob >= 0.5', 'gross_revenue')} / {units('gross_revenue')} AS revenue_at_risk_share FROM fin""",
)
def _(t: Tables):
    return measures.churn(t.final)


_UP = "expected_net_benefit > 0"


@query(
    "kpi_roi", "positive_roi_customers:i budget:f expected_return:f3 campaign_roi:f",
    f"""SELECT count(*) FILTER ({_UP}) AS positive_roi_customers, {where(_UP, 'intervention_cost')} AS budget,
        {where(_UP, 'expected_retention_value')} AS expected_return,
        ({where(_UP, 'expected_retention_value')} - {where(_UP, 'intervention_cost')}) / {where(_UP, 'intervention_cost')} AS campaign_roi FROM fin""",
)
def _(t: Tables):
    return measures.roi(t.final)


@query(
    "kpi_roi_variants", "retention_roi:f expected_roi_pct:f4",
    f"""SELECT {units('expected_net_benefit')} / {units('intervention_cost')} AS retention_roi,
        {where(_UP, 'expected_net_benefit')} / {where(_UP, 'intervention_cost')} * 100 AS expected_roi_pct FROM fin""",
)
def _(t: Tables):
    return measures.roi_variants(t.final)


@query(
    "kpi_priority", "high_priority:i intervention_cost:f campaign_budget:f avg_success_prob:f",
    f"""SELECT count(*) FILTER (retention_priority_score >= 75) AS high_priority, {units('intervention_cost')} AS intervention_cost,
        {units('intervention_cost')} * 1.2 AS campaign_budget, avgx(success_prob) AS avg_success_prob FROM fin""",
)
def _(t: Tables):
    return measures.priority(t.final)


@query(
    "kpi_action_counts", "recommended_action:s customers:i",
    "SELECT recommended_action, count(*) AS customers FROM fin GROUP BY 1",
)
def _(t: Tables):
    return measures.action_counts(t.final)


@query(
    "kpi_geo_category", "state_revenue:f2 state_customers:i category_return_rate:f",
    f"""SELECT sum(total_revenue) AS state_revenue, sum(customer_count) AS state_customers,
        (SELECT avg(return_rate) FROM ({CATEGORY})) AS category_return_rate FROM ({geo_sql('customer_state')})""",
)
def _(t: Tables):
    geo = exports.geographic_summary(t.final)
    return measures.geo_category(geo, exports.category_performance(t.transactions.select(*CATEGORY_COLUMNS)))


@query(
    "kpi_what_if", "projected_retentions:f",
    "SELECT count(*) FILTER (retention_priority_score >= 75) * 0.4 * 1.5 AS projected_retentions FROM fin",
)
def _(t: Tables):
    return measures.what_if(t.final, 0.4, 1.5)


@query(
    "visual_frames", "frame:s label:s value:f3 customers:i",
    """SELECT 'recency' AS frame, CAST(CAST(floor(recency_days / 30.0) * 30 AS BIGINT) AS VARCHAR) AS label, avgx(churn_prob) AS value, count(*) AS customers FROM fin GROUP BY 2
       UNION ALL SELECT 'spending_trend', CAST(CAST(floor(spending_trend / 0.5) AS BIGINT) AS VARCHAR), avgx(churn_prob), count(*) FROM fin GROUP BY 2
       UNION ALL SELECT 'segment_tier', rfm_segment || ' / ' || coalesce(value_tier, 'none'), avgx(customer_profit), count(*) FROM fin GROUP BY 2
       UNION ALL SELECT 'channel', acquisition_channel, count(*) * 100.0 / (SELECT count(*) FROM fin), count(*) FROM fin GROUP BY 2""",
)
def _(t: Tables):
    """Churn by recency and spending trend, profit by segment and tier, channel mix."""
    f = t.final
    parts = [
        ("recency", measures.churn_by_bin(f, "recency_days", 30.0), F.col("bin_start").cast("long").cast("string"), "avg_churn_prob"),
        ("spending_trend", measures.churn_by_bin(f, "spending_trend", 0.5),
         F.floor(F.col("bin_start") / 0.5).cast("string"), "avg_churn_prob"),
        ("segment_tier", measures.segment_by_tier(f),
         F.concat("rfm_segment", F.lit(" / "), F.coalesce("value_tier", F.lit("none"))), "avg_profit"),
        ("channel", measures.channel_mix(f), F.col("acquisition_channel"), "pct"),
    ]
    rows = [
        df.select(F.lit(name).alias("frame"), label.alias("label"), F.col(value).alias("value"), "customers")
        for name, df, label, value in parts
    ]
    return reduce(DataFrame.unionByName, rows)
