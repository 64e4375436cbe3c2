"""Customer features, scores and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.operators import features, labels, profiling, segmentation
from stayline.plans.catalog.base import Tables, query
from stayline.plans.catalog.sql import SEGMENT_CASE, cents

RFM = "customer_id:i recency_days:i frequency:i monetary:f"
LEAN = ("transaction_id", "customer_id", "order_date", "revenue", "is_return")


@query("rfm_metrics", RFM, "SELECT * FROM rfm")
def _(t: Tables):
    return features.rfm_metrics(t.txn(*LEAN), t.cfg.as_of)


@query(
    "order_totals", "customer_id:i transaction_id:i order_value:f order_quantity:i order_date:d",
    "SELECT * FROM ord_tot",
)
def _(t: Tables):
    return features.order_totals(t.txn(*LEAN, "quantity"))


STATS = "avg_order_value:f4 median_order_value:f4 purchase_std:f3 avg_quantity:f"


@query("order_value_stats", "customer_id:i " + STATS, "SELECT * FROM ord_stat")
def _(t: Tables):
    return features.order_value_stats(t.txn(*LEAN, "quantity"))


@query(
    "category_diversity", "customer_id:i categories_purchased:i",
    "SELECT customer_id, categories_purchased FROM cat_div",
)
def _(t: Tables):
    return features.category_diversity(t.txn("customer_id", "revenue", "is_return", "product_category"))


@query(
    "super_category_diversity", "customer_id:i super_categories_purchased:i",
    "SELECT customer_id, super_categories_purchased FROM cat_div",
)
def _(t: Tables):
    return features.super_category_diversity(
        t.txn("customer_id", "revenue", "is_return", "product_super_category"))


@query("category_hhi", "customer_id:i category_concentration:f", "SELECT * FROM hhi")
def _(t: Tables):
    return features.category_hhi(t.txn("customer_id", "revenue", "is_return", "product_category"))


@query(
    "discount_usage", "customer_id:i discount_usage_rate:f avg_discount_pct:f", "SELECT * FROM disc_use",
)
def _(t: Tables):
    return features.discount_usage(t.txn(*LEAN, "discount_pct"))


@query("return_rate", "customer_id:i return_rate:f", "SELECT * FROM ret_rate")
def _(t: Tables):
    return features.return_rate(t.txn("customer_id", "is_return"))


GAPS = "interpurchase_time_avg:f4 interpurchase_time_std:f3"


@query("interpurchase_time", "customer_id:i " + GAPS, "SELECT * FROM gaps")
def _(t: Tables):
    return features.interpurchase_time(t.txn(*LEAN))


BEHAVIOUR = (
    f"customer_id:i {STATS} categories_purchased:i super_categories_purchased:i category_concentration:f "
    f"discount_usage_rate:f avg_discount_pct:f return_rate:f {GAPS}"
)


@query("purchase_behavior", BEHAVIOUR, "SELECT * FROM behav")
def _(t: Tables):
    return features.purchase_behavior(t.transactions)


@query("behaviour_assembly", BEHAVIOUR, "SELECT * FROM behav")
def _(t: Tables):
    """The behaviour aggregates of stored orders, joined on the customer."""
    return features.purchase_behavior(t.transactions)


@query(
    "trend_window_agg",
    "customer_id:i recent_spend:f recent_orders:i recent_aov:f4 prev_spend:f prev_orders:i prev_aov:f4",
    "SELECT * FROM wins",
)
def _(t: Tables):
    return features.trend_windows(t.txn(*LEAN), t.cfg.as_of, t.cfg.trend_days)


TRENDS = "spending_trend:f frequency_trend:f aov_trend:f"


@query("trend_features", "customer_id:i " + TRENDS, "SELECT * FROM trends")
def _(t: Tables):
    return features.trend_features(t.txn(*LEAN), t.cfg.as_of, t.cfg.trend_days)


@query("engagement_score", "customer_id:i engagement_score:f", "SELECT * FROM eng_score")
def _(t: Tables):
    return features.engagement_score(t.engagement, t.cfg)


FEATURES = (
    "customer_id:i age:i gender:s region:s signup_date:d acquisition_channel:s customer_state:s "
    f"customer_tenure_days:i recency_days:i frequency:i monetary:f {STATS} categories_purchased:i "
    "super_categories_purchased:i category_concentration:f discount_usage_rate:f avg_discount_pct:f "
    f"return_rate:f {GAPS} {TRENDS} engagement_score:f emails_opened_30d:i website_visits_30d:i "
    "campaign_clicks_30d:i app_sessions_30d:i support_tickets:i loyalty_program:i"
)


@query("customer_features", FEATURES, "SELECT * FROM feat")
def _(t: Tables):
    return t.features


@query("feature_assembly", FEATURES, "SELECT * FROM feat")
def _(t: Tables):
    """Left joins of all feature tables, missing numbers as 0."""
    return features.customer_features(t.customers, t.transactions, t.engagement, t.cfg)


# -- scores and segments ---------------------------------------------------------


@query("r_score", "customer_id:i r_score:i", "SELECT customer_id, r_score FROM rfm_scored")
def _(t: Tables):
    return segmentation.rfm_score(t.features)


@query("f_score", "customer_id:i f_score:i", "SELECT customer_id, f_score FROM rfm_scored")
def _(t: Tables):
    return segmentation.rfm_score(t.features)


@query("m_score", "customer_id:i m_score:i", "SELECT customer_id, m_score FROM rfm_scored")
def _(t: Tables):
    return segmentation.rfm_score(t.features)


@query("fn_rfm_total", "customer_id:i rfm_score:i", "SELECT customer_id, rfm_score FROM rfm_scored")
def _(t: Tables):
    return t.segmented


@query(
    "rfm_scoring", "customer_id:i r_score:i f_score:i m_score:i rfm_score:i rfm_segment:s",
    "SELECT * FROM rfm_scored",
)
def _(t: Tables):
    return segmentation.rfm_score(t.features)


@query(
    "fn_case_segment", "r_score:i f_score:i m_score:i rfm_segment:s customers:i",
    f"""SELECT r_score, f_score, m_score, {SEGMENT_CASE} AS rfm_segment, count(*) AS customers FROM rfm_scored
        GROUP BY r_score, f_score, m_score""",
)
def _(t: Tables):
    segment = S.rfm_segment("r_score", "f_score", "m_score")
    return t.segmented.groupBy("r_score", "f_score", "m_score", segment.alias("rfm_segment")).agg(
        F.count(F.lit(1)).alias("customers"))


@query(
    "fn_rfm_quadrant", "customer_id:i quadrant:s",
    """SELECT customer_id, CASE WHEN recency_days <= 30 AND frequency >= 10 THEN 'Stars'
              WHEN recency_days <= 30 AND frequency < 10 THEN 'Potential'
              WHEN recency_days > 90 AND frequency >= 5 THEN 'At Risk' ELSE 'Dormant' END AS quadrant FROM feat""",
)
def _(t: Tables):
    return t.features.select("customer_id", S.rfm_quadrant("recency_days", "frequency").alias("quadrant"))


@query(
    "equal_width_fallback", "customer_id:i monetary_bin:i",
    """SELECT customer_id, greatest(1, least(5, CAST(ceil((monetary - lo) / ((hi - lo) / 5)) AS BIGINT))) AS monetary_bin
       FROM feat, (SELECT min(monetary) AS lo, max(monetary) AS hi FROM feat)""",
)
def _(t: Tables):
    return segmentation.equal_width_scores(t.features, "monetary", "monetary_bin")


@query(
    "segment_profile",
    "rfm_segment:s customers:i avg_recency:f4 avg_frequency:f4 avg_monetary:f3 avg_engagement:f4 avg_aov:f3 pct:f",
    """SELECT rfm_segment, count(*) AS customers, avg(recency_days) AS avg_recency, avg(frequency) AS avg_frequency,
              avgx(monetary) AS avg_monetary, avgx(engagement_score) AS avg_engagement, avgx(avg_order_value) AS avg_aov,
              count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM rfm_scored GROUP BY 1""",
)
def _(t: Tables):
    return segmentation.segment_profile(t.segmented)


@query(
    "segment_revenue_share", "rfm_segment:s revenue:f revenue_pct:f",
    f"""SELECT *, revenue * 100 / sum(revenue) OVER () AS revenue_pct FROM (
        SELECT rfm_segment, {cents('monetary')} AS revenue FROM rfm_scored GROUP BY 1)""",
)
def _(t: Tables):
    return segmentation.segment_revenue_share(t.segmented)


@query(
    "share_of_total", "region:s customers:i pct:f",
    "SELECT region, count(*) AS customers, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM people GROUP BY 1",
)
def _(t: Tables):
    grouped = t.people.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    return segmentation.share_of_total(grouped, "customers", "pct")


# -- statistics of features -------------------------------------------------------


_PAIRS = [(a, b) for i, a in enumerate(profiling.CORRELATED) for b in profiling.CORRELATED[i + 1:]]


def _listed(items) -> str:
    return "[" + ", ".join(items) + "]"


@query(
    "correlation_matrix", "feature_a:s feature_b:s r:f",
    "SELECT unnest(a) AS feature_a, unnest(b) AS feature_b, unnest(r) AS r FROM (SELECT "
    + _listed(f"'{b}'" for _, b in _PAIRS) + " AS a, " + _listed(f"'{a}'" for a, _ in _PAIRS) + " AS b, "
    + _listed(f"corr({a}, {b})" for a, b in _PAIRS) + " AS r FROM feat)",
)
def _(t: Tables):
    return profiling.correlation_matrix(t.features)


def histogram_sql(column: str, table: str, bins: int, name: str, low=None, high=None) -> str:
    v = column
    if low is not None:
        v = f"greatest({v}, {low}.0)"
    if high is not None:
        v = f"least({v}, {high}.0)"
    return f"""SELECT '{name}' AS name, b AS bin, lo + b * w AS left_edge, count(v) AS n FROM
      (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / CAST({bins} AS DOUBLE) AS w
       FROM (SELECT CAST(min({v}) AS DOUBLE) AS lo, CAST(max({v}) AS DOUBLE) AS hi FROM {table})) e
      CROSS JOIN range(0, {bins}) r(b) LEFT JOIN (SELECT CAST({v} AS DOUBLE) AS v FROM {table} WHERE {column} IS NOT NULL)
      ON least(floor((v - lo) / w), {bins - 1}) = b GROUP BY lo, w, b"""


_HISTOGRAMS = [
    ("recency_days", "feat", 50, "recency", None, None),
    ("frequency", "feat", 20, "frequency", 0, 20),
    ("monetary", "feat", 50, "monetary", 0, 2000),
    ("payment_value", "pay", 50, "payment", 0, 500),
    ("customer_profit", "seg_prof", 50, "profit", None, None),
    ("profit_margin", "seg_prof", 50, "margin", -1, 1),
    ("churn_prob", "fin", 50, "churn_prob", None, None),
    ("retention_priority_score", "fin", 50, "priority", None, None),
    ("rfm_score", "fin", 13, "rfm_score", None, None),
]


@query(
    "histogram", "name:s bin:i left_edge:f n:i",
    " UNION ALL ".join(histogram_sql(*h) for h in _HISTOGRAMS),
)
def _(t: Tables):
    """Bin counts of nine columns, some of them clamped first."""
    source = {"feat": t.features, "pay": t.raw["payments"], "seg_prof": t.profitable, "fin": t.final}
    parts = [
        profiling.histograms(df, [(c, bins, name, low, high) for c, of, bins, name, low, high in _HISTOGRAMS if of == table])
        for table, df in source.items()
    ]
    return profiling.union_profiles(parts)


@query(
    "histogram_by_tier", "value_tier:s bin:i left_edge:f n:i",
    """SELECT value_tier, b AS bin, lo + b * w AS left_edge, count(v) AS n FROM
       (SELECT value_tier, min(v) AS lo, (max(v) - min(v)) / CAST(40 AS DOUBLE) AS w FROM (SELECT value_tier,
          least(greatest(customer_profit, -200.0), 500.0) AS v FROM prof) GROUP BY 1) e
       CROSS JOIN range(0, 40) r(b)
       LEFT JOIN (SELECT value_tier AS t, least(greatest(customer_profit, -200.0), 500.0) AS v FROM prof)
         ON t = value_tier AND CASE WHEN w = 0 THEN 20 ELSE least(floor((v - lo) / w), 39) END = b
       GROUP BY value_tier, lo, w, b""" .replace(
        "lo + b * w AS left_edge", "CASE WHEN w = 0 THEN lo - 0.5 + b / 40.0 ELSE lo + b * w END AS left_edge"),
)
def _(t: Tables):
    """Profit per value tier, clamped to [-200, 500]."""
    return profiling.histogram(t.profitable, "customer_profit", 40, -200.0, 500.0, by="value_tier")


_DESCRIBED = ["recency_days", "frequency", "monetary", "avg_order_value", "engagement_score"]


@query(
    "feature_describe", "column_name:s n:i mean:f4 std:f3 low:f4 q25:f4 q50:f4 q75:f4 high:f4",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS low,
            quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS high FROM feat"""
        for c in _DESCRIBED
    ),
)
def _(t: Tables):
    return profiling.describe(t.features, _DESCRIBED, "customer_id")


_SCALED = ["recency_days", "frequency", "monetary", "engagement_score", "avg_order_value"]


@query(
    "standardise", "customer_id:i " + " ".join(f"{c}:f" for c in _SCALED),
    "SELECT customer_id, " + ", ".join(
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _SCALED) + " FROM feat",
)
def _(t: Tables):
    return labels.standardise(t.features.select("customer_id", *_SCALED), _SCALED)
