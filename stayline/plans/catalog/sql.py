"""Shared SQL tables of the oracle statements, written apart from the Spark code."""

from __future__ import annotations

from stayline.config import (
    CHANNELS, ENGAGEMENT_WEIGHTS, INTERVENTION_COSTS, RETURN_RATES, SUCCESS_PROBABILITIES,
    SUPER_CATEGORIES, WEIGHT_SETS,
)
from stayline.sources.fixtures import BRAND_CATEGORIES, REGION_NAMES, SEGMENT_CHANNELS

AS_OF = "DATE '2001-08-02'"
SPLIT = "DATE '2001-05-02'"


def text(x) -> str:
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(text(x) for x in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def case(column: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {text(default) if default is not None else 'NULL'} END"


def u(purpose: str, key: str) -> str:
    return (
        f"(CAST('0x' || substr(md5('42:{purpose}:' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0)"
    )


def even(x: str, digits: int) -> str:
    scale = float(10**digits)
    return f"(CAST(round_even(CAST({x} AS DOUBLE) * {scale!r}, 0) AS DOUBLE) / {scale!r})"


def cents(x: str) -> str:
    return f"CAST(CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) AS DOUBLE)"


def units(x: str, digits: int = 6) -> str:
    scale = float(10**digits)
    return f"(CAST(sum(CAST(round_even(CAST(({x}) * {scale!r} AS DOUBLE), 0) AS HUGEINT)) AS DOUBLE) / {scale!r})"


def mean(x: str) -> str:
    """Average from an exact sum, so that rounding meets the same double."""
    return f"({units(x)} / count({x}))"


def trend(recent: str, prev: str) -> str:
    return (
        f"least(greatest(CASE WHEN {prev} > 0 THEN ({recent} - {prev}) / CAST({prev} AS DOUBLE) "
        f"WHEN {recent} > 0 THEN 1.0 ELSE 0.0 END, -1.0), 5.0)"
    )


def bucket(order: str, q: int, partition: str = "") -> str:
    return (
        f"greatest(1, CAST(ceil((row_number() OVER ({partition} ORDER BY {order}) - 1) * {q} "
        f"/ CAST(count(*) OVER ({partition}) - 1 AS DOUBLE)) AS BIGINT))"
    )


def unit_scale(c: str) -> str:
    return (
        f"(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 "
        f"ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END)"
    )


SEGMENT_CASE = """
 CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
      WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
      WHEN r_score >= 4 AND f_score <= 3 AND m_score <= 3 THEN 'Potential Loyalists'
      WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'High Value At Risk'
      WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
      WHEN r_score BETWEEN 2 AND 3 AND f_score <= 3 AND m_score <= 3 THEN 'Needs Attention'
      WHEN r_score <= 1 AND f_score <= 2 AND m_score <= 2 THEN 'Dormant'
      ELSE 'Needs Attention' END"""

ACTION_CASE = """
 CASE WHEN expected_net_benefit <= 0 THEN
           CASE WHEN value_tier = 'Low Value' THEN 'Let Go — Negative ROI' ELSE 'Monitor — Marginal ROI' END
      WHEN value_tier = 'High Value' THEN
           CASE WHEN churn_prob >= 0.6 THEN 'Immediate Retention — Personal Outreach'
                WHEN churn_prob >= 0.3 THEN 'Proactive Retention — Premium Offer'
                ELSE 'Maintain — Loyalty Rewards' END
      WHEN value_tier = 'Medium Value' THEN
           CASE WHEN churn_prob >= 0.5 THEN 'Targeted Campaign — Email + Discount'
                ELSE 'Nurture — Cross-sell Campaign' END
      WHEN value_tier = 'Low Value' AND churn_prob >= 0.5 THEN 'Low-Cost — Automated Email Sequence'
      ELSE 'Standard — No Specific Action' END"""

RISK_CASE = """
 CASE WHEN churn_prob BETWEEN 0 AND 0.3 THEN 'Low Risk'
      WHEN churn_prob > 0.3 AND churn_prob <= 0.6 THEN 'Medium Risk'
      WHEN churn_prob > 0.6 AND churn_prob <= 1 THEN 'High Risk' END"""

RETURN_RATE_CASE = (
    "CASE "
    + " ".join(
        f"WHEN position({text(k)} IN lower(product_category)) > 0 THEN {v}" for k, v in RETURN_RATES.items()
    )
    + " ELSE 0.05 END"
)

_SCORE = " + ".join(
    f"CASE WHEN (SELECT max({c}) FROM eng) > 0 THEN {c} / CAST((SELECT max({c}) FROM eng) AS DOUBLE) ELSE 0 END * {w} * 100"
    for c, w in ENGAGEMENT_WEIGHTS.items()
)

_NUMERIC_FEATURES = [
    "recency_days", "frequency", "monetary", "avg_order_value", "median_order_value",
    "purchase_std", "avg_quantity", "categories_purchased", "category_concentration",
    "super_categories_purchased", "discount_usage_rate", "avg_discount_pct", "return_rate",
    "interpurchase_time_avg", "interpurchase_time_std", "spending_trend", "frequency_trend",
    "aov_trend", "engagement_score", "emails_opened_30d", "website_visits_30d",
    "campaign_clicks_30d", "app_sessions_30d", "support_tickets", "loyalty_program",
]

CTES: dict[str, str] = {}

CTES["ord_all"] = """
 SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status
 FROM orders"""
CTES["items"] = """
 SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
        l_extendedprice * l_tax AS freight_value, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return
 FROM lineitem"""
CTES["pay"] = """
 SELECT l_orderkey AS order_id, l_returnflag AS payment_type, l_linenumber AS payment_installments,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value
 FROM lineitem"""
CTES["brand_map"] = values(BRAND_CATEGORIES.items(), "brand, category")
CTES["super_map"] = values(SUPER_CATEGORIES.items(), "category, super_category")
CTES["prod"] = """
 SELECT p_partkey AS product_id, b.category AS translated, coalesce(b.category, 'other') AS product_category,
        coalesce(s.super_category, 'Other') AS product_super_category
 FROM part LEFT JOIN brand_map b ON p_brand = b.brand LEFT JOIN super_map s ON b.category = s.category"""
CTES["disc"] = """
 SELECT i.order_id,
        CASE WHEN price > paid
             THEN least(greatest(CAST(price - paid AS DOUBLE) / CAST(price AS DOUBLE) * 100, 0.0), 40.0)
             ELSE 0.0 END AS discount_pct
 FROM (SELECT order_id, sum(CAST(price AS DECIMAL(20, 6))) AS price FROM items GROUP BY 1) i
 LEFT JOIN (SELECT order_id, sum(CAST(payment_value AS DECIMAL(20, 6))) AS paid FROM pay GROUP BY 1) p
   ON i.order_id = p.order_id"""
CTES["txn"] = """
 SELECT o.order_id AS transaction_id, o.customer_id, o.order_date, p.product_category,
        p.product_super_category, 'P_' || i.product_id AS product_id, 1 AS quantity,
        i.price AS unit_price, i.price AS revenue, coalesce(d.discount_pct, 0) AS discount_pct,
        i.is_return, i.price * 0.55 AS cost_of_goods, i.freight_value
 FROM ord_all o JOIN items i ON o.order_id = i.order_id
 LEFT JOIN prod p ON i.product_id = p.product_id
 LEFT JOIN disc d ON o.order_id = d.order_id
 WHERE o.order_status IN ('delivered', 'shipped', 'invoiced')"""
CTES["kept"] = "SELECT * FROM txn WHERE is_return = 0"
CTES["people"] = f"""
 SELECT c_custkey AS customer_id,
        least(greatest(CAST(trunc(35.0 + 10.0 * (sqrt(-2.0 * ln(1.0 - {u('age/r', 'c_custkey')}))
              * cos(2 * pi() * {u('age/a', 'c_custkey')}))) AS BIGINT), 18), 70) AS age,
        CASE WHEN {u('gender', 'c_custkey')} < 0.48 THEN 'M' WHEN {u('gender', 'c_custkey')} < 0.96 THEN 'F'
             ELSE 'Other' END AS gender,
        r_name AS region, first_day AS signup_date,
        {case('c_mktsegment', SEGMENT_CHANNELS)} AS acquisition_channel,
        c_name AS customer_city, n_name AS customer_state
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 JOIN (SELECT customer_id, min(order_date) AS first_day FROM ord_all GROUP BY 1) f ON f.customer_id = c_custkey"""
CTES["eng"] = """
 SELECT customer_id, coalesce(emails, 0) AS emails_opened_30d, coalesce(visits, 0) AS website_visits_30d,
        coalesce(clicks, 0) AS campaign_clicks_30d, coalesce(days, 0) AS app_sessions_30d,
        coalesce(tickets, 0) AS support_tickets, coalesce(loyal, 0) AS loyalty_program
 FROM people LEFT JOIN (
   SELECT user_id, least(count(*) FILTER (event_type = 'purchase'), 25) AS emails,
          least(count(*) FILTER (event_type = 'view'), 60) AS visits,
          least(count(*) FILTER (event_type = 'click'), 20) AS clicks,
          least(count(DISTINCT CAST(ts AS DATE)), 50) AS days,
          least(count(*) FILTER (event_type = 'error'), 8) AS tickets,
          CASE WHEN count(*) FILTER (event_type = 'signup') > 0 THEN 1 ELSE 0 END AS loyal
   FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1) e ON customer_id = user_id"""
CTES["eng_score"] = f"SELECT customer_id, {even(_SCORE, 2)} AS engagement_score FROM eng"
CTES["rfm"] = f"""
 SELECT customer_id, date_diff('day', max(order_date), {AS_OF}) AS recency_days,
        count(DISTINCT transaction_id) AS frequency, {cents('revenue')} AS monetary
 FROM kept GROUP BY 1"""
CTES["ord_tot"] = f"""
 SELECT customer_id, transaction_id, {cents('revenue')} AS order_value, sum(quantity) AS order_quantity,
        min(order_date) AS order_date, sum(CAST(round_even(revenue * CAST(100 AS DOUBLE), 0) AS BIGINT)) AS order_cents FROM kept GROUP BY 1, 2"""
CTES["ord_stat"] = """
 SELECT customer_id, CAST(sum(order_cents) AS DOUBLE) / count(*) / 100.0 AS avg_order_value,
        median(CAST(order_cents AS BIGINT)) / 100.0 AS median_order_value,
        coalesce(stddev_samp(order_value), 0) AS purchase_std, avg(order_quantity) AS avg_quantity
 FROM ord_tot GROUP BY 1"""
CTES["cat_div"] = """
 SELECT customer_id, count(DISTINCT product_category) AS categories_purchased,
        count(DISTINCT product_super_category) AS super_categories_purchased FROM kept GROUP BY 1"""
CTES["hhi"] = f"""
 SELECT customer_id, sum(share * share) AS category_concentration FROM (
   SELECT customer_id, rev / sum(rev) OVER (PARTITION BY customer_id) AS share FROM (
     SELECT customer_id, product_category, {cents('revenue')} AS rev FROM kept GROUP BY 1, 2))
 GROUP BY 1"""
CTES["disc_use"] = f"""
 SELECT customer_id, avg(CASE WHEN discount_pct > 0 THEN 1.0 ELSE 0.0 END) AS discount_usage_rate,
        avg(discount_pct) AS avg_discount_pct FROM kept GROUP BY 1"""
CTES["ret_rate"] = "SELECT customer_id, sum(is_return) / CAST(count(*) AS DOUBLE) AS return_rate FROM txn GROUP BY 1"
CTES["gaps"] = """
 SELECT customer_id, coalesce(avg(gap), 0) AS interpurchase_time_avg,
        coalesce(stddev_samp(gap), 0) AS interpurchase_time_std
 FROM (SELECT customer_id, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id
              ORDER BY order_date, transaction_id), order_date) AS gap FROM ord_tot) GROUP BY 1"""
CTES["behav"] = """
 SELECT * FROM ord_stat LEFT JOIN cat_div USING (customer_id) LEFT JOIN hhi USING (customer_id)
 LEFT JOIN disc_use USING (customer_id) LEFT JOIN ret_rate USING (customer_id) LEFT JOIN gaps USING (customer_id)"""


def _window(condition: str, name: str) -> str:
    return f"""
 SELECT customer_id, {cents('revenue')} AS {name}_spend, count(DISTINCT transaction_id) AS {name}_orders,
        CAST(sum(CAST(round_even(revenue * CAST(100 AS DOUBLE), 0) AS BIGINT)) AS DOUBLE) / count(*) / 100.0 AS {name}_aov FROM kept WHERE {condition} GROUP BY 1"""


CTES["win_recent"] = _window(f"order_date >= {AS_OF} - INTERVAL 90 DAY", "recent")
CTES["win_prev"] = _window(
    f"order_date >= {AS_OF} - INTERVAL 180 DAY AND order_date < {AS_OF} - INTERVAL 90 DAY", "prev"
)
CTES["wins"] = """
 SELECT customer_id, coalesce(recent_spend, 0) AS recent_spend, coalesce(recent_orders, 0) AS recent_orders,
        coalesce(recent_aov, 0) AS recent_aov, coalesce(prev_spend, 0) AS prev_spend,
        coalesce(prev_orders, 0) AS prev_orders, coalesce(prev_aov, 0) AS prev_aov
 FROM (SELECT DISTINCT customer_id FROM kept) LEFT JOIN win_recent USING (customer_id)
 LEFT JOIN win_prev USING (customer_id)"""
CTES["trends"] = f"""
 SELECT customer_id, {trend('recent_spend', 'prev_spend')} AS spending_trend,
        {trend('recent_orders', 'prev_orders')} AS frequency_trend,
        {trend('recent_aov', 'prev_aov')} AS aov_trend FROM wins"""
CTES["feat"] = f"""
 SELECT customer_id, age, gender, region, signup_date, acquisition_channel, customer_city, customer_state,
        date_diff('day', signup_date, {AS_OF}) AS customer_tenure_days,
        {', '.join(f'coalesce({c}, 0) AS {c}' for c in _NUMERIC_FEATURES)}
 FROM people LEFT JOIN rfm USING (customer_id) LEFT JOIN behav USING (customer_id)
 LEFT JOIN trends USING (customer_id) LEFT JOIN eng_score USING (customer_id) LEFT JOIN eng USING (customer_id)"""
CTES["rfm_scored"] = f"""
 SELECT *, r_score + f_score + m_score AS rfm_score, {SEGMENT_CASE} AS rfm_segment FROM (
   SELECT *, 6 - {bucket('recency_days, customer_id', 5)} AS r_score,
          {bucket('frequency, customer_id', 5)} AS f_score,
          {bucket('monetary, customer_id', 5)} AS m_score FROM feat)"""
CTES["comp"] = f"""
 SELECT customer_id, {cents('revenue')} AS gross_revenue,
        {units('cost_of_goods', 4)} AS total_cogs, sum(is_return) AS total_returns,
        {units('freight_value', 4)} AS total_freight,
        coalesce(CAST(sum(CASE WHEN is_return = 1 THEN CAST(revenue AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS returned_revenue,
        CAST(sum(CASE WHEN is_return = 1 THEN 0 ELSE CAST(revenue AS DECIMAL(18,2)) END) AS DOUBLE) AS net_revenue,
        {units('revenue * discount_pct / 100')} AS total_discount_cost
 FROM txn GROUP BY 1"""
CTES["side"] = f"""
 SELECT c.*, coalesce(e.support_tickets, 0) AS support_tickets, c.total_returns * 5.0 AS return_cost,
        coalesce(e.support_tickets, 0) * 10.0 AS service_cost,
        coalesce({case('p.acquisition_channel', {k: v[1] for k, v in CHANNELS.items()})}, 0) AS acquisition_cost
 FROM comp c LEFT JOIN eng e ON c.customer_id = e.customer_id
 LEFT JOIN people p ON c.customer_id = p.customer_id"""
CTES["stmt"] = """
 SELECT *, CASE WHEN net_revenue > 0 THEN customer_profit / net_revenue ELSE 0 END AS profit_margin FROM (
   SELECT *, net_revenue - total_cogs - total_discount_cost - CAST(return_cost AS DOUBLE)
             - CAST(service_cost AS DOUBLE) - CAST(acquisition_cost AS DOUBLE) AS customer_profit FROM side)"""
CTES["prof"] = f"""
 SELECT *, {bucket('customer_profit, customer_id', 4)} AS profit_quartile,
        CASE WHEN customer_profit >= (SELECT quantile_cont(customer_profit, 0.66) FROM stmt) THEN 'High Value'
             WHEN customer_profit >= (SELECT quantile_cont(customer_profit, 0.33) FROM stmt) THEN 'Medium Value'
             ELSE 'Low Value' END AS value_tier
 FROM stmt"""
CTES["seg_prof"] = """
 SELECT s.*, p.gross_revenue, p.net_revenue, p.total_cogs, p.total_discount_cost, p.return_cost,
        p.service_cost, p.acquisition_cost, p.customer_profit, p.profit_margin, p.profit_quartile,
        p.value_tier, p.total_freight
 FROM rfm_scored s LEFT JOIN prof p ON s.customer_id = p.customer_id"""
CTES["lab"] = f"""
 SELECT customer_id, CASE WHEN customer_id IN (
          SELECT customer_id FROM txn WHERE order_date >= {SPLIT} AND order_date <= {AS_OF}) THEN 0 ELSE 1 END AS churn
 FROM (SELECT DISTINCT customer_id FROM txn WHERE order_date < {SPLIT})"""
CTES["chur"] = """
 SELECT *, CASE WHEN churn_prob >= 0.5 THEN 1 ELSE 0 END AS churn_predicted FROM (
   SELECT p.*, recency_days / (recency_days + 200.0) AS churn_prob, churn AS churn_actual
   FROM seg_prof p LEFT JOIN lab ON p.customer_id = lab.customer_id)"""
CTES["val"] = f"""
 SELECT *, expected_retention_value - intervention_cost AS expected_net_benefit FROM (
   SELECT *, customer_profit * churn_prob * success_prob AS expected_retention_value FROM (
     SELECT * REPLACE (coalesce(customer_profit, 0) AS customer_profit),
            CAST({case('value_tier', INTERVENTION_COSTS, 5)} AS DOUBLE) AS intervention_cost,
            CAST({case('rfm_segment', SUCCESS_PROBABILITIES, 0.35)} AS DOUBLE) AS success_prob FROM chur))"""
CTES["norm"] = f"""
 SELECT *, {unit_scale('customer_profit')} AS n_profit, {unit_scale('churn_prob')} AS n_churn,
        {unit_scale('expected_net_benefit')} AS n_benefit FROM val"""
CTES["fin"] = f"""
 SELECT *, rank() OVER (ORDER BY retention_priority_score DESC) AS priority_rank,
        {ACTION_CASE} AS recommended_action, {RISK_CASE} AS risk_tier FROM (
   SELECT *, {even('(CAST(0.4 AS DOUBLE) * n_profit + CAST(0.35 AS DOUBLE) * n_churn + CAST(0.25 AS DOUBLE) * n_benefit) * 100', 1)}
          AS retention_priority_score FROM norm)"""
CTES["tsum"] = f"""
 SELECT customer_id, strftime(order_date, '%Y-%m') AS year_month, count(DISTINCT transaction_id) AS order_count,
        {even(cents('revenue'), 2)} AS total_revenue, sum(quantity) AS total_quantity,
        {even('CAST(sum(CAST(round_even(revenue * CAST(100 AS DOUBLE), 0) AS BIGINT)) AS DOUBLE) / count(*) / 100.0', 2)} AS avg_order_value,
        sum(is_return) AS return_count
 FROM txn GROUP BY 1, 2"""
CTES["weight_sets"] = values([(k, *v) for k, v in WEIGHT_SETS.items()], "weights, w_value, w_risk, w_benefit")
CTES["wscores"] = """
 SELECT customer_id, weights, (CAST(w_value AS DOUBLE) * n_profit + CAST(w_risk AS DOUBLE) * n_churn
        + CAST(w_benefit AS DOUBLE) * n_benefit) * 100 AS score FROM norm CROSS JOIN weight_sets"""
CTES["wtop"] = """
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY weights ORDER BY score DESC, customer_id) AS place
 FROM wscores) WHERE place <= 20"""
CTES["tscore"] = "SELECT customer_id, churn_prob, churn_actual AS churn FROM chur WHERE churn_actual IS NOT NULL"
CTES["curve"] = """
 SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp
 FROM (SELECT churn_prob AS threshold, sum(churn) AS pos, sum(1 - churn) AS neg FROM tscore GROUP BY 1)"""
