"""Profit statement, tiers and profit reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.operators import profitability
from stayline.plans.catalog.base import Tables, query
from stayline.plans.catalog.sql import CHANNELS, case, units

MONEY = ("transaction_id", "customer_id", "revenue", "is_return", "cost_of_goods", "freight_value",
         "discount_pct")


@query(
    "profit_components", "customer_id:i gross_revenue:f total_cogs:f total_returns:i total_freight:f",
    "SELECT * FROM comp",
)
def _(t: Tables):
    return profitability.profit_components(t.txn(*MONEY))


@query("returned_revenue", "customer_id:i returned_revenue:f net_revenue:f", "SELECT * FROM comp")
def _(t: Tables):
    return profitability.profit_components(t.txn(*MONEY))


@query("discount_cost", "customer_id:i total_discount_cost:f", "SELECT * FROM comp")
def _(t: Tables):
    return profitability.profit_components(t.txn(*MONEY))


@query(
    "channel_cost_join", "customer_id:i acquisition_channel:s acquisition_cost:f",
    f"""SELECT customer_id, acquisition_channel,
        coalesce({case('acquisition_channel', {k: v[1] for k, v in CHANNELS.items()})}, 0) AS acquisition_cost FROM people""",
)
def _(t: Tables):
    return profitability.acquisition_costs(t.people, t.cfg)


@query(
    "service_and_return_cost", "customer_id:i support_tickets:i return_cost:f service_cost:f acquisition_cost:f",
    "SELECT * FROM side",
)
def _(t: Tables):
    parts = profitability.profit_components(t.txn(*MONEY))
    return profitability.side_costs(parts, t.engagement, t.people, t.cfg)


STATEMENT = (
    "customer_id:i gross_revenue:f net_revenue:f total_cogs:f total_discount_cost:f return_cost:f "
    "service_cost:f acquisition_cost:f customer_profit:f profit_margin:f profit_quartile:i value_tier:s total_freight:f"
)


@query("customer_profitability", STATEMENT, "SELECT * FROM prof")
def _(t: Tables):
    return profitability.customer_profitability(t.transactions, t.customers, t.engagement, t.cfg)


@query("profit_quartile", "customer_id:i profit_quartile:i", "SELECT * FROM prof")
def _(t: Tables):
    base = t.statement.drop("profit_quartile", "value_tier")
    return profitability.profit_quartile(base)


@query("value_tier", "customer_id:i value_tier:s", "SELECT * FROM prof")
def _(t: Tables):
    base = t.statement.drop("profit_quartile", "value_tier")
    return profitability.value_tier(base)


@query("profit_join", STATEMENT + " rfm_segment:s", "SELECT * FROM seg_prof")
def _(t: Tables):
    return t.profitable


@query("profit_pipeline", STATEMENT + " rfm_segment:s monetary:f", "SELECT * FROM seg_prof")
def _(t: Tables):
    """Profit statement and its join with the segmented customers."""
    return profitability.add_profitability(t.segmented, t.transactions, t.customers, t.engagement, t.cfg)


@query(
    "filter_high_rev_low_margin", "customer_id:i gross_revenue:f profit_margin:f",
    """SELECT customer_id, gross_revenue, profit_margin FROM seg_prof
       WHERE gross_revenue > (SELECT quantile_cont(gross_revenue, 0.75) FROM seg_prof)
         AND profit_margin < (SELECT quantile_cont(profit_margin, 0.25) FROM seg_prof)""",
)
def _(t: Tables):
    return profitability.high_revenue_low_margin(t.profitable)


@query(
    "filter_unprofitable", "unprofitable:i unprofitable_share:f",
    """SELECT count(*) FILTER (customer_profit < 0) AS unprofitable,
              count(*) FILTER (customer_profit < 0) / CAST(count(*) AS DOUBLE) AS unprofitable_share FROM seg_prof""",
)
def _(t: Tables):
    return profitability.unprofitable(t.profitable)


@query(
    "profit_summary", "total_revenue:f4 total_profit:f4 avg_margin:f unprofitable:i unprofitable_share:f",
    f"""SELECT {units('gross_revenue')} AS total_revenue, {units('customer_profit')} AS total_profit,
              avgx(profit_margin) AS avg_margin, count(*) FILTER (customer_profit < 0) AS unprofitable,
              count(*) FILTER (customer_profit < 0) / CAST(count(*) AS DOUBLE) AS unprofitable_share FROM seg_prof""",
)
def _(t: Tables):
    return profitability.profit_summary(t.profitable)


@query(
    "segment_profit", "rfm_segment:s avg_profit:f3 avg_margin:f customers:i",
    """SELECT rfm_segment, avgx(customer_profit) AS avg_profit, avgx(profit_margin) AS avg_margin, count(*) AS customers
       FROM seg_prof GROUP BY 1""",
)
def _(t: Tables):
    return profitability.segment_profit(t.profitable)


@query(
    "value_tier_summary", "value_tier:s customers:i total_profit:f4 avg_profit:f3 avg_margin:f pct:f",
    f"""SELECT value_tier, count(*) AS customers, {units('customer_profit')} AS total_profit, avgx(customer_profit) AS avg_profit,
              avgx(profit_margin) AS avg_margin, count(*) * 100.0 / sum(count(*)) OVER () AS pct
       FROM seg_prof WHERE value_tier IS NOT NULL GROUP BY 1""",
)
def _(t: Tables):
    return profitability.value_tier_summary(t.profitable)


@query(
    "cost_breakdown", "cost:s amount:f4",
    " UNION ALL ".join(
        f"SELECT '{k}' AS cost, {units(c)} AS amount FROM prof" for k, c in profitability.COSTS.items()),
)
def _(t: Tables):
    return profitability.cost_breakdown(t.statement)


PARETO = """
 SELECT customer_id, customer_profit, CAST(run AS DOUBLE) / 1e6 AS cumulative_profit, CAST(run AS DOUBLE) / CAST(tot AS DOUBLE) * 100 AS cumulative_pct, rn * 100.0 / n AS customer_pct
 FROM (SELECT customer_id, customer_profit, sum(units) OVER w AS run, sum(units) OVER () AS tot,
              row_number() OVER w AS rn, count(*) OVER () AS n
       FROM (SELECT *, CAST(round_even(customer_profit * CAST(1000000 AS DOUBLE), 0) AS HUGEINT) AS units FROM prof)
       WINDOW w AS (ORDER BY customer_profit DESC, customer_id ROWS UNBOUNDED PRECEDING))"""


@query(
    "pareto_cumulative",
    "customer_id:i customer_profit:f cumulative_profit:f3 cumulative_pct:f customer_pct:f", PARETO,
)
def _(t: Tables):
    return profitability.pareto(t.profitable)


@query(
    "pareto_top_share", "top_share_pct:f",
    f"SELECT sum(customer_profit) FILTER (customer_pct <= 20) * 100 / sum(customer_profit) AS top_share_pct FROM ({PARETO})",
)
def _(t: Tables):
    return profitability.top_share(profitability.pareto(t.profitable))


@query(
    "segment_crosstab", "rfm_segment:s value_tier:s customers:i",
    """SELECT CASE WHEN grouping(rfm_segment) = 1 THEN 'Total' ELSE rfm_segment END AS rfm_segment,
              CASE WHEN grouping(value_tier) = 1 THEN 'Total' ELSE value_tier END AS value_tier, count(*) AS customers
       FROM (SELECT rfm_segment, value_tier FROM seg_prof WHERE value_tier IS NOT NULL) GROUP BY CUBE (rfm_segment, value_tier)""",
)
def _(t: Tables):
    from stayline.operators.segmentation import crosstab

    return crosstab(t.profitable.filter(F.col("value_tier").isNotNull()), "rfm_segment", "value_tier")
