"""Hand-made edge cases of features, scores and economics."""

import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import scalars as S
from stayline.functions import synth
from stayline.operators import (
    evaluation, exports, features, ingest, labels, priority, profiling, profitability, segmentation,
)

CFG = Settings()
AS_OF = dt.date(2018, 9, 1)
TXN = (
    "transaction_id string, customer_id string, order_date date, product_category string, "
    "quantity int, revenue double, discount_pct double, is_return int"
)


def txn(spark, *rows):
    return spark.createDataFrame(list(rows), TXN)


def line(order, customer, day, category="toys", revenue=10.0, returned=0, discount=0.0):
    return (order, customer, dt.date.fromisoformat(day), category, 1, revenue, discount, returned)


def test_single_order_has_no_spread_and_no_gap(spark):
    df = txn(spark, line("o1", "a", "2018-08-01"), line("o1", "a", "2018-08-01", "baby", 30.0))
    r = features.purchase_behavior(df).first()
    assert (r.purchase_std, r.interpurchase_time_avg, r.interpurchase_time_std) == (0, 0, 0)
    assert (r.avg_order_value, r.median_order_value, r.avg_quantity) == (40, 40, 2)
    assert r.category_concentration == pytest.approx(0.625)


def test_gaps_of_same_day_orders(spark):
    days = ["2018-01-01", "2018-01-01", "2018-01-11", "2018-02-10"]
    df = txn(spark, *[line(f"o{i}", "a", d) for i, d in enumerate(days)])
    r = features.interpurchase_time(df).first()
    assert r.interpurchase_time_avg == pytest.approx(40 / 3)
    assert r.interpurchase_time_std == pytest.approx(15.275252316519467)


def test_returned_only_customer(spark):
    df = txn(spark, line("o1", "a", "2018-08-01", returned=1), line("o2", "b", "2018-08-02"))
    assert [r.customer_id for r in features.rfm_metrics(df, AS_OF).collect()] == ["b"]
    people = spark.createDataFrame(
        [(c, 30, "F", "South", dt.date(2018, 1, 1), "Email") for c in "ab"],
        "customer_id string, age int, gender string, region string, signup_date date, acquisition_channel string")
    eng = spark.createDataFrame(
        [(c, 0, 1, 2, 3, 0, 0) for c in "ab"],
        "customer_id string, emails_opened_30d int, website_visits_30d int, campaign_clicks_30d int, "
        "app_sessions_30d int, support_tickets int, loyalty_program int")
    got = {r.customer_id: r for r in features.customer_features(people, df, eng, CFG).collect()}
    assert got["a"].recency_days == 0 and got["a"].frequency == 0
    assert got["b"].engagement_score == 80.0  # emails have maximum 0 and add nothing
    from dataclasses import replace

    worst = features.customer_features(people, df, eng, replace(CFG, null_recency="worst"))
    assert {r.customer_id: r.recency_days for r in worst.collect()} == {"a": 30, "b": 30}


def test_orders_of_unknown_customers_make_no_customer(spark):
    rows = [line(f"o{i}", c, f"2018-0{1 + i % 8}-01", revenue=10.0 * i) for i, c in enumerate("abcdab", start=1)]
    known = txn(spark, *rows)
    orphan = txn(spark, *rows, line("o9", None, "2018-08-03", revenue=500.0), line("o8", None, "2018-02-03"))
    extra = {"cost_of_goods": F.lit(1.0), "freight_value": F.lit(2.0)}
    for made in (
        lambda df: features.rfm_metrics(df, AS_OF), features.purchase_behavior, features.return_rate, features.category_hhi,
        lambda df: features.trend_features(df, AS_OF), lambda df: profitability.profit_components(df.withColumns(extra)),
        exports.transactions_summary, ingest.distinct_customers, lambda df: ingest.recent_activity(df, CFG),
        lambda df: labels.churn_labels(df, dt.date(2018, 5, 1), AS_OF),
    ):
        assert sorted(map(str, made(orphan).collect())) == sorted(map(str, made(known).collect()))
    assert segmentation_sizes(orphan) == segmentation_sizes(known)


def segmentation_sizes(df):
    parts = profitability.profit_components(df.withColumns({"cost_of_goods": F.lit(1.0), "freight_value": F.lit(2.0)}))
    profit = parts.withColumn("customer_profit", F.col("net_revenue"))
    return sorted(map(str, profitability.profit_quartile(profit).select("customer_id", "profit_quartile").collect()))


def test_payments_are_not_rounded_before_the_sum(spark):
    pay = spark.createDataFrame([("o1", "card", 1, 0.004), ("o1", "card", 1, 0.004), ("o1", "slip", 2, 0.004)],
                                "order_id string, payment_type string, payment_installments int, payment_value double")
    assert ingest.payment_summary(pay).first()["total_payment"] == pytest.approx(0.012)
    items = spark.createDataFrame([("o1", 0.02)], "order_id string, price double")
    assert ingest.order_discounts(items, pay, CFG).first()["discount_pct"] == pytest.approx(40.0)
    assert ingest.order_discounts(items.withColumn("price", F.lit(0.015)), pay, CFG).first()["discount_pct"] == pytest.approx(20.0)


def test_hhi_without_revenue_is_null(spark):
    df = txn(spark, line("o1", "a", "2018-08-01", revenue=0.0))
    assert features.category_hhi(df).first().category_concentration is None


def test_trends(spark):
    df = txn(
        spark, line("o1", "new", "2018-08-01"), line("o2", "gone", "2018-04-01"), line("o3", "old", "2017-01-01"),
        line("o4", "up", "2018-08-01", revenue=1000.0), line("o5", "up", "2018-04-01", revenue=1.0),
    )
    got = {r.customer_id: r.spending_trend for r in features.trend_features(df, AS_OF).collect()}
    assert got == {"new": 1.0, "gone": -1.0, "old": 0.0, "up": 5.0}


def test_segment_truth_table(spark):
    rows = spark.createDataFrame(list(product(range(1, 6), repeat=3)), "r int, f int, m int")
    got = rows.groupBy(S.rfm_segment("r", "f", "m").alias("s")).count().collect()
    assert {r["s"]: r["count"] for r in got} == {
        "Needs Attention": 60, "Loyal Customers": 19, "Potential Loyalists": 16, "At Risk": 10,
        "Champions": 8, "High Value At Risk": 8, "Dormant": 4}


def test_boundaries_of_tier_and_action(spark):
    rows = [(p, t, g) for p in (0.0, 0.3, 0.5, 0.6, 1.0) for t in ("High Value", "Medium Value", "Low Value", None) for g in (-1.0, 1.0)]
    df = spark.createDataFrame(rows, "p double, t string, g double").select(
        "*", S.risk_tier("p").alias("tier"), S.recommended_action("t", "p", "g").alias("action"))
    got = {(r.p, r.t, r.g): (r.tier, r.action) for r in df.collect()}
    assert [got[p, "High Value", 1.0][0] for p in (0.0, 0.3, 0.6, 1.0)] == ["Low Risk", "Low Risk", "Medium Risk", "High Risk"]
    assert got[0.3, "High Value", 1.0][1].startswith("Proactive")
    assert got[0.6, "High Value", 1.0][1].startswith("Immediate")
    assert got[0.5, "Low Value", 1.0][1].startswith("Low-Cost")
    assert got[0.5, None, -1.0][1] == "Monitor — Marginal ROI"
    assert got[0.5, None, 1.0][1] == "Standard — No Specific Action"
    assert got[0.5, "Low Value", -1.0][1] == "Let Go — Negative ROI"


def test_first_matching_substring(spark):
    df = spark.createDataFrame([("health_beauty",), ("fashio_female_clothing",), (None,), ("Home_confort",)], "c string")
    got = [r[0] for r in df.select(S.first_contained("c", CFG.return_rates, 0.05)).collect()]
    assert got == [0.10, 0.05, 0.05, 0.08]


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert [r.x_norm for r in priority.normalised(df, ["x"]).collect()] == [0.5, 0.5]
    assert [r.b for r in segmentation.equal_width_scores(df, "x", "b").collect()] == [3, 3]


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(S.round_even("x", 2)).collect()][:2] == [0.12, 0.38]
    assert [r[0] for r in df.select(S.round_even("x", 0)).collect()][2:] == [2.0, -0.0]


def test_finite_or_zero(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (1.5,)], "x double")
    assert [r[0] for r in df.select(S.finite_or_zero("x")).collect()] == [0, 0, 0, 0, 1.5]


def test_line_total_is_exact(spark):
    df = spark.range(100000).select((F.lit(0.1) * (F.col("id") % 7 - 3)).alias("x"), (F.col("id") % 2).alias("g"))
    got = df.groupBy("g").agg(S.line_total("x", 4).alias("s")).orderBy("g").collect()
    want = [sum(((i % 7) - 3) for i in range(100000) if i % 2 == g) / 10 for g in (0, 1)]
    assert [r.s for r in got] == want


def scored(spark):
    rows = [(i, float(100 - i % 7), (i % 10) / 10, "Champions" if i % 2 else "Dormant",
             ["High Value", "Low Value", None][i % 3]) for i in range(60)]
    return spark.createDataFrame(rows, "customer_id long, customer_profit double, churn_prob double, rfm_segment string, value_tier string")


def test_economics_ranks_and_ties(spark):
    final = priority.prioritise(scored(spark), CFG).toPandas()
    want = final.retention_priority_score.rank(ascending=False, method="min").astype(int)
    assert (final.priority_rank == want).all()
    assert final.retention_priority_score.between(0, 100).all()
    top = priority.top_targets(priority.prioritise(scored(spark), CFG), 20).toPandas()
    assert len(top) == 20


def test_decision_matrix_keeps_empty_cells(spark):
    df = priority.prioritise(scored(spark).filter("churn_prob < 0.3"), CFG)
    got = {(r.value_tier, r.risk_tier): r for r in priority.decision_matrix(df).collect()}
    assert set(got) == {(v, r) for v in ("High Value", "Low Value") for r in ("Low Risk", "Medium Risk", "High Risk")}
    empty = got["High Value", "High Risk"]
    assert (empty.customer_count, empty.total_profit_at_risk, empty.avg_profit) == (0, 0.0, None)
    assert sum(r.customer_count for r in got.values()) == df.filter("value_tier is not null").count()


def test_sensitivity_overlap_with_itself(spark):
    df = priority.prioritise(scored(spark), CFG)
    got = {r.weights: r for r in priority.sensitivity_analysis(df, CFG).collect()}
    assert len(got) == 4 and got["Default (40/35/25)"].overlap == 20


def test_metrics_on_known_scores(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "churn int, churn_prob double")
    r = evaluation.evaluate(df).first()
    assert (r.accuracy, r.precision, r.recall) == pytest.approx((4 / 6, 2 / 3, 2 / 3))
    assert r.auc_roc == pytest.approx(6.5 / 9)
    assert r.average_precision == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)
    cube = df.withColumn("churn_prob", F.pow("churn_prob", 3))
    assert evaluation.evaluate(cube).first().auc_roc == pytest.approx(r.auc_roc)


def test_rand_index_of_equal_labels(spark):
    df = spark.createDataFrame([(i % 3, (i % 3) * 10) for i in range(30)], "a int, b int")
    assert segmentation.adjusted_rand_index(df, "a", "b").first()[0] == pytest.approx(1.0)


def test_margin_is_zero_without_net_revenue(spark):
    parts = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 5.0, 0.0, 0.0)],
        "customer_id string, net_revenue double, total_cogs double, total_discount_cost double, return_cost double, service_cost double, acquisition_cost double")
    r = profitability.profit_statement(parts).first()
    assert (r.customer_profit, r.profit_margin) == (-5.0, 0.0)


def test_labels(spark):
    df = txn(spark, line("1", "stay", "2018-01-01"), line("2", "stay", "2018-07-01", returned=1),
             line("3", "left", "2018-01-01"), line("4", "new", "2018-07-01"))
    got = {r.customer_id: r.churn for r in labels.churn_labels(df, dt.date(2018, 6, 1), AS_OF).collect()}
    assert got == {"stay": 0, "left": 1}


def test_discount_estimate(spark):
    items = spark.createDataFrame([("a", 60.0), ("a", 40.0), ("b", 10.0), ("c", 10.0), ("d", 10.0)], "order_id string, price double")
    pay = spark.createDataFrame([("a", 90.0), ("b", 12.0), ("c", 1.0)], "order_id string, payment_value double")
    got = {r.order_id: r.discount_pct for r in ingest.order_discounts(items, pay, CFG).collect()}
    assert got == {"a": 10.0, "b": 0.0, "c": 40.0, "d": 0.0}


def test_payment_mode_takes_smallest_of_ties(spark):
    pay = spark.createDataFrame(
        [("a", "voucher", 1, 5.0), ("a", "card", 3, 5.0), ("b", "card", 1, 1.0), ("b", "slip", 1, 1.0), ("b", "slip", 4, 1.0)],
        "order_id string, payment_type string, payment_installments int, payment_value double")
    got = {r.order_id: (r.total_payment, r.payment_installments, r.payment_type) for r in ingest.payment_summary(pay).collect()}
    assert got == {"a": (10.0, 2.0, "card"), "b": (3.0, 2.0, "slip")}


def test_histograms_of_several_columns(spark):
    df = spark.createDataFrame([(0.0, 5), (1.0, 5), (4.0, None), (10.0, None), (None, 5)], "a double, b int")
    got = profiling.histograms(df, [("a", 5, "a", None, None), ("b", 2, "b", None, None), ("a", 2, "cut", 0, 4)])
    rows = {(r.name, r.bin): (r.left_edge, r.n) for r in got.collect()}
    assert [rows["a", i] for i in range(5)] == [(0.0, 2), (2.0, 0), (4.0, 1), (6.0, 0), (8.0, 1)]
    assert [rows["b", i] for i in range(2)] == [(4.5, 0), (5.0, 3)]
    assert [rows["cut", i] for i in range(2)] == [(0.0, 2), (2.0, 2)]
    none = profiling.histograms(df.filter("a > 99"), [("a", 3, "a", None, None)]).collect()
    assert [(r.left_edge, r.n) for r in none] == [(None, 0)] * 3


def test_calendar(spark):
    rows = exports.date_dimension(spark, dt.date(2016, 9, 1), dt.date(2018, 9, 1)).orderBy("date").collect()
    assert len(rows) == 731
    assert (rows[-1].day_of_week, rows[-1].day_name, rows[-1].is_weekend, rows[-1].quarter_name) == (5, "Saturday", 1, "Q3")


def test_synthetic_columns_follow_their_distribution(spark):
    df = spark.range(20000).select(
        synth.age(42, "id").alias("age"), synth.gender(42, "id", CFG.genders).alias("g"),
        synth.poisson(synth.uniform(42, "p", "id"), 3.0).alias("p"),
        synth.support_tickets(42, "id", F.lit(20)).alias("t"))
    r = df.agg(F.avg("age"), F.avg((F.col("g") == "M").cast("int")), F.avg("p"), F.variance("p"), F.avg("t")).first()
    assert r[0] == pytest.approx(34.7, abs=0.5)
    assert r[1] == pytest.approx(0.48, abs=0.02)
    assert r[2] == pytest.approx(3, abs=0.06) and r[3] == pytest.approx(3, abs=0.15)
    assert r[4] == pytest.approx(2, abs=0.06)


def test_shuffles_carry_no_column_that_follows_from_the_price(spark):
    """Revenue and cost are made of the price after the joins of the lines."""
    cfg = Settings()
    raw = {
        "customers": spark.createDataFrame([(1,)], "customer_id long"),
        "orders": spark.createDataFrame([(1, 1, cfg.order_statuses[0], "2018-01-02")], "order_id long, customer_id long, order_status string, order_purchase_timestamp string"),
        "order_items": spark.createDataFrame([(1, 7, 10.0, 1.0, 0), (1, 8, None, 1.0, 1)], "order_id long, product_id long, price double, freight_value double, is_return int"),
        "payments": spark.createDataFrame([(1, 9.0)], "order_id long, payment_value double"),
        "products": spark.createDataFrame([(7, "a")], "product_id long, product_category_name string"),
        "category_translation": spark.createDataFrame([("a", "toys")], "product_category_name string, product_category_name_english string"),
    }
    txn = ingest.transactions(raw, cfg)
    rows = {r["product_id"]: r for r in txn.collect()}
    assert rows["P_7"]["revenue"] == 10.0 and abs(rows["P_7"]["cost_of_goods"] - 10.0 * cfg.cogs_share) < 1e-12
    assert rows["P_8"]["revenue"] is None and rows["P_8"]["cost_of_goods"] is None
    plan = txn._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]
    assert "cost_of_goods" in plan[: plan.index("Join")] and "cost_of_goods" not in below and "revenue" not in below
