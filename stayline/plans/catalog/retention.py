"""Churn labels, metrics on given probabilities, priority score and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions import scalars as S
from stayline.operators import evaluation, labels, priority, segmentation
from stayline.plans.catalog.base import Tables, query
from stayline.plans.catalog.sql import ACTION_CASE, RISK_CASE, even, u, units

# -- labels and matrix --------------------------------------------------------


@query("churn_labels", "customer_id:i churn:i", "SELECT * FROM lab")
def _(t: Tables):
    return t.labels


@query("churn_membership", "customer_id:i churn:i", "SELECT * FROM lab")
def _(t: Tables):
    """Label by membership in the prediction window, from one grouping."""
    return t.labels


@query(
    "churn_rate", "churn_rate:f churned:i customers:i",
    "SELECT avg(churn) AS churn_rate, sum(churn) AS churned, count(*) AS customers FROM lab",
)
def _(t: Tables):
    return labels.churn_rate(t.labels)


@query(
    "labelled_customers", "customer_id:i recency_days:i churn:i",
    "SELECT f.customer_id, recency_days, churn FROM feat f JOIN lab l ON f.customer_id = l.customer_id",
)
def _(t: Tables):
    return labels.labelled(t.features, t.labels)


@query(
    "attach_actual_label", "customer_id:i churn_actual:i",
    "SELECT f.customer_id, churn AS churn_actual FROM feat f LEFT JOIN lab l ON f.customer_id = l.customer_id",
)
def _(t: Tables):
    return labels.with_actual_label(t.features, t.labels)


@query(
    "feature_matrix", "customer_id:i churn:i " + " ".join(f"{c}:f3" for c in labels.MODEL_FEATURES),
    "SELECT f.*, churn FROM feat f JOIN lab l ON f.customer_id = l.customer_id",
)
def _(t: Tables):
    return labels.feature_matrix(labels.labelled(t.features, t.labels))


@query(
    "stratified_split", "customer_id:i churn:i is_train:i",
    f"""SELECT customer_id, churn, CASE WHEN rn <= floor(0.8 * n + 0.5) THEN 1 ELSE 0 END AS is_train FROM (
        SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY {u('split', 'customer_id')}, customer_id) AS rn,
               count(*) OVER (PARTITION BY churn) AS n FROM lab)""",
)
def _(t: Tables):
    return labels.stratified_split(t.labels, t.cfg)


@query(
    "class_weights", "churn:i n:i balanced_weight:f neg_pos_ratio:f",
    """SELECT churn, count(*) AS n, (SELECT count(*) FROM lab) / (2.0 * count(*)) AS balanced_weight,
              (SELECT sum(1 - churn) / CAST(sum(churn) AS DOUBLE) FROM lab) AS neg_pos_ratio FROM lab GROUP BY 1""",
)
def _(t: Tables):
    return labels.class_weights(t.labels)


# -- metrics --------------------------------------------------------------------

_COUNTS = """SELECT count(*) FILTER (churn = 1 AND churn_prob >= 0.5) * 1.0 AS tp, count(*) FILTER (churn = 0 AND churn_prob >= 0.5) * 1.0 AS fp,
   count(*) FILTER (churn = 1 AND churn_prob < 0.5) * 1.0 AS fn, count(*) FILTER (churn = 0 AND churn_prob < 0.5) * 1.0 AS tn FROM tscore"""
_METRICS = f"""SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fp) AS "precision", tp / (tp + fn) AS recall,
   2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS f1 FROM ({_COUNTS})"""
_AUC = """SELECT (sum(r) FILTER (churn = 1) - p * (p + 1) / 2.0) / (p * n) AS auc_roc FROM (
   SELECT churn, rank() OVER (ORDER BY churn_prob) + (count(*) OVER (PARTITION BY churn_prob) - 1) / 2.0 AS r,
          sum(churn) OVER () AS p, sum(1 - churn) OVER () AS n FROM tscore) GROUP BY p, n"""
_AP = """SELECT sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / sum(pos) AS average_precision FROM curve"""


@query(
    "classification_metrics", "accuracy:f prec:f recall:f f1:f",
    f"""SELECT accuracy, "precision" AS prec, recall, f1 FROM ({_METRICS})""",
)
def _(t: Tables):
    return evaluation.classification_metrics(t.test_scores).withColumnRenamed("precision", "prec")


@query(
    "confusion_matrix", "actual:i predicted:i n:i",
    """SELECT a AS actual, p AS predicted, count(churn) AS n FROM range(0, 2) x(a) CROSS JOIN range(0, 2) y(p)
       LEFT JOIN tscore ON churn = a AND CASE WHEN churn_prob >= 0.5 THEN 1 ELSE 0 END = p GROUP BY 1, 2""",
)
def _(t: Tables):
    return evaluation.confusion_matrix(t.test_scores)


@query("auc_roc", "auc_roc:f", _AUC)
def _(t: Tables):
    return evaluation.auc_roc(evaluation.score_curve(t.test_scores))


@query("average_precision", "average_precision:f", _AP)
def _(t: Tables):
    return evaluation.average_precision(evaluation.score_curve(t.test_scores))


@query(
    "roc_points", "threshold:f fpr:f tpr:f",
    """SELECT threshold, fp / CAST((SELECT sum(neg) FROM curve) AS DOUBLE) AS fpr,
              tp / CAST((SELECT sum(pos) FROM curve) AS DOUBLE) AS tpr FROM curve""",
)
def _(t: Tables):
    return evaluation.roc_points(evaluation.score_curve(t.test_scores))


@query(
    "pr_points", "threshold:f prec:f recall:f",
    """SELECT threshold, tp / CAST(tp + fp AS DOUBLE) AS prec, tp / CAST((SELECT sum(pos) FROM curve) AS DOUBLE) AS recall FROM curve""",
)
def _(t: Tables):
    return evaluation.pr_points(evaluation.score_curve(t.test_scores)).withColumnRenamed("precision", "prec")


@query(
    "evaluate_models", "model:s accuracy:f prec:f recall:f f1:f auc_roc:f average_precision:f",
    f"""SELECT 'formula' AS model, accuracy, "precision" AS prec, recall, f1, ({_AUC}) AS auc_roc, ({_AP}) AS average_precision FROM ({_METRICS})""",
)
def _(t: Tables):
    return evaluation.evaluate(t.test_scores, model="formula").withColumnRenamed("precision", "prec")


@query(
    "adjusted_rand_index", "adjusted_rand_index:f",
    """WITH cells AS (SELECT rfm_segment AS a, value_tier AS b, count(*) AS n FROM seg_prof WHERE value_tier IS NOT NULL GROUP BY 1, 2),
       s AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM cells) AS both_,
                    (SELECT sum(m * (m - 1) / 2.0) FROM (SELECT sum(n) AS m FROM cells GROUP BY a)) AS ra,
                    (SELECT sum(m * (m - 1) / 2.0) FROM (SELECT sum(n) AS m FROM cells GROUP BY b)) AS rb,
                    (SELECT sum(n) * (sum(n) - 1) / 2.0 FROM cells) AS al)
       SELECT (both_ - ra * CAST(rb AS DOUBLE) / al) / ((ra + rb) / 2 - ra * CAST(rb AS DOUBLE) / al) AS adjusted_rand_index FROM s""",
)
def _(t: Tables):
    known = t.profitable.filter(F.col("value_tier").isNotNull())
    return segmentation.adjusted_rand_index(known, "rfm_segment", "value_tier")


@query(
    "compare_segmentations", "rfm_segment:s value_tier:s customers:i",
    """SELECT CASE WHEN grouping(rfm_segment) = 1 THEN 'Total' ELSE rfm_segment END AS rfm_segment,
              CASE WHEN grouping(value_tier) = 1 THEN 'Total' ELSE value_tier END AS value_tier, count(*) AS customers
       FROM (SELECT rfm_segment, value_tier FROM seg_prof WHERE value_tier IS NOT NULL) GROUP BY CUBE (rfm_segment, value_tier)""",
)
def _(t: Tables):
    known = t.profitable.filter(F.col("value_tier").isNotNull())
    return segmentation.compare(known, "rfm_segment", "value_tier")[0]


# -- score, rank, action ------------------------------------------------------------

ECONOMICS = (
    "customer_id:i intervention_cost:f success_prob:f expected_retention_value:f expected_net_benefit:f "
    "retention_priority_score:f priority_rank:i recommended_action:s"
)


@query("retention_economics", ECONOMICS, "SELECT * FROM fin")
def _(t: Tables):
    base = priority.success_probability(
        priority.intervention_cost(t.scored.fillna(0, subset=["customer_profit"]), t.cfg), t.cfg)
    return priority.retention_economics(base, t.cfg.priority_weights)


@query("retention_pipeline", ECONOMICS + " risk_tier:s value_tier:s", "SELECT * FROM fin")
def _(t: Tables):
    return priority.prioritise(t.scored, t.cfg)


@query("fn_expected_retention_value", "customer_id:i expected_retention_value:f", "SELECT * FROM val")
def _(t: Tables):
    return priority.expected_values(
        t.final.select("customer_id", "customer_profit", "churn_prob", "success_prob", "intervention_cost"))


@query("fn_expected_net_benefit", "customer_id:i expected_net_benefit:f", "SELECT * FROM val")
def _(t: Tables):
    return priority.expected_values(
        t.final.select("customer_id", "customer_profit", "churn_prob", "success_prob", "intervention_cost"))


@query(
    "min_max_normalise", "customer_id:i customer_profit_norm:f churn_prob_norm:f expected_net_benefit_norm:f",
    """SELECT customer_id, n_profit AS customer_profit_norm, n_churn AS churn_prob_norm,
              n_benefit AS expected_net_benefit_norm FROM norm""",
)
def _(t: Tables):
    return priority.normalised(t.final)


@query("fn_priority_score", "customer_id:i retention_priority_score:f", "SELECT * FROM fin")
def _(t: Tables):
    scored = priority.normalised(t.final.drop("retention_priority_score"))
    return scored.withColumn(
        "retention_priority_score", S.round_even(priority.weighted_score(t.cfg.priority_weights), 1))


@query("priority_rank", "customer_id:i retention_priority_score:f priority_rank:i", "SELECT * FROM fin")
def _(t: Tables):
    return priority.priority_rank(t.final.drop("priority_rank"))


@query(
    "fn_case_action", "customer_id:i action:s", f"SELECT customer_id, {ACTION_CASE} AS action FROM fin",
)
def _(t: Tables):
    return t.final.select(
        "customer_id", S.recommended_action("value_tier", "churn_prob", "expected_net_benefit").alias("action"))


@query("fn_case_risk_tier", "customer_id:i tier:s", f"SELECT customer_id, {RISK_CASE} AS tier FROM fin")
def _(t: Tables):
    return t.final.select("customer_id", S.risk_tier("churn_prob").alias("tier"))


@query(
    "fn_predicted_flag", "customer_id:i churn_predicted:i",
    "SELECT customer_id, CASE WHEN churn_prob >= 0.5 THEN 1 ELSE 0 END AS churn_predicted FROM chur",
)
def _(t: Tables):
    return t.scored.select("customer_id", S.predicted_flag("churn_prob").alias("churn_predicted"))


@query(
    "fn_band_colour", "customer_id:i churn_band:s risk_band:s margin_band:s score_band:s rank_icon:s",
    """SELECT customer_id,
        CASE WHEN churn_prob >= 0.7 THEN 'red' WHEN churn_prob >= 0.5 THEN 'orange' ELSE 'green' END AS churn_band,
        CASE WHEN churn_prob < 0.3 THEN 'green' WHEN churn_prob < 0.6 THEN 'amber' ELSE 'red' END AS risk_band,
        CASE WHEN profit_margin < 0 THEN 'red' WHEN profit_margin <= 0.15 THEN 'amber' ELSE 'green' END AS margin_band,
        CASE WHEN retention_priority_score < 33 THEN 'gray' WHEN retention_priority_score < 66 THEN 'amber' ELSE 'red' END AS score_band,
        CASE WHEN priority_rank <= 20 THEN 'red' WHEN priority_rank <= 50 THEN 'yellow' ELSE 'green' END AS rank_icon FROM fin""",
)
def _(t: Tables):
    return t.final.select(
        "customer_id", S.churn_band("churn_prob").alias("churn_band"), S.risk_band("churn_prob").alias("risk_band"),
        S.margin_band("profit_margin").alias("margin_band"),
        S.score_band("retention_priority_score").alias("score_band"), S.rank_icon("priority_rank").alias("rank_icon"))


# -- reports -----------------------------------------------------------------------


@query(
    "top_targets_20",
    "priority_rank:i customer_id:i customer_profit:f churn_prob:f expected_retention_value:f intervention_cost:f "
    "expected_net_benefit:f retention_priority_score:f rfm_segment:s value_tier:s recommended_action:s",
    f"""SELECT * REPLACE ({even('customer_profit', 0)} AS customer_profit, {even('churn_prob', 2)} AS churn_prob,
          {even('expected_retention_value', 0)} AS expected_retention_value, {even('expected_net_benefit', 0)} AS expected_net_benefit)
        FROM (SELECT * FROM fin ORDER BY priority_rank, customer_id LIMIT 20)""",
)
def _(t: Tables):
    return priority.top_targets(t.final, 20)


@query(
    "top_alerts_10", "customer_id:i customer_profit:f churn_prob:f retention_priority_score:f recommended_action:s",
    "SELECT * FROM fin ORDER BY retention_priority_score DESC, customer_id LIMIT 10",
)
def _(t: Tables):
    return priority.top_alerts(t.final, 10)


@query(
    "high_value_at_risk_20", "customer_id:i customer_profit:f churn_prob:f recommended_action:s",
    """SELECT * FROM fin WHERE value_tier = 'High Value' AND churn_prob >= 0.5
       ORDER BY customer_profit DESC, customer_id LIMIT 20""",
)
def _(t: Tables):
    return priority.high_value_at_risk(t.final, 20)


@query(
    "highest_risk_segment", "rfm_segment:s avg_churn_prob:f",
    "SELECT rfm_segment, avgx(churn_prob) AS avg_churn_prob FROM fin GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
def _(t: Tables):
    return priority.highest_risk_segment(t.final)


@query(
    "decision_matrix",
    "value_tier:s risk_tier:s customer_count:i avg_profit:f avg_churn_prob:f total_profit_at_risk:f avg_priority:f",
    f"""SELECT v.value_tier, r.risk_tier, count(f.customer_id) AS customer_count, {even('avgx(customer_profit)', 0)} AS avg_profit,
          {even('avgx(churn_prob)', 2)} AS avg_churn_prob, {even('coalesce(' + units('expected_retention_value') + ', 0)', 0)} AS total_profit_at_risk,
          {even('avgx(retention_priority_score)', 1)} AS avg_priority
        FROM (SELECT DISTINCT value_tier FROM fin WHERE value_tier IS NOT NULL) v
        CROSS JOIN (SELECT unnest(['Low Risk', 'Medium Risk', 'High Risk']) AS risk_tier) r
        LEFT JOIN fin f ON f.value_tier = v.value_tier AND f.risk_tier = r.risk_tier GROUP BY 1, 2""",
)
def _(t: Tables):
    return priority.decision_matrix(t.final)


@query(
    "decision_pivot",
    "value_tier:s low_risk:i medium_risk:i high_risk:i low_risk_benefit:f3 medium_risk_benefit:f3 high_risk_benefit:f3",
    """SELECT value_tier, count(*) FILTER (risk_tier = 'Low Risk') AS low_risk, count(*) FILTER (risk_tier = 'Medium Risk') AS medium_risk,
          count(*) FILTER (risk_tier = 'High Risk') AS high_risk, avg(expected_net_benefit) FILTER (risk_tier = 'Low Risk') AS low_risk_benefit,
          avg(expected_net_benefit) FILTER (risk_tier = 'Medium Risk') AS medium_risk_benefit,
          avg(expected_net_benefit) FILTER (risk_tier = 'High Risk') AS high_risk_benefit
       FROM fin WHERE value_tier IS NOT NULL GROUP BY 1""",
)
def _(t: Tables):
    return priority.decision_pivot(t.final)


_GAIN = "FILTER (expected_net_benefit > 0)"


def _gaining(c: str) -> str:
    return units(f"CASE WHEN expected_net_benefit > 0 THEN {c} ELSE 0 END")


@query(
    "retention_summary",
    "total_erv:f3 budget:f net_benefit:f3 positive_roi:i negative_roi:i customers:i positive_share:f roi_pct:f4",
    f"""SELECT {units('expected_retention_value')} AS total_erv, {_gaining('intervention_cost')} AS budget,
          {_gaining('expected_net_benefit')} AS net_benefit, count(*) {_GAIN} AS positive_roi,
          count(*) FILTER (expected_net_benefit <= 0) AS negative_roi, count(*) AS customers,
          count(*) {_GAIN} / CAST(count(*) AS DOUBLE) AS positive_share,
          {_gaining('expected_net_benefit')} / {_gaining('intervention_cost')} * 100 AS roi_pct FROM fin""",
)
def _(t: Tables):
    return priority.retention_summary(t.final)


@query(
    "filter_positive_roi", "customer_id:i side:s expected_net_benefit:f",
    """SELECT customer_id, CASE WHEN expected_net_benefit > 0 THEN 'positive' ELSE 'negative' END AS side,
              expected_net_benefit FROM fin""",
)
def _(t: Tables):
    up, down = priority.split_by_roi(t.final)
    return up.withColumn("side", F.lit("positive")).unionByName(down.withColumn("side", F.lit("negative")))


@query(
    "action_distribution", "recommended_action:s customers:i",
    "SELECT recommended_action, count(*) AS customers FROM fin GROUP BY 1",
)
def _(t: Tables):
    return priority.action_distribution(t.final)


@query(
    "segment_net_benefit", "rfm_segment:s avg_net_benefit:f3",
    "SELECT rfm_segment, avgx(expected_net_benefit) AS avg_net_benefit FROM fin GROUP BY 1",
)
def _(t: Tables):
    return priority.segment_net_benefit(t.final)


@query(
    "segment_churn", "rfm_segment:s avg_churn_prob:f predicted_rate:f",
    "SELECT rfm_segment, avgx(churn_prob) AS avg_churn_prob, avg(churn_predicted) AS predicted_rate FROM fin GROUP BY 1",
)
def _(t: Tables):
    return priority.segment_churn(t.final)


@query(
    "sensitivity_analysis", "weights:s avg_score:f4 overlap:i overlap_share:f",
    """SELECT s.weights, avg_score, overlap, overlap / 20.0 AS overlap_share FROM
       (SELECT weights, avg(score) AS avg_score FROM wscores GROUP BY 1) s JOIN
       (SELECT a.weights, count(b.customer_id) AS overlap FROM wtop a LEFT JOIN
          (SELECT customer_id FROM wtop WHERE weights = 'Default (40/35/25)') b ON a.customer_id = b.customer_id GROUP BY 1) o
       ON s.weights = o.weights""",
)
def _(t: Tables):
    return priority.sensitivity_analysis(t.final, t.cfg)


@query(
    "topk_overlap", "weights:s overlap:i overlap_share:f",
    """SELECT a.weights, count(b.customer_id) AS overlap, count(b.customer_id) / 20.0 AS overlap_share FROM wtop a LEFT JOIN
       (SELECT customer_id FROM wtop WHERE weights = 'Default (40/35/25)') b ON a.customer_id = b.customer_id
       WHERE a.weights <> 'Default (40/35/25)' GROUP BY 1""",
)
def _(t: Tables):
    return priority.topk_overlap(priority.scores_by_weights(t.final, t.cfg), t.cfg)
