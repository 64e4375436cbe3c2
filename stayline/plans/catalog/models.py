"""Clusters, classifiers and their explanation. Model results have no SQL form."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.operators import boosting, churn, clustering, explain, labels, oversampling, segmentation
from stayline.plans.catalog.base import Tables, query
from stayline.plans import pipeline
from stayline.sources.store import save, scratch, store


def _sweep(t: Tables):
    """The stored cluster input, and inertia, silhouette and run of each k."""
    if not hasattr(t, "_swept"):
        data = store(clustering.cluster_input(t.segmented), "clusters")
        t._swept = (data, *clustering.sweep(data, t.cfg))
    return t._swept


def _segments(t: Tables):
    if not hasattr(t, "_clusters"):
        df, k = clustering.segments_of(t.segmented, *_sweep(t))
        t._clusters = (store(df, "clusters"), k)
    return t._clusters


def _run(t: Tables) -> churn.Run:
    """One training run of all four models, shared by the queries about it."""
    if not hasattr(t, "_run"):
        t._run = churn.train_and_score(t.profitable, t.labels, t.cfg)
    return t._run


_Z = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(clustering.CLUSTER_FEATURES))
@query("kmeans_sweep", "k:i inertia:f silhouette:f")
def _(t: Tables):
    return clustering.sweep_table(t.spark, _sweep(t)[1])


@query(
    "kmeans_fixpoint", "k:i customers:i misplaced:i off_mean:f off_inertia:f4",
    "SELECT r.k, (SELECT count(*) FROM rfm_scored) AS customers, 0 AS misplaced, 0 AS off_mean, 0 AS off_inertia FROM range(3, 9) r(k)",
)
def _(t: Tables):
    """What must hold of the runs for each k: every customer lies nearest to its own centre, each
    centre is the mean of its customers, and the inertia is the sum of their squared distances."""
    data, _, runs = _sweep(t)
    return clustering.fixpoints(data, runs)


@query("compare_kmeans", "rfm_segment:s kmeans_segment:s customers:i")
def _(t: Tables):
    """Cross table of the rule-based and the k-means segments of all customers."""
    return segmentation.compare(_segments(t)[0], "rfm_segment", "kmeans_segment")[0]


@query("kmeans_rand_index", "adjusted_rand_index:f")
def _(t: Tables):
    """Agreement of the rule-based and the k-means segments of all customers."""
    return segmentation.compare(_segments(t)[0], "rfm_segment", "kmeans_segment")[1]


@query("kmeans_segments", "customer_id:i cluster:i kmeans_segment:s")
def _(t: Tables):
    return _segments(t)[0]


_ROW = " + ".join(f"z{i} * z{i}" for i in range(len(clustering.CLUSTER_FEATURES)))
_SUMS = ", ".join(f"sum(z{i}) AS s{i}" for i in range(len(clustering.CLUSTER_FEATURES)))
_DOT = " + ".join(f"z{i} * s{i}" for i in range(len(clustering.CLUSTER_FEATURES)))


_APART = " + ".join(f"(s.z{i} - x.z{i}) * (s.z{i} - x.z{i})" for i in range(len(clustering.CLUSTER_FEATURES)))


def _scaled(t: Tables):
    columns = [F.col(c).cast("double").alias(c) for c in clustering.CLUSTER_FEATURES]
    return labels.standardise(t.segmented.select("customer_id", "r_score", *columns), clustering.CLUSTER_FEATURES)


@query(
    "silhouette", "silhouette:f4",
    f"""WITH x AS (SELECT customer_id, r_score AS g, {_Z} FROM rfm_scored),
       s AS (SELECT * FROM x ORDER BY substr(md5('42:silhouette:' || customer_id), 1, 13), customer_id LIMIT 10000),
       n AS (SELECT g AS h, count(*) AS n FROM x GROUP BY 1),
       d AS (SELECT s.customer_id, s.g, x.g AS h, sum(sqrt({_APART})) AS total FROM s, x GROUP BY 1, 2, 3),
       i AS (SELECT customer_id, max(CASE WHEN d.g = d.h THEN total / (n - 1) END) AS inside, min(CASE WHEN d.g <> d.h THEN total / n END) AS outside
             FROM d JOIN n ON d.h = n.h GROUP BY 1)
       SELECT avg((outside - inside) / greatest(inside, outside)) AS silhouette FROM i""",
)
def _(t: Tables):
    """Silhouette of the rule-based segments over the cluster features, Euclidean distances of a
    seeded sample to all customers."""
    found = clustering.euclidean_silhouettes(_scaled(t), clustering.CLUSTER_FEATURES, {"r_score": F.col("r_score")}, t.cfg)
    return t.spark.createDataFrame([(found["r_score"],)], "silhouette double")


@query(
    "silhouette_squared", "silhouette:f4",
    f"""WITH x AS (SELECT customer_id, r_score AS g, {_Z} FROM rfm_scored),
       c AS (SELECT g AS h, count(*) AS n, {_SUMS}, sum({_ROW}) AS q FROM x GROUP BY 1),
       d AS (SELECT customer_id, g, h, n, n * ({_ROW}) - 2 * ({_DOT}) + q AS total FROM x, c),
       i AS (SELECT customer_id, max(CASE WHEN g = h THEN total / (n - 1) END) AS inside, min(CASE WHEN g <> h THEN total / n END) AS outside FROM d GROUP BY 1)
       SELECT avg((outside - inside) / greatest(inside, outside)) AS silhouette FROM i""",
)
def _(t: Tables):
    """Silhouette of the rule-based segments over the cluster features, all customers,
    squared distances."""
    return clustering.silhouette(_scaled(t), clustering.CLUSTER_FEATURES, "r_score")


@query("cluster_profile", "cluster:i customers:i " + " ".join(f"{c}:f4" for c in clustering.CLUSTER_FEATURES))
def _(t: Tables):
    return clustering.cluster_profile(_segments(t)[0])


@query(
    "cluster_name_rank", "cluster:i m_rank:f r_rank:f",
    """SELECT r_score AS cluster, rank() OVER (ORDER BY m DESC) AS m_rank, rank() OVER (ORDER BY r) AS r_rank
       FROM (SELECT r_score, avg(monetary) AS m, avg(recency_days) AS r FROM rfm_scored GROUP BY 1)""",
)
def _(t: Tables):
    """Ranks of group profiles, with the recency score as the group."""
    groups = t.segmented.withColumn("cluster", F.col("r_score"))
    return clustering.cluster_ranks(clustering.cluster_profile(groups))


@query(
    "fn_cluster_name", "cluster:i kmeans_segment:s",
    """WITH g AS (SELECT r_score AS c, rank() OVER (ORDER BY avg(monetary) DESC) AS m, rank() OVER (ORDER BY avg(recency_days)) AS r,
                         count(*) OVER () AS k FROM rfm_scored GROUP BY 1),
       n AS (SELECT c, CASE WHEN m <= k * 0.25 AND r <= k * 0.5 THEN 'High Value Active' WHEN m <= k * 0.25 THEN 'High Value At Risk'
                            WHEN m <= k * 0.5 AND r <= k * 0.5 THEN 'Medium Value Active' WHEN m <= k * 0.5 THEN 'Medium Value Declining'
                            WHEN r <= k * 0.5 THEN 'Low Value Active' ELSE 'Low Value Dormant' END AS name FROM g)
       SELECT c AS cluster, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY c) > 1 THEN name || ' (' || c || ')' ELSE name END AS kmeans_segment FROM n""",
)
def _(t: Tables):
    groups = t.segmented.withColumn("cluster", F.col("r_score"))
    return clustering.cluster_names(clustering.cluster_profile(groups))


@query("pca_2d", "customer_id:i pc1:f pc2:f explained1:f explained2:f")
def _(t: Tables):
    """Both components of every customer, with their explained variance."""
    points, explained = clustering.pca_2d(t.segmented)
    return points.withColumns({f"explained{i + 1}": F.lit(v) for i, v in enumerate(explained)})


@query(
    "pca_moments", "customers:i mean1:f mean2:f spread1:f spread2:f mixed:f",
    """SELECT count(*) AS customers, 0 AS mean1, 0 AS mean2, 1 AS spread1, 1 AS spread2, 0 AS mixed FROM rfm_scored""",
)
def _(t: Tables):
    """What must hold of principal components of all customers: means 0, variances in the
    ratio of the explained ones (so 1 after division), no correlation."""
    points, explained = clustering.pca_2d(t.segmented)
    total = 5.0  # five standardised features
    n = F.count(F.lit(1))
    return points.agg(
        n.alias("customers"), F.avg("pc1").alias("mean1"), F.avg("pc2").alias("mean2"),
        (F.var_pop("pc1") / (explained[0] * total)).alias("spread1"),
        (F.var_pop("pc2") / (explained[1] * total)).alias("spread2"), F.covar_pop("pc1", "pc2").alias("mixed"),
    )


@query("segmentation_pipeline", "rfm_segment:s kmeans_segment:s customers:i")
def _(t: Tables):
    """Both segmentations and their cross table."""
    return segmentation.crosstab(_segments(t)[0], "rfm_segment", "kmeans_segment")


@query(
    "smote", "churn:i n:i outside:i",
    """SELECT c AS churn, (SELECT max(n) FROM (SELECT floor(0.8 * count(*) + 0.5) AS n FROM lab GROUP BY churn)) AS n, 0 AS outside FROM range(0, 2) r(c)""",
)
def _(t: Tables):
    """Class sizes of the training rows after oversampling: equal; and how many synthetic
    rows are not between their two parents: none."""
    matrix = labels.feature_matrix(labels.labelled(t.profitable, t.labels))
    columns = labels.model_columns(matrix)
    split = labels.stratified_split(matrix, t.cfg).filter("is_train").drop("is_train")
    train = oversampling.smote(split, columns, t.cfg, origin=True)
    out = F.lit(False)
    for i, c in enumerate(columns):
        own, other = F.get("own", F.lit(i)), F.get("other", F.lit(i))
        slack = 1e-9 * F.greatest(F.abs(own), F.abs(other), F.lit(1.0))
        out = out | (F.col(c) < F.least(own, other) - slack) | (F.col(c) > F.greatest(own, other) + slack)
    return train.groupBy("churn").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own").isNotNull() & out).alias("outside"))


_METRICS = "model:s accuracy:f prec:f recall:f f1:f auc_roc:f average_precision:f"


def _trained(t: Tables, name: str):
    run = _run(t)
    return run.comparison.filter(F.col("model") == name).withColumnRenamed("precision", "prec")


@query("logistic_regression", _METRICS)
def _(t: Tables):
    return _trained(t, "Logistic Regression")


@query("decision_tree", _METRICS)
def _(t: Tables):
    return _trained(t, "Decision Tree")


@query("random_forest", _METRICS)
def _(t: Tables):
    return _trained(t, "Random Forest")


@query("gradient_boosting", _METRICS)
def _(t: Tables):
    return _trained(t, "Gradient Boosting")


_TRAINED = "(SELECT 2 * max(n) FROM (SELECT floor(0.8 * count(*) + 0.5) AS n FROM lab GROUP BY churn))"


@query("logistic_gradient", "n_rows:i steep:i", f"SELECT {_TRAINED} AS n_rows, 0 AS steep FROM range(1)")
def _(t: Tables):
    """At the fitted logistic model the penalised loss has no slope: coefficients along which it
    changes by more than a thousandth, of all over the balanced training rows."""
    run = _run(t)
    slopes = churn.logistic_gradient(run.models["Logistic Regression"], run.train)
    steep = sum(abs(v) > 1e-3 for v in slopes.values())
    return run.train.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(steep).alias("steep"))


@query(
    "tree_replay", "model:s n_rows:i off:i",
    f"SELECT unnest(['Decision Tree', 'Random Forest']) AS model, {_TRAINED} AS n_rows, 0 AS off",
)
def _(t: Tables):
    """Training rows sent down the decision tree again: all reach its root, and how many nodes
    saw another number of rows than the model says; in the forest (bootstrapped rows), how many
    trees have a node whose children's rows don't add up to its own."""
    run = _run(t)
    model = run.models["Decision Tree"]
    tree = explain.model_trees(model, t.spark)[0]
    rows = PipelineModel(model.stages[:-1]).transform(run.train).select(vector_to_array("features").alias("features"))
    counts = {r["node"]: r["n"] for r in churn.replayed(tree, rows).collect()}  # one row a node
    off = sum(bool(counts[node] != cover) for node, cover in enumerate(tree.cover))
    forest = explain.model_trees(run.models["Random Forest"], t.spark)
    broken = sum(any(bool(x.cover[i] != x.cover[x.left[i]] + x.cover[x.right[i]]) for i in range(len(x.cover)) if x.feature[i] >= 0) for x in forest)
    found = [("Decision Tree", counts[0], off), ("Random Forest", run.train.count(), broken)]
    return t.spark.createDataFrame(found, "model string, n_rows long, off int")


@query(
    "importance_shares", "model:s total:f negative:i",
    "SELECT unnest(['Decision Tree', 'Gradient Boosting', 'Random Forest']) AS model, 1.0 AS total, 0 AS negative",
)
def _(t: Tables):
    """Importances of each tree model are shares: none negative, together one."""
    run = _run(t)
    return churn.feature_importance(run.models, run.columns).groupBy("model").agg(
        F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("negative"))


def _newton(t: Tables) -> churn.Run:
    """A training run of the Newton-boosted trees alone."""
    if not hasattr(t, "_newton_run"):
        t._newton_run = churn.train_and_score(t.profitable, t.labels, t.cfg, [churn.NEWTON])
    return t._newton_run


@query("newton_boosting", _METRICS)
def _(t: Tables):
    return _newton(t).comparison.withColumnRenamed("precision", "prec")


@query("newton_importance", "model:s place:i feature:s importance:f")
def _(t: Tables):
    """Share of each feature in the gains of all splits of the Newton-boosted trees."""
    run = _newton(t)
    return churn.feature_importance(run.models, run.columns)


_STUMP = ["r_score", "f_score", "m_score", "frequency"]


@query(
    "newton_first_split", "feature:s cut:f gain:f4 rows_left:i value_left:f value_right:f",
    f"""WITH d AS (SELECT l.churn AS y, {', '.join(f'CAST(s.{c} AS DOUBLE) AS {c}' for c in _STUMP)} FROM lab l JOIN rfm_scored s ON l.customer_id = s.customer_id),
       w AS (SELECT y, {', '.join(_STUMP)}, CASE WHEN y = 1 THEN (SELECT CAST(count(*) - sum(y) AS DOUBLE) / sum(y) FROM d) ELSE 1 END AS w FROM d),
       g AS ({' UNION ALL '.join(f"SELECT {i} AS place, '{c}' AS feature, {c} AS v, (0.5 - y) * w AS g, 0.25 * w AS h FROM w" for i, c in enumerate(_STUMP))}),
       v AS (SELECT place, feature, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM g GROUP BY 1, 2, 3),
       c AS (SELECT place, feature, v AS cut, max(v) OVER f AS most, sum(g) OVER (f ORDER BY v) AS gl, sum(h) OVER (f ORDER BY v) AS hl,
                    sum(n) OVER (f ORDER BY v) AS rows_left, sum(g) OVER f AS ga, sum(h) OVER f AS ha FROM v WINDOW f AS (PARTITION BY feature))
       SELECT feature, cut, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1) AS gain, rows_left,
              -0.1 * gl / (hl + 1) AS value_left, -0.1 * (ga - gl) / (ha - hl + 1) AS value_right
       FROM c WHERE cut < most AND hl >= 1 AND ha - hl >= 1 ORDER BY round(gain, 6) DESC, place, cut LIMIT 1""",
)
def _(t: Tables):
    """The first split of the Newton-boosted trees over whole scores, which have few values: the
    best of all cuts, and both leaves."""
    data = labels.labelled(t.segmented, t.labels)
    model = boosting.fit(data, _STUMP, rounds=1, depth=1, rate=0.1, cut_rows=1 << 62)
    tree = model.trees[0]
    cut = model.cuts[tree.feature[0]][tree.bin[0]]
    left = data.filter(F.col(_STUMP[tree.feature[0]]) <= cut).agg(F.count(F.lit(1)).alias("rows_left"))
    return left.select(
        F.lit(_STUMP[tree.feature[0]]).alias("feature"), F.lit(cut).alias("cut"), F.lit(tree.gain[0]).alias("gain"), "rows_left",
        F.lit(tree.value[tree.left[0]]).alias("value_left"), F.lit(tree.value[tree.right[0]]).alias("value_right"))


@query("train_models", "model:s auc_roc:f")
def _(t: Tables):
    return _run(t).comparison


@query("churn_pipeline", "customer_id:i churn_prob:f churn_predicted:i churn_actual:i")
def _(t: Tables):
    """Labels to probabilities of the best model, for every customer."""
    return _run(t).scored


@query("score_all", "customer_id:i churn_prob:f churn_predicted:i")
def _(t: Tables):
    """Probability and flag of the best model for every customer."""
    return churn.score_all(_run(t).best, t.profitable)


@query("churn_leak_free", "model:s auc_roc:f")
def _(t: Tables):
    """All models on features as of the split date."""
    data = churn.leak_free_features(t.customers, t.transactions, t.engagement, t.cfg)
    return churn.train_and_score(data, t.labels, t.cfg).comparison


@query("feature_importance", "model:s feature:s importance:f")
def _(t: Tables):
    run = _run(t)
    return churn.feature_importance(run.models, run.columns)


@query("top_features_15", "model:s place:i feature:s importance:f")
def _(t: Tables):
    run = _run(t)
    return churn.feature_importance(run.models, run.columns, top=15)


def _attributions(t: Tables):
    """Attributions of the best model for all test rows, computed once."""
    if not hasattr(t, "_shap"):
        run = _run(t)
        t._shap = store(explain.shap_contributions(run.best, run.test, run.columns), "attributions")
    return t._shap


@query("shap_contributions", "feature:s mean_abs:f")
def _(t: Tables):
    """Mean absolute attribution of the best model over all test rows, all features."""
    columns = _run(t).columns
    return explain.mean_size(_attributions(t), columns, len(columns))


@query("shap_rows", "customer_id:i feature:s attribution:f")
def _(t: Tables):
    """Attribution of every feature for every test row."""
    return _attributions(t).unpivot(["customer_id"], _run(t).columns, "feature", "attribution")


_LINEAR = {"recency_days": 0.01, "frequency": -0.2, "monetary": -0.000001, "engagement_score": -0.05, "return_rate": 1.5}


@query(
    "shap_linear", "customer_id:i " + " ".join(f"{c}:f" for c in _LINEAR),
    "SELECT customer_id, " + ", ".join(f"({c} - avg({c}) OVER ()) * CAST({w!r} AS DOUBLE) AS {c}" for c, w in _LINEAR.items()) + " FROM feat",
)
def _(t: Tables):
    """Attributions of a linear score with given weights."""
    return explain.linear_contributions(t.features, _LINEAR)


@query("model_sink", "customers:i same:i", "SELECT count(*) AS customers, count(*) AS same FROM people")
def _(t: Tables):
    """The best model, saved and reloaded, scores every customer as before."""
    model = _run(t).best
    path = scratch(t.spark, "model")
    churn.save_model(model, t.spark, path)
    again = churn.score_all(churn.load_model(t.spark, path), t.profitable).select(
        "customer_id", F.col("churn_prob").alias("again"))
    both = churn.score_all(model, t.profitable).select("customer_id", "churn_prob").join(again, "customer_id")
    return both.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("churn_prob") == F.col("again")).alias("same"))


@query("model_comparison_sink", _METRICS)
def _(t: Tables):
    """The metric table written and read back."""
    path = scratch(t.spark, "model_comparison")
    save(_run(t).comparison, path)
    return t.spark.read.parquet(path).withColumnRenamed("precision", "prec")


@query("full_pipeline", "recommended_action:s customers:i")
def _(t: Tables):
    """All phases from raw tables to actions, in a folder of their own."""
    run = pipeline.Pipeline(t.spark, t.cfg, scratch(t.spark, "pipeline"))
    final = run.run(t.raw)
    return final.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("customers"))
