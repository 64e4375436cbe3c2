from dataclasses import replace
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import synth
from stayline.operators import churn, clustering, explain, labels, oversampling

CFG = replace(Settings(), forest_trees=5, forest_depth=4, boosting_rounds=4, boosting_depth=3,
              cluster_restarts=1, cluster_range=(3, 4), max_iter=50)
COLUMNS = ["recency_days", "frequency", "monetary"]


def people(n=400, seed=5):
    rng = np.random.default_rng(seed)
    churned = (rng.random(n) < 0.8).astype(int)
    return pd.DataFrame({
        "customer_id": range(n), "churn": churned,
        "recency_days": rng.normal(100 + 60 * churned, 40, n),
        "frequency": rng.poisson(5 - 2 * churned) * 1.0,
        "monetary": rng.normal(1000, 200, n),
    })


def test_neighbours_equal_brute_force(spark):
    pdf = people(90).drop(columns="churn")
    df = spark.createDataFrame(pdf).withColumn("position", F.col("customer_id") + 1)
    x = pdf[COLUMNS].to_numpy()
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(dist, np.inf)
    want = np.sort(dist, axis=1)[:, :5]
    got = oversampling.nearest_neighbours(df.repartition(7), COLUMNS, 5).orderBy("position").toPandas()
    assert np.allclose(np.stack(got.d), want)


def crowd(n=600, seed=2):
    """Clusters, a point that a third of the rows share, and far outliers."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * 0.3 + rng.normal(size=(6, 3))[rng.integers(0, 6, n)] * 5
    x[rng.random(n) < 0.33] = x[0]
    x[:4] *= 100
    return x


@pytest.mark.parametrize("pivots", [1, 7, 24])
def test_pivot_neighbours_equal_brute_force(spark, monkeypatch, pivots):
    monkeypatch.setattr(oversampling, "BLOCK", 50)
    x = crowd()
    df = spark.createDataFrame([(i, i + 1, row.tolist()) for i, row in enumerate(x)], "customer_id int, position long, x array<double>")
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(dist, np.inf)
    got = oversampling.pivot_neighbours(df.repartition(6), 3, 5, pivots).orderBy("position").toPandas()
    assert len(got) == len(x) and np.allclose(np.stack(got.d), np.sort(dist, axis=1)[:, :5])
    near = np.stack(got.near).reshape(-1, 5, 3)
    assert np.allclose(((near - x[:, None]) ** 2).sum(axis=2), np.stack(got.d))


def test_neighbours_beyond_the_shared_bytes(spark):
    pdf = people(90).drop(columns="churn")
    df = spark.createDataFrame(pdf).withColumn("position", F.col("customer_id") + 1)
    small = oversampling.nearest_neighbours(df, COLUMNS, 5).orderBy("position").toPandas()
    large = oversampling.nearest_neighbours(df, COLUMNS, 5, shared_bytes=100).orderBy("position").toPandas()
    assert list(small.columns) == list(large.columns) and np.allclose(np.stack(small.d), np.stack(large.d))
    assert np.allclose(np.stack(small.near), np.stack(large.near))


def test_smote_balances_and_stays_between(spark):
    pdf = people()
    train = spark.createDataFrame(pdf).repartition(3)
    got = oversampling.smote(train, COLUMNS, CFG).toPandas()
    assert got.churn.value_counts().nunique() == 1
    minority = pdf[pdf.churn == 0][COLUMNS]
    made = got[got.churn == 0][COLUMNS]
    assert (made.min() >= minority.min()).all() and (made.max() <= minority.max()).all()
    again = oversampling.smote(train.repartition(11), COLUMNS, CFG).toPandas()
    assert np.allclose(np.sort(got.monetary), np.sort(again.monetary))


def test_smote_with_too_few_rows(spark):
    train = spark.createDataFrame(people(20).assign(churn=[0] + [1] * 19))
    assert oversampling.smote(train, COLUMNS, CFG).count() == 20


def test_split_is_stratified(spark):
    df = labels.stratified_split(spark.createDataFrame(people()), CFG).toPandas()
    for _, part in df.groupby("churn"):
        assert part.is_train.sum() == int(len(part) * 0.8 + 0.5)


def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"customer_id": range(60), "a": rng.normal(size=60), "b": rng.normal(size=60), "prediction": rng.integers(0, 3, 60)})
    x, g = pdf[["a", "b"]].to_numpy(), pdf.prediction.to_numpy()
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    s = []
    for i in range(60):
        own = dist[i][(g == g[i]) & (np.arange(60) != i)].mean()
        other = min(dist[i][g == k].mean() for k in set(g) - {g[i]})
        s.append((other - own) / max(own, other))
    got = clustering.silhouette(spark.createDataFrame(pdf), ["a", "b"]).first()[0]
    assert got == pytest.approx(np.mean(s))
    one = pdf.assign(prediction=1)
    assert clustering.silhouette(spark.createDataFrame(one), ["a", "b"]).first()[0] is None


def blobs(n=300, seed=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) + np.array([[0, 0], [4, 0], [0, 5], [6, 6]])[rng.integers(0, 4, n)]
    return np.rint(x * clustering.STEPS) / clustering.STEPS


def euclidean(x, g):
    dist, s = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), []
    for i in range(len(x)):
        if (g == g[i]).sum() == 1:
            s.append(0.0)
            continue
        own = dist[i][(g == g[i]) & (np.arange(len(x)) != i)].mean()
        other = min(dist[i][g == k].mean() for k in set(g) - {g[i]})
        s.append((other - own) / max(own, other))
    return np.array(s)


def test_euclidean_silhouette_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = blobs()
    pdf = pd.DataFrame({"customer_id": range(len(x)), "a": x[:, 0], "b": x[:, 1], "g": rng.integers(0, 3, len(x)), "h": 1,
                        "own": [7] + [8] * (len(x) - 1)})
    df = spark.createDataFrame(pdf).repartition(5)
    monkeypatch.setattr(clustering, "SAMPLE_BLOCK", 64)
    monkeypatch.setattr(clustering, "TILE", 5000)
    labels = {c: F.col(c) for c in ("g", "h", "own")}
    got = clustering.euclidean_silhouettes(df, ["a", "b"], labels, CFG)
    assert got["g"] == pytest.approx(euclidean(x, pdf.g.to_numpy()).mean())
    assert got["own"] == pytest.approx(euclidean(x, pdf.own.to_numpy()).mean()) and got["h"] is None
    some = clustering.euclidean_silhouettes(df, ["a", "b"], labels, replace(CFG, silhouette_rows=40))
    each = euclidean(x, pdf.g.to_numpy())
    draws = df.select("customer_id", synth.uniform(CFG.seed, "silhouette", "customer_id").alias("u")).toPandas().sort_values("u")
    assert some["g"] == pytest.approx(each[draws.customer_id.to_numpy()[:40]].mean())


def lloyd(x, points):
    """Updates of one run alone, to its fixpoint."""
    passes = 0
    while True:
        near = ((x[:, None] - points[None]) ** 2).sum(axis=2).argmin(axis=1)
        after = np.array([x[near == c].mean(axis=0) if (near == c).any() else points[c] for c in range(len(points))])
        passes += 1
        if np.array_equal(after, points):
            return after, ((x - after[near]) ** 2).sum(), passes
        points = after


def test_runs_in_one_scan_equal_separate_ones(spark):
    x = blobs()
    df = spark.createDataFrame(pd.DataFrame({"customer_id": range(len(x)), "a": x[:, 0], "b": x[:, 1]}))
    sets = [(k, r) for k in (2, 3, 4) for r in range(3)]
    runs = clustering.starts(df.repartition(5), ["a", "b"], sets, 1)
    again = clustering.starts(df.repartition(2), ["a", "b"], sets, 1)
    first = [r.points.copy() for r in runs]
    assert [(r.k, r.restart) for r in runs] == sets and all(np.array_equal(a, b.points) for a, b in zip(first, again))
    assert all(len({tuple(p) for p in points}) == len(points) for points in first)  # no row is drawn twice
    assert len({points.tobytes() for points in first}) == len(first)
    clustering.converged(df.repartition(5), ["a", "b"], runs, tolerance=0.0)
    for run, points in zip(runs, first):
        want, inertia, passes = lloyd(x, points)
        assert np.allclose(run.points, want) and run.inertia == pytest.approx(inertia) and run.passes == passes
    best = clustering.best_runs(df, ["a", "b"], replace(CFG, cluster_range=(4,), cluster_restarts=5))[4]
    assert best.inertia <= min(r.inertia for r in runs if r.k == 4) * 1.001


def test_more_clusters_than_points(spark):
    df = spark.createDataFrame([(i, float(i % 2), 0.0) for i in range(6)], "customer_id int, a double, b double")
    run = clustering.best_runs(df, ["a", "b"], replace(CFG, cluster_range=(3,)))[3]
    assert run.inertia == 0 and df.select(clustering.nearest_centre(run, ["a", "b"])).distinct().count() == 2


def test_fit_sample_is_bounded(spark):
    train = spark.createDataFrame(people(2000))
    got = churn.bounded(train, replace(CFG, fit_rows=500))
    assert 400 < got.count() < 600
    assert churn.bounded(train, CFG).count() == 2000
    share = got.filter("churn = 1").count() / got.count()
    assert share == pytest.approx(train.filter("churn = 1").count() / 2000, abs=0.06)


def test_smote_parents(spark):
    got = oversampling.smote(spark.createDataFrame(people()), COLUMNS, CFG, origin=True).toPandas()
    made = got[got.own.notna()]
    assert len(made) and (made.churn == 0).all()
    own, other, x = np.stack(made.own), np.stack(made.other), made[COLUMNS].to_numpy()
    assert ((x >= np.minimum(own, other) - 1e-9) & (x <= np.maximum(own, other) + 1e-9)).all()


def test_cluster_names_get_suffix_on_repeat(spark):
    rows = [(i, float(i), 1.0, float(100 - i), 0.0, 0.0, 1) for i in range(8)]
    df = spark.createDataFrame(rows, "cluster int, recency_days double, frequency double, monetary double, engagement_score double, avg_order_value double, customers int")
    got = [r.kmeans_segment for r in clustering.cluster_names(df).orderBy("cluster").collect()]
    assert got == ["High Value Active", "High Value Active (1)", "Medium Value Active", "Medium Value Active (3)",
                   "Low Value Dormant", "Low Value Dormant (5)", "Low Value Dormant (6)", "Low Value Dormant (7)"]


@pytest.fixture(scope="module")
def models(spark):
    train = spark.createDataFrame(people(600))
    return churn.train_models(train, COLUMNS, CFG, churn.MODELS + [churn.NEWTON]), spark.createDataFrame(people(120, 6))


def test_all_models_beat_chance(spark, models):
    from stayline.operators import evaluation

    fitted, test = models
    scored = {n: churn.score(m, test) for n, m in fitted.items()}
    table = evaluation.compare_models(scored).toPandas().set_index("model")
    assert set(table.index) == {*churn.MODELS, churn.NEWTON}
    assert (table.auc_roc > 0.75).all()


def expected(tree, x, subset, node=0):
    """A tree's value where only the features of a subset are known."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in subset:
        goes = tree.null_left[node] if np.isnan(x[f]) else x[f] <= tree.cut[node]
        return expected(tree, x, subset, left if goes else right)
    return sum(tree.cover[c] / tree.cover[node] * expected(tree, x, subset, c) for c in (left, right))


def shapley(trees, x, n):
    """By definition: over all subsets of features."""

    def value(subset):
        return sum(expected(t, x, subset) for t in trees)

    phi = np.zeros(n)
    for i in range(n):
        rest = [f for f in range(n) if f != i]
        for size in range(n):
            for s in combinations(rest, size):
                w = factorial(size) * factorial(n - size - 1) / factorial(n)
                phi[i] += w * (value(set(s) | {i}) - value(set(s)))
    return phi, value(set(range(n)))


@pytest.mark.parametrize("name", ["Decision Tree", "Random Forest", "Gradient Boosting", "Newton Boosting"])
def test_tree_attributions_equal_definition(spark, models, name):
    fitted, test = models
    model = fitted[name]
    trees = explain.model_trees(model, spark)
    got = explain.shap_contributions(model, test, COLUMNS).toPandas().set_index("customer_id").sort_index()
    if name == churn.NEWTON:
        x = test.select("customer_id", F.array(*COLUMNS).alias("x"))
    else:
        x = PipelineModel(model.stages[:-1]).transform(test).select("customer_id", vector_to_array("features").alias("x"))
    x = x.toPandas().set_index("customer_id").sort_index().x
    probs = churn.score(model, test).select("customer_id", "churn_prob").toPandas().set_index("customer_id").sort_index().churn_prob
    for i in (0, 5, 77):
        phi, full = shapley(trees, x[i], len(COLUMNS))
        assert np.allclose(got.loc[i, COLUMNS].to_numpy(float), phi)
        scale = {"Gradient Boosting": 2, "Newton Boosting": 1}.get(name)
        prob = 1 / (1 + np.exp(-scale * full)) if scale else full
        assert prob == pytest.approx(probs[i], abs=1e-6)


def random_tree(rng, depth, features):
    """A full tree over random cuts, in which features come again on a path."""
    n = 2 ** (depth + 1) - 1
    inner = np.arange(n) < 2**depth - 1
    cover = np.zeros(n)
    cover[0] = 1000.0
    for i in np.flatnonzero(inner):
        part = rng.uniform(0.1, 0.9)
        cover[2 * i + 1], cover[2 * i + 2] = part * cover[i], (1 - part) * cover[i]
    return explain.TreeNodes(
        np.where(inner, rng.integers(0, features, n), -1), rng.normal(size=n), rng.random(n) < 0.5,
        np.where(inner, 2 * np.arange(n) + 1, -1), np.where(inner, 2 * np.arange(n) + 2, -1),
        np.where(inner, 0.0, rng.normal(size=n)), cover)


@pytest.mark.parametrize("depth", [0, 1, 4, 6])
def test_path_weights_equal_definition(depth):
    rng = np.random.default_rng(depth)
    tree, x = random_tree(rng, depth, 4), rng.normal(size=(20, 4))
    x[rng.random(x.shape) < 0.1] = np.nan
    out = np.zeros((4, 20))
    explain.tree_shapley(tree, x, out)
    for i in range(20):
        assert np.allclose(out[:, i], shapley([tree], x[i], 4)[0])


def test_deep_tree_is_additive():
    rng = np.random.default_rng(9)
    tree, x = random_tree(rng, 12, 25), rng.normal(size=(50, 25))
    out = np.zeros((25, 50))
    explain.tree_shapley(tree, x, out)
    none, whole = expected(tree, x[0], set()), [expected(tree, row, set(range(25))) for row in x]
    assert np.allclose(out.sum(axis=0) + none, whole)


def test_logistic_gradient_and_tree_replay(spark, models):
    fitted, _ = models
    train = spark.createDataFrame(people(600))
    model = fitted["Logistic Regression"]
    slopes = churn.logistic_gradient(model, train)
    assert len(slopes) == len(COLUMNS) + 1 and max(map(abs, slopes.values())) < 1e-3
    other = churn.logistic_gradient(model, spark.createDataFrame(people(600, 9)))
    assert max(map(abs, other.values())) > 1e-3  # not at rows it was not fitted on
    model = fitted["Decision Tree"]
    tree = explain.model_trees(model, spark)[0]
    rows = PipelineModel(model.stages[:-1]).transform(train).select(vector_to_array("features").alias("features"))
    counts = {r["node"]: r["n"] for r in churn.replayed(tree, rows.repartition(4)).collect()}
    assert [counts[i] for i in range(len(tree.cover))] == tree.cover.tolist()


def test_models_come_back_from_disk(spark, models, tmp_path):
    fitted, test = models
    for name in ("Decision Tree", churn.NEWTON):
        path = f"{tmp_path}/{name}"
        churn.save_model(fitted[name], spark, path)
        again = churn.load_model(spark, path)
        assert sorted(churn.score(again, test).collect()) == sorted(churn.score(fitted[name], test).collect())


def test_linear_attributions_sum_to_score(spark, models):
    fitted, test = models
    got = explain.shap_contributions(fitted["Logistic Regression"], test, COLUMNS).toPandas()
    assert np.allclose(got[COLUMNS].sum(), 0, atol=1e-6)
    assert explain.mean_size(spark.createDataFrame(got), COLUMNS).count() == 3


def test_small_partitions_are_merged_before_fitting(spark, monkeypatch):
    seen = []
    make = churn.classifier
    monkeypatch.setattr(churn, "freeze", lambda df: df)

    def watched(name, n_rows, cfg):
        tree = make(name, n_rows, cfg)
        monkeypatch.setattr(tree, "_fit", lambda df: (seen.append(df.rdd.getNumPartitions()), type(tree)._fit(tree, df))[1])
        return tree

    monkeypatch.setattr(churn, "classifier", watched)
    train = spark.createDataFrame([(i, i % 2, float(i % 7)) for i in range(200)], "customer_id long, churn int, x double")
    churn.train_models(train.repartition(40), ["x"], CFG, ["Decision Tree"])
    assert seen == [churn.LEAST_PARTS]
    churn.train_models(train.repartition(3), ["x"], CFG, ["Decision Tree"])
    assert seen[-1] == 3


def test_rows_of_a_deep_tree_share_their_way_in_large_batches():
    """Subtrees are entered by classes of rows, and small Arrow batches are merged."""
    rng = np.random.default_rng(3)
    n = 2**7 - 1  # a full tree of depth 6
    inner = np.arange(n) < n // 2
    tree = explain.TreeNodes(
        np.where(inner, rng.integers(0, 5, n), -1), rng.normal(size=n), rng.random(n) < 0.5,
        np.where(inner, 2 * np.arange(n) + 1, -1), np.where(inner, 2 * np.arange(n) + 2, -1),
        np.where(inner, 0.0, rng.normal(size=n)), np.zeros(n))
    for i in range(n - 1, -1, -1):
        tree.cover[i] = tree.cover[2 * i + 1] + tree.cover[2 * i + 2] if inner[i] else rng.integers(1, 9)
    x = rng.normal(size=(60, 5))
    x[rng.random(x.shape) < 0.1] = np.nan
    out = np.zeros((5, len(x)))
    explain.tree_shapley(tree, x, out)
    for i in range(len(x)):
        assert np.allclose(out[:, i], shapley([tree], x[i], 5)[0])
    assert explain._heights(tree)[0] == 6
    frames = [pd.DataFrame({"v": [i, i]}) for i in range(5)]
    assert [list(f["v"]) for f in explain._larger(iter(frames), 3)] == [[0, 0, 1, 1], [2, 2, 3, 3], [4, 4]]
    assert list(explain._larger(iter([]), 3)) == []


def test_nearest_points_one_after_the_other():
    """The same numbers and distances, bit by bit, as from the whole matrix; it is not built."""
    import tracemalloc

    rng = np.random.default_rng(4)
    x, points = rng.normal(size=(5000, 5)), rng.normal(size=(64, 5))
    points[7] = points[3]  # a tie goes to the smaller number
    square = clustering._squares(x, points)
    by_column = np.ascontiguousarray(x.T)
    tracemalloc.start()
    near, own = clustering._nearest(by_column, points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (near == square.argmin(axis=1)).all() and (own == square.min(axis=1)).all()
    assert peak < square.nbytes / 8
    near, own = clustering._nearest(np.zeros((5, 0)), points)
    assert len(near) == len(own) == 0
