"""Newton-boosted trees against a small numpy version and by their own laws."""

import numpy as np
import pandas as pd
import pytest

from stayline.operators import boosting

COLUMNS = ["a", "b", "c"]


def data(n=500, seed=3, missing=0.0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 9, n), rng.exponential(2, n)]).astype(float)
    y = (x[:, 0] + 0.3 * (x[:, 1] > 4) - 0.2 * x[:, 2] + rng.normal(0, 0.5, n) > 0.4).astype(int)
    x[rng.random(x.shape) < missing] = np.nan
    return pd.DataFrame({"customer_id": range(n), "churn": y} | {c: x[:, i] for i, c in enumerate(COLUMNS)})


def plain(x, y, cuts, rounds, depth, rate, weight, penalty=1.0, least=1.0):
    """Margins by direct search over all cuts, one node after the other."""
    margin = np.zeros(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        g, h = (p - y) * w, p * (1 - p) * w
        step = np.zeros(len(x))

        def grow(rows, level):
            all_g, all_h = g[rows].sum(), h[rows].sum()
            step[rows] = -rate * all_g / (all_h + penalty)
            if level == depth:
                return
            best = (1e-6,)
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    for missing in (True, False):
                        left = np.where(np.isnan(x[rows, f]), missing, x[rows, f] <= cut)
                        lg, lh = g[rows][left].sum(), h[rows][left].sum()
                        if lh < least or all_h - lh < least:
                            continue
                        gain = lg**2 / (lh + penalty) + (all_g - lg) ** 2 / (all_h - lh + penalty) - all_g**2 / (all_h + penalty)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            if len(best) == 2:
                grow(rows[best[1]], level + 1)
                grow(rows[~best[1]], level + 1)

        grow(np.arange(len(x)), 0)
        margin += step
    return margin


@pytest.mark.parametrize("missing", [0.0, 0.1])
def test_margins_equal_plain_version(spark, missing):
    pdf = data(missing=missing)
    x, y = pdf[COLUMNS].to_numpy(), pdf.churn.to_numpy()
    cuts = [np.unique(np.nanquantile(x[:, f], np.linspace(0.05, 0.95, 19))).tolist() for f in range(3)]
    df = spark.createDataFrame(pdf)
    model = boosting.fit(df.repartition(5), COLUMNS, rounds=6, depth=3, cuts=cuts)
    weight = (y == 0).sum() / (y == 1).sum()
    want = plain(x, y, cuts, 6, 3, 0.1, weight)
    got = model.score(df).orderBy("customer_id").toPandas().churn_prob.to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-want)), atol=1e-6)
    again = boosting.fit(df.repartition(2), COLUMNS, rounds=6, depth=3, cuts=cuts)
    assert again == model  # whatever the partitions


def test_margins_are_carried_over_stored_rounds(spark, monkeypatch):
    df = spark.createDataFrame(data(200))
    whole = boosting.fit(df, COLUMNS, rounds=5, depth=2)
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 2)
    assert boosting.fit(df, COLUMNS, rounds=5, depth=2) == whole


def test_cut_points(spark):
    pdf = pd.DataFrame({"customer_id": range(1000), "few": [i % 7 for i in range(1000)], "many": range(1000),
                        "none": [None] * 1000}).astype({"none": float})
    few, many, none = boosting.cut_points(spark.createDataFrame(pdf).repartition(4), ["few", "many", "none"], "customer_id", 11, 10**6, 1)
    assert few == [0, 1, 2, 3, 4, 5] and none == []
    assert len(many) == 9 and np.allclose(np.diff(many), 100, atol=1)


def test_no_rows_one_label_and_null_features(spark):
    df = spark.createDataFrame(data(60, missing=0.2))
    none = boosting.fit(df.filter("1 = 0"), COLUMNS, rounds=3, depth=2)
    assert none.score(df).filter("churn_prob = 0.5").count() == 60
    one = boosting.fit(df.filter("churn = 1"), COLUMNS, rounds=3, depth=2).score(df).toPandas().churn_prob
    assert one.nunique() == 1 and one[0] > 0.5
    blank = df.selectExpr("customer_id", "churn", "cast(null as double) a", "b", "c")
    got = boosting.fit(blank, COLUMNS, rounds=2, depth=2)
    assert all(f != 0 for t in got.trees for f in t.feature)


def test_saved_model_and_gains(spark, tmp_path):
    df = spark.createDataFrame(data(300))
    model = boosting.fit(df, COLUMNS, rounds=4, depth=3)
    model.save(spark, f"{tmp_path}/m")
    assert boosting.NewtonTrees.load(spark, f"{tmp_path}/m") == model
    assert sum(model.gains()) == pytest.approx(1) and np.argmax(model.gains()) == 0
    assert all(t.cover[t.left[i]] + t.cover[t.right[i]] == pytest.approx(t.cover[i]) for t in model.trees
               for i, f in enumerate(t.feature) if f >= 0)


def test_few_sums_are_merged_in_one_stage_a_level(spark, monkeypatch):
    df, cuts = spark.createDataFrame(data()).repartition(4), [[-0.5, 0.0, 0.5], [2.0, 4.0, 6.0], [1.0, 2.0]]
    context, trees, stages = spark.sparkContext, [], []
    for most in (1 << 26, 0):
        monkeypatch.setattr(boosting, "MERGED_BYTES", most)
        context.setJobGroup(f"boosting{most}", "")
        trees.append([t.__dict__ for t in boosting.fit(df, COLUMNS, rounds=2, depth=2, cuts=cuts).trees])
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"boosting{most}")]
        stages.append(len({stage for job in jobs for stage in job.stageIds}))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert trees[0] == trees[1]
    assert stages[1] - stages[0] >= 4  # two rounds of two levels
