"""Models, their cuts and what is reported of them come from all rows, however many there are."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stayline.config import Settings
from stayline.functions import synth
from stayline.operators import boosting, churn, explain, labels
from stayline.plans.catalog import base
from stayline.plans.pipeline import Pipeline

CFG = replace(Settings(), fit_rows=40, tree_depth=4, forest_trees=2, forest_depth=3, boosting_rounds=2, boosting_depth=2, max_iter=50)
FEATURES = ["recency_days", "frequency", "monetary"]
PEOPLE, BALANCED = 300, 2 * 160  # four fifths of 200 are the larger class's training rows


def customers(spark):
    draw = [synth.uniform(3, c, "customer_id") for c in FEATURES]
    return spark.range(PEOPLE).withColumnRenamed("id", "customer_id").withColumns(dict(zip(FEATURES, draw)))


def target(spark):
    return spark.range(PEOPLE).select(F.col("id").alias("customer_id"), (F.col("id") % 3 > 0).cast("int").alias("churn"))


@pytest.fixture(scope="module")
def own(spark):
    """Queries on rows of this test, under a folder name of their own."""
    t = base.Tables(spark, "whole")
    t.cfg = CFG
    t.__dict__ |= {"profitable": customers(spark).localCheckpoint(), "labels": target(spark).localCheckpoint()}
    key = (spark.sparkContext.applicationId, "whole")
    base._TABLES[key] = t
    yield t
    del base._TABLES[key]


@pytest.mark.parametrize("name", [
    "importance_shares", "logistic_regression", "model_comparison_sink", "model_sink", "shap_rows", "tree_replay"])
def test_models_behind_a_query_saw_all_rows(spark, own, name):
    rows = entry.queries()[name](spark, "whole").collect()
    assert rows and own._run.train.count() == BALANCED > CFG.fit_rows
    tree = explain.model_trees(own._run.models["Decision Tree"], spark)[0]
    assert tree.cover[0] == BALANCED
    if name == "tree_replay":
        assert sorted(tuple(r) for r in rows) == [("Decision Tree", BALANCED, 0), ("Random Forest", BALANCED, 0)]
    if name == "model_sink":
        assert tuple(rows[0]) == (PEOPLE, PEOPLE)
    if name == "shap_rows":
        assert len(rows) == (PEOPLE - 80 - 160) * len(FEATURES)


def test_oversampling_starts_from_all_rows(spark, own):
    rows = entry.queries()["smote"](spark, "whole").collect()
    assert sorted(tuple(r) for r in rows) == [(0, BALANCED // 2, 0), (1, BALANCED // 2, 0)]


def test_newton_trees_saw_all_rows(spark, own):
    rows = entry.queries()["newton_importance"](spark, "whole").collect()
    assert len(rows) == len(FEATURES) and own._newton_run.train.count() == BALANCED


def test_pipeline_fits_all_rows(spark, tmp_path, monkeypatch):
    """The churn phase, which the query full_pipeline runs."""
    seen = []
    fit = churn.train_models
    monkeypatch.setattr(churn, "train_models", lambda train, *args: (seen.append(train.count()), fit(train, *args))[1])
    monkeypatch.setattr(labels, "churn_labels", lambda *args: target(spark))
    run = Pipeline(spark, CFG, str(tmp_path))
    run.adopt("base", {"transactions": spark.range(1)})
    run.adopt("profitability", {"customer_profitable": customers(spark)})
    assert run.churn(["Decision Tree"]).count() == PEOPLE
    assert seen == [BALANCED]


def test_newton_cuts_come_from_all_rows(spark):
    n = 40_000
    df = spark.range(n).selectExpr("id customer_id", "cast(id % 2 as int) churn", "cast(id as double) x")
    cuts = boosting.fit(df, ["x"], rounds=1, depth=1).cuts[0]
    assert len(cuts) == 253 - 1 and np.abs(np.diff(cuts) - n / 253).max() <= 1


def test_common_values_leave_cuts_for_others(spark):
    """Nine tenths of the rows have one value, half of the others another."""
    df = spark.range(20_000).selectExpr(
        "id customer_id", "case when id % 10 > 0 then 0.0 when id % 20 = 0 then 0.5 else 1.0 + id end x")
    plain, capped = (boosting.cut_points(df, ["x"], "customer_id", 32, None, 1, capped)[0] for capped in (False, True))
    assert len(plain) < 8 and 24 <= len(capped) <= 31 and capped[:2] == [0.0, 0.5]
    rows = df.filter("x > 0.5").count()
    inside = [df.filter((F.col("x") > a) & (F.col("x") <= b)).count() for a, b in zip(capped[1:4], capped[2:5])]
    assert max(inside) <= rows / 20


def test_rare_values_are_cuts_of_the_trees(spark, tmp_path):
    """Of 24,000 rows one a feature differs, and has the other label: a draw of rows misses some."""
    width = 12
    columns = [f"x{f}" for f in range(width)]
    train = spark.range(24_000).withColumnRenamed("id", "customer_id").withColumns(
        {c: F.when(F.col("customer_id") == 2000 * f + 1, 1.0).otherwise(0.0) for f, c in enumerate(columns)})
    train = train.withColumn("churn", (F.col("customer_id") % 2000 == 1).cast("int"))
    model = churn.train_models(train, columns, replace(CFG, tree_depth=width), ["Decision Tree"])["Decision Tree"]
    scored = churn.score(model, train)
    assert scored.columns == [*train.columns, "churn_prob"]
    assert scored.filter("churn <> cast(churn_prob >= 0.5 as int)").count() == 0
    assert model.stages[-1].numNodes == 2 * width + 1
    churn.save_model(model, spark, f"{tmp_path}/m")
    again = churn.score(churn.load_model(spark, f"{tmp_path}/m"), train)
    assert again.groupBy("churn", "churn_prob").count().orderBy("churn").collect() == scored.groupBy(
        "churn", "churn_prob").count().orderBy("churn").collect()
