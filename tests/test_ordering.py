import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayline.functions import synth
from stayline.operators import ordering


def expected_bucket(rank, n, q):
    return max(1, int(np.ceil((rank - 1) * q / (n - 1))))


@pytest.mark.parametrize("n", [2, 4, 7, 11, 23, 101])
@pytest.mark.parametrize("q", [4, 5])
def test_buckets_equal_rank_formula(spark, n, q):
    rows = [(i, float(i * 7919 % 5)) for i in range(n)]  # many ties
    df = spark.createDataFrame(rows, "id long, v double")
    got = ordering.quantile_buckets(df, "id", {"b": ("v", q)}).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "v"]).sort_values(["v", "id"]).reset_index(drop=True)
    want = {r.id: expected_bucket(i + 1, n, q) for i, r in pdf.iterrows()}
    assert dict(zip(got.id, got.b)) == want


def test_buckets_equal_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(533), "v": rng.integers(0, 9, 533).astype(float)})
    want = pd.qcut(pdf.sort_values("id").v.rank(method="first"), 5, labels=False) + 1
    got = ordering.quantile_buckets(spark.createDataFrame(pdf).repartition(7), "id", {"b": ("v", 5)})
    assert got.orderBy("id").toPandas().b.tolist() == want.tolist()


def test_single_row(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, v double")
    assert ordering.quantile_buckets(df, "id", {"b": ("v", 5)}, alone=3).first()["b"] == 3


def test_text_ids(spark):
    df = spark.createDataFrame([(f"c{i:03d}", 1.0) for i in range(10)], "id string, v double")
    got = ordering.quantile_buckets(df, "id", {"b": ("v", 5)}).orderBy("id").toPandas().b.tolist()
    assert got == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": range(401), "a": rng.normal(size=401), "b": rng.integers(0, 3, 401) * 1.0})
    got = ordering.quantiles(spark.createDataFrame(pdf), {"a": [0.33, 0.66], "b": [0.0, 0.5, 1.0]}, "id")
    assert np.allclose(got["a"], np.quantile(pdf.a, [0.33, 0.66]))
    assert np.allclose(got["b"], np.quantile(pdf.b, [0.0, 0.5, 1.0]))


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_positions_and_running_totals(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select("id", (F.col("id") % 3).alias("v")).repartition(5)
        ordered = ordering.InOrder(df, F.desc("v"), F.asc("id"))
        got = ordered.numbered().orderBy("position").toPandas()
        want = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
        assert got.position.tolist() == list(range(1, 1001))
        assert got.id.tolist() == want.id.tolist()
        run = ordered.running({"total": "v"}).toPandas().set_index("id").total
        assert run.loc[want.id].tolist() == want.v.cumsum().tolist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_medians_with_a_hot_group(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"k": range(n), "g": np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 400, n)),
                        "v": rng.integers(0, 50, n)})
    got = ordering.group_medians(spark.createDataFrame(pdf), "g", "v", "k", "m").toPandas().set_index("g").m
    want = pdf.groupby("g").v.median()
    assert got.sort_index().tolist() == want.tolist()


def test_group_cut_is_exact(spark):
    df = spark.range(500).select("id", (F.col("id") % 10 == 0).cast("int").alias("g"))
    df = df.withColumn("u", synth.uniform(1, "t", "id"))
    got = df.withColumn("inside", ordering.group_cut(df, "g", "u", "id", 0.8)).groupBy("g").agg(
        F.count_if("inside").alias("n")).toPandas().set_index("g").n
    assert got.to_dict() == {0: 360, 1: 40}


def test_sample_is_exact_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    draw = synth.uniform(9, "s", "k")
    first = {r.k for r in ordering.sample_exact(df, "k", 700, draw).collect()}
    second = {r.k for r in ordering.sample_exact(df.repartition(13), "k", 700, draw).collect()}
    assert len(first) == 700 and first == second
    assert ordering.sample_exact(df, "k", 9000, draw).count() == 5000
