"""Curve keys, recall and exact ties against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import hilbert_search as H
from stayline.llm import queries


def exact(vectors, asked, k):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in asked:
        d = np.sqrt(((x - np.array(vectors[q])) ** 2).sum(axis=1))
        out[q] = [(ids[j], d[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_place_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = H.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_recall(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = H.nearest(df, "vec_id", "embedding", F.col("id") % 100 == 0, cell=100).collect()
    want = exact(dict(enumerate(x)), range(0, 4000, 100), 10)
    hits = sum(r["id"] in {i for i, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 400 and hits >= 0.9 * 400
    for r in got:
        assert r["score"] == pytest.approx(np.sqrt(((x[r["query_id"]] - x[r["id"]]) ** 2).sum()), rel=1e-14)


def test_recall_does_not_fall_with_the_number_of_points():
    n, rng = 200_000, np.random.default_rng(0)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    distance = -x[:50] @ x.T
    distance[np.arange(50), np.arange(50)] = np.inf
    true = np.argpartition(distance, 10, axis=1)[:, :10]
    cell, met = H.cell_size(n), np.zeros((50, 10), bool)
    for keys in H.Curves(x[: H.FIT_POINTS], H.CURVES, 5).keys(x):
        place = np.empty(n, int)
        place[np.argsort(keys, kind="stable")] = np.arange(n)
        met |= abs(place[true] // cell - place[:50, None] // cell) <= 1
    assert met.mean() >= 0.9  # cells of 512 meet 0.82


def test_tiles_change_nothing(spark, monkeypatch):
    x = np.random.default_rng(1).integers(-2, 3, (1500, 6)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x) if v.any()], "vec_id long, embedding array<double>")

    def run():
        return sorted(map(tuple, H.nearest(df, "vec_id", "embedding", F.col("id") % 3 == 0, curves=4, cell=100).collect()))

    whole = run()
    monkeypatch.setattr(H, "TILE", 30)
    assert run() == whole


def test_nearest_of_ties_and_extremes():
    rng = np.random.default_rng(2)
    for x in (rng.integers(0, 3, (300, 4)) * 1.0, rng.normal(size=(300, 4)) * 1e-3 + 1e3, rng.normal(size=(300, 4)) * 1e200):
        ids = rng.permutation(300)
        row, found, score = H.nearest_of(x[:20], x, ids, 7)
        with np.errstate(over="ignore"):
            every = np.sqrt(((x[:20, None] - x[None]) ** 2).sum(axis=2))
        for i, line in enumerate(every):
            best = np.lexsort((ids, line))[:7]
            assert found[row == i].tolist() == ids[best].tolist() and score[row == i].tolist() == line[best].tolist()


def test_ties_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = {i: [1.0, 0.0] for i in range(0, 40)} | {40: [0.0, 1.0], 41: [-0.0, 1.0], 42: [1.0, 1.0], 50: [3.0, 4.0]}
    bad = [(60, None), (61, [0.0, 0.0]), (62, [nan, 1.0]), (63, [inf, 1.0]), (64, [None, 1.0]), (65, [1.0]), (None, [1.0, 0.0]), (66, [])]
    rows = [(i, v, "x", 0) for i, v in [*vectors.items(), *bad, (3, [1.0, 0.0])]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, point string, cell int")
    got = H.nearest(df, "vec_id", "embedding", F.col("id") % 10 == 0).orderBy("query_id", "rank").collect()
    want = exact(vectors, [0, 10, 20, 30, 40, 50], 10)
    assert {q: [(r["id"], r["score"]) for r in got if r["query_id"] == q] for q in want} == want
    assert all([r["rank"] for r in got if r["query_id"] == q] == list(range(1, 11)) for q in want)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = H.nearest(df, "vec_id", "embedding", F.col("id") == 0).orderBy("rank").collect()
    assert [r["id"] for r in got] == [2, 1]
    assert H.nearest(df.filter("1 = 0"), "vec_id", "embedding", F.col("id") == 0).count() == 0
    assert H.nearest(df, "vec_id", "embedding", F.col("id") == 9).count() == 0
    assert H.nearest(df.limit(1), "vec_id", "embedding", F.col("id") == 0).count() == 0


def test_query(spark, folder):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    rows = queries.queries()["op1_hilbert_curves"](spark, folder).collect()
    want = exact(vectors, [i for i in vectors if i % 100 == 0], 10)
    hits = sum((r["vec_id"] in {i for i, _ in want[r["query_id"]]}) for r in rows)
    assert len(rows) == 10 * len(want) and hits >= 0.9 * len(rows)
