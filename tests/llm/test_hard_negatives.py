"""Hard negatives against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step=10, positives=5, k=5):
    """All answers for anchors whose id is divisible by `step`."""
    good = {(i, l, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, l, v in good:
        if i % step:
            continue
        score = {r: sum(a * b for a, b in zip(v, r[2])) for r in good if len(r[2]) == len(v)}
        near = sorted((r for r in score if r[0] != i and r[1] == l), key=lambda r: (-score[r], r[0]))[:positives]
        for p in near:
            inside = [r for r in score if r[1] != l and 80 * score[p] <= 100 * score[r] <= 100 * score[p]]
            for rank, r in enumerate(sorted(inside, key=lambda r: (-score[r], r[0]))[:k], start=1):
                out.append((i, p[0], rank, r[0], score[p], score[r]))
    return sorted(out)


def mined(df, **sizes):
    out = hard_negatives.mined(df, "vec_id", "embedding", F.col("label"), F.col("id") % 10 == 0, **sizes)
    return sorted(tuple(r) for r in out.collect())


def rows_of(n, dim, seed, spread=0.5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [(i, (centre + spread * rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(0, 3) * rng.integers(0, 2))) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"anchor_block": 3, "row_block": 17}])
def test_answers_equal_brute_force(spark, sizes):
    rows = rows_of(150, 8, 1)
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(6), **sizes)
    assert got == brute(rows) and len(got) > 100


def test_ties_and_a_vector_that_a_third_of_the_rows_have(spark):
    draw = random.Random(2)
    rows = [(i, [float(draw.randint(0, 2)) for _ in range(3)] if i % 3 else [1.0, 1.0, 1.0], draw.randint(0, 2)) for i in range(120)]
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(4), row_block=20)
    assert got == brute(rows) and got


def test_awkward_rows(spark):
    rows = rows_of(60, 4, 3)
    rows += rows[:7]  # repeated rows count once
    rows += [(20, [0.1, 0.2, 0.3, 0.4], 1), (None, [1.0] * 4, 1), (70, None, 1), (80, [1.0] * 4, None), (90, [1.0, None, 1.0, 1.0], 1),
             (100, [float("nan")] * 4, 1), (110, [float("inf")] + [1.0] * 3, 1), (120, [], 1), (121, [], 1), (122, [], 0), (130, [1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as score", "3 as anchor", "4 as slot", "label as vec")
    assert mined(df.repartition(3)) == brute(rows)
    assert mined(df.filter("1 = 0")) == []


def test_few_rows_and_negative_scores(spark):
    rows = [(0, [1.0, -1.0], 0), (1, [1.0, 0.5], 0), (2, [-3.0, 1.0], 0), (3, [0.9, 0.5], 1), (4, [-1.0, -1.0], 1), (10, [0.0, 0.0], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_products_are_exact_beyond_doubles():
    rng = np.random.default_rng(4)
    a, x = (np.rint(rng.normal(size=(n, 4)) * 2.0**29) for n in (3, 5))
    want = [[sum(int(p) * int(q) for p, q in zip(u, v)) for v in x] for u in a]
    assert hard_negatives.products(a, x).tolist() == want
    huge = np.full((1, 4), 2.0**100)
    assert hard_negatives.products(huge, huge).tolist() == [[2**63 - 1]]


def test_query_relabels_every_seventh_row(spark, tmp_path):
    import duckdb

    rows = rows_of(400, 6, 5)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hard_negatives.op12(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({hard_negatives.SQL})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want
