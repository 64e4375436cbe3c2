"""Boundaries against all splits, batches against the budget."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import packing, queries


def padding(ends, longest, counts, totals):
    cost, begin = 0, 0
    for end in ends:
        cost += longest[end] * counts[begin : end + 1].sum() - totals[begin : end + 1].sum()
        begin = end + 1
    return cost


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    m, buckets = int(rng.integers(1, 9)), int(rng.integers(1, 6))
    longest = np.sort(rng.choice(np.arange(1, 60), m, replace=False)).astype(float)
    counts = rng.integers(1, 30, m).astype(float)
    totals = longest * counts - rng.integers(0, 3, m) * (counts > 3)
    got = packing.boundaries(longest, counts, totals, buckets)
    assert got[-1] == m - 1 and len(got) <= buckets and got == sorted(set(got))
    every = [[*c, m - 1] for k in range(min(buckets, m)) for c in combinations(range(m - 1), k)]
    assert padding(got, longest, counts, totals) == min(padding(e, longest, counts, totals) for e in every)


def test_bins_hold_their_lengths(spark):
    lengths = [0, 1, 4095, 4096, 4097, 5000, 8191, 8192, 10**6, 2**31 - 1]
    df = spark.createDataFrame([(n,) for n in lengths], "n int").select("n", packing.bin_of(F.col("n")).alias("b"))
    for r in df.collect():
        assert r["b"] == r["n"] if r["n"] <= 4096 else r["n"] <= r["b"] <= r["n"] * 129 / 128


def check(rows, budget):
    batches = {}
    for r in rows:
        batches.setdefault(r["batch"], []).append(r)
    assert sorted(batches) == list(range(len(batches)))
    short = {}
    for batch in batches.values():
        (bucket,), (bound,) = {r["bucket"] for r in batch}, {r["padded_to"] for r in batch}
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * bound <= budget
        assert max(r["n_tokens"] for r in batch) <= bound
        if len(batch) < max(1, budget // max(1, bound)):
            short[bucket] = short.get(bucket, 0) + 1
    assert all(n == 1 for n in short.values())  # only a bucket's last batch


@pytest.mark.parametrize("chunk_rows", [7, 10**6])
def test_batches(awkward, empty, chunk_rows):
    many = awkward.union(awkward).union(awkward)
    rows = packing.packed(many, packing.tokens("text"), ["doc_id"], 3, 40, chunk_rows).collect()
    assert len(rows) == many.count()
    want = sorted(len((r["text"] or "").split()) if r["text"] and "\x00" not in r["text"] and "﻿" not in r["text"] else -1 for r in many.collect())
    got = sorted(r["n_tokens"] for r in rows)
    assert [w for w in want if w > 5] == [g for g in got if g > 5]
    check(rows, 40)
    assert packing.packed(empty, packing.tokens("text"), ["doc_id"]).count() == 0


def test_query(spark, folder):
    rows = queries.queries()["op5_length_buckets"](spark, folder).collect()
    docs = {r["doc_id"]: len((r["text"] or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == docs
    check(rows, packing.BUDGET)
