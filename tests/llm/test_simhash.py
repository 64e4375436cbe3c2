"""Fingerprints against plain Python, search against all pairs."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stayline.llm import queries, simhash


def print_of(text):
    votes = [0] * 64
    for word in dict.fromkeys(re.split(r"[ \t\n\x0b\f\r]+", text.lower())):
        h = xxhash.xxh64(word.encode(), seed=42).intdigest()
        for j in range(64):
            votes[j] += len(word) if h >> j & 1 else -len(word)
    return sum(1 << j for j in range(64) if votes[j] > 0)


def rows_of(docs):
    """Expected rows by doc_id; docs in ascending order."""
    out = {}
    for i, (key, text) in enumerate(docs):
        follower = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        out[key] = (len(text), edited, print_of(text), print_of(edited), print_of(follower))
    return out


@pytest.mark.parametrize("blocks", [1, 7, 64])
def test_edited_texts_and_fingerprints(awkward, blocks):
    docs = awkward.dropDuplicates(["doc_id"])
    want = rows_of(sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0)))
    rows = simhash.edited(docs, "doc_id", "text", blocks).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, edited, own, other, follower = want[r["id"]]
        assert (r["n_chars"], r["edited_text"]) == (n, edited)
        got = [r[c] & (2**64 - 1) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")]
        assert got == [own, other, follower]


def test_repeated_rows_and_empty_table(awkward, empty):
    many = awkward.union(awkward).union(awkward)
    assert simhash.edited(many, "doc_id", "text", 5).count() == many.count()
    assert simhash.edited(empty, "doc_id", "text", 5).count() == 0
    one = simhash.edited(awkward.filter("doc_id = 5"), "doc_id", "text", 5).collect()
    assert len(one) == 1 and one[0]["edited_text"] == " a  a "[:3] + " a "


def test_query(spark, folder):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    want = rows_of(docs)
    rows = queries.queries()["op7_simhash"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, edited, own, other, follower = want[r["doc_id"]]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{own:016x}", f"{other:016x}")
        assert r["near_edited"] == 1 - bin(own ^ other).count("1") / 64
        assert r["near_next"] == 1 - bin(own ^ follower).count("1") / 64


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 3), (3, 6)])
def test_search_finds_all_in_radius(spark, radius, blocks):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(20)]
    signed = [p - 2**64 if p >> 63 else p for p in prints] + [None, signed_zero := 0, signed_zero]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    asked = df.limit(30)
    got = {tuple(r) for r in simhash.within_radius(asked, df, radius, blocks).collect()}
    want = set()
    for a in {r[0] for r in asked.collect() if r[0] is not None}:
        for b in {p for p in signed if p is not None}:
            d = bin((a ^ b) & (2**64 - 1)).count("1")
            if d <= radius:
                want.add((a, b, d))
    assert got == want


def test_search_query(spark, folder):
    prints = {r["doc_id"]: r["fingerprint"] for r in queries.queries()["op7_simhash"](spark, folder).collect()}
    got = {(r["doc_id"], r["near_fingerprint"]): (r["distance"], r["documents"])
           for r in queries.queries()["fingerprint_search"](spark, folder).collect()}
    want = {}
    for key, own in prints.items():
        if key % 20 == 0:
            for other in set(prints.values()):
                d = bin(int(own, 16) ^ int(other, 16)).count("1")
                if d <= 3:
                    want[key, other] = (d, list(prints.values()).count(other))
    assert got == want


def test_words_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  ")], "k int, text string")
    out = simhash.fingerprints(df.select("k", simhash.words(F.col("text")).alias("t")), ["k"], "t").collect()
    assert sorted((r["k"], r["fingerprint"]) for r in out) == [(1, 0), (2, 0), (3, 0)]
