"""Classes of near-duplicates against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from stayline.llm import order_minhash as M
from stayline.llm import queries


def similarity(a, b):
    """Longest common subsequence of labelled k-mers by the textbook table."""
    x, y = (M.labelled_kmers(M.word_hashes(t)).tolist() for t in (a, b))
    if not x or not y:
        return float(a == b)
    row = [0] * (len(y) + 1)
    for u in x:
        last = 0
        for j, v in enumerate(y, 1):
            row[j], last = (last + 1 if u == v else max(row[j], row[j - 1])), row[j]
    return row[-1] / (len(x) + len(y) - row[-1])


def classes_of(texts):
    """{id: smallest id it is connected to} by comparing all pairs."""
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if texts[a] == texts[b] or similarity(texts[a], texts[b]) >= M.SIMILARITY:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in texts}


def edited(words, rng, changes):
    out = list(words)
    for _ in range(changes):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] += "x"
        elif kind == 1:
            out.insert(at, "new")
        elif len(out) > 1:
            del out[at]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for n in (4, 9, 14, 20, 45, 70, 90, 200, 400):
        for _ in range(2):
            base = rng.choices(vocabulary, k=n)
            texts += [base, base] + [edited(base, rng, c) for c in range(1, 6)]
            texts.append(base[n // 2 :] + base[: n // 2])
    texts += [rng.choices(vocabulary, k=60) + passage for _ in range(15)]
    chain = rng.choices(vocabulary, k=120)
    for _ in range(12):  # neighbours alike, ends not
        texts.append(chain)
        chain = edited(chain, rng, 1)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def test_aligned_equals_table():
    rng = random.Random(9)
    for n in (3, 6, 30, 120):
        for changes in range(5):
            base = rng.choices([f"w{i}" for i in range(30)], k=n)
            a, b = " ".join(base), " ".join(edited(base, rng, changes))
            got = M.aligned(M.labelled_kmers(M.word_hashes(a)), M.labelled_kmers(M.word_hashes(b)))
            want = similarity(a, b)
            assert (got >= 0.8) == (want >= 0.8)
            if want >= 0.8:
                assert got == pytest.approx(want)


def test_labels_make_kmers_differ():
    kmers = M.labelled_kmers(M.word_hashes("a b " * 50))
    assert len(set(kmers.tolist())) == len(kmers) == 96
    assert len(M.labelled_kmers(M.word_hashes("one two"))) == 1
    assert M.sketches(M.labelled_kmers(np.zeros(0, np.uint32))) == []


def test_classes_equal_all_pairs(spark, corpus):
    df = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in M.duplicate_classes(df).collect()}
    assert got == classes_of(corpus)


def test_large_group_of_copies(spark):
    rng = random.Random(3)
    base = [f"v{rng.randrange(500)}" for _ in range(150)]
    rows = [(i, " ".join(base)) for i in range(300)] + [(i, " ".join(edited(base, rng, 1))) for i in range(300, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in M.duplicate_classes(df).collect()} == {0}
    assert [r["doc_id"] for r in M.keep_first(df).collect()] == [0]


def test_awkward_rows(awkward, empty):
    rows = [(r["doc_id"], r["class_id"]) for r in M.duplicate_classes(awkward).collect()]
    assert len(rows) == awkward.count()
    by_id = {i: c for i, c in rows if i is not None}
    assert by_id[11] == by_id[12] == 11 and (None, None) in rows
    assert by_id[0] == by_id[1] == 0 and by_id[2] == 2 and by_id[3] == 3
    kept = M.keep_first(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == set(by_id.values()) | {None}
    assert M.duplicate_classes(empty).count() == 0 and M.keep_first(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (200, 201)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in M.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100} | {200: 200, 201: 200}


def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r["class_id"] for r in queries.queries()["op3_order_minhash"](spark, folder).collect()}
    kmers = {i: M.labelled_kmers(M.word_hashes(t)) for i, t in texts.items()}
    root = {i: i for i in texts}
    for b in sorted(texts):
        for a in sorted(texts):
            if a < b and M.aligned(kmers[a], kmers[b]) >= M.SIMILARITY:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert got == root
