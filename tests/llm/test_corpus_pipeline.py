"""The pipeline against its operators' own decisions, stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from stayline.llm import order_minhash, quality, secret_scan, toxicity

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before and after every stage."""
    from stayline.sources.store import store

    out = [spark.read.parquet(f"{BIG}/documents.parquet")]
    for name, stage in P.STAGES:
        out.append(store(stage(spark, out[-1], BIG), name))
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_registered():
    assert entry.queries()["pipeline"] is P.run
    assert [name for name, _ in P.STAGES] == ["toxicity", "quality", "near-duplicates", "secrets", "packing"]


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])


def test_rejections(spark, stages):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    for at, module, keeps in ((0, toxicity, lambda s: s < 0.5), (1, quality, lambda s: s >= 0.3)):
        before, after = by_id(stages[at]), by_id(stages[at + 1])
        model = module.fitted(stages[at], labels)
        score = (lambda t: model.score(t)) if at == 0 else (lambda t: model.score([t])[0])
        assert set(after) == {i for i, r in before.items() if keeps(score(r["text"]))}
        assert len(after) > 0.8 * len(before)


def test_one_of_each_class(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    classes = {r["doc_id"]: r["class_id"] for r in order_minhash.duplicate_classes(stages[2]).collect()}
    assert set(after) == {i for i, c in classes.items() if i == c} and len(after) < len(before)


def test_no_base_secret_is_left(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    changed = [i for i in before if before[i]["text"] != after[i]["text"]]
    assert changed and all("[SECRET]" in after[i]["text"] and after[i]["n_chars"] == len(after[i]["text"]) for i in changed)
    again = secret_scan.scan(stages[4], "text").filter("size(base) > 0")
    assert again.count() == 0


def test_packing_and_run(spark, stages):
    rows = by_id(stages[5])
    assert set(rows) == set(by_id(stages[4]))
    assert {(r["doc_id"], r["n_tokens"]) for r in P.run(spark, BIG).collect()} == {(i, r["n_tokens"]) for i, r in rows.items()}


def test_awkward_documents(spark, awkward, empty):
    for docs in (awkward.withColumn("n_chars", awkward["doc_id"]), empty, awkward.withColumn("_spans", awkward["text"])):
        out = docs
        for name, stage in P.STAGES[:-1]:
            out = P.store(stage(spark, out, BIG), name)  # as run does: no stage is computed twice
            assert out.columns == docs.columns
        if "_spans" in docs.columns:  # a clashing column passes through
            assert {r["_spans"] for r in out.collect()} <= {r["text"] for r in docs.collect()}
        assert P.pack(spark, out, BIG).count() == out.count()
