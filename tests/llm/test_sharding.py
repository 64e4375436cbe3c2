"""Shards: every row once, counts at most one apart, gapless slots, mixed order."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayline.llm import queries, sharding



def size():
    return F.octet_length(F.coalesce("text", F.lit(""))) + 16


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 2000])
def test_every_row_once(awkward, bucket_bytes):
    many = awkward.union(awkward)
    out = sharding.shards(many, 7, size(), bucket_bytes=bucket_bytes).collect()
    key = lambda r: tuple(r[c] for c in many.columns)
    assert Counter(map(key, out)) == Counter(map(key, many.collect()))
    slots = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_few_rows_and_none(awkward, empty):
    assert sharding.shards(empty, 4, size()).count() == 0
    rows = sharding.shards(awkward.limit(2), 40, size()).collect()
    assert len({r["shard"] for r in rows}) == 2 and all(r["slot"] == 0 for r in rows)


def test_one_hot_row_spreads_over_buckets(spark):
    hot = spark.range(0, 3000, 1, 4).select(F.lit(1).alias("doc_id"), F.lit("copy").alias("text"))
    pieces = sharding.scatter(hot, size(), 3, 6000)
    counts = [r["count"] for r in pieces.groupBy("bucket").count().collect()]
    assert len(counts) == 10 and max(counts) < 400


def test_order_is_mixed_and_repeatable(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    run = lambda seed: [r["doc_id"] for r in sharding.shards(docs, 3, size(), seed).orderBy("shard", "slot").collect()]
    first = run(1)
    assert first == run(1) and first != run(2) and first != sorted(first)
    kept = sum(abs(a - b) == 1 for a, b in zip(first, first[1:]))
    assert kept < len(first) / 5


def test_written_shards(spark, awkward, tmp_path):
    sharding.write_shards(sharding.shards(awkward, 3, size()), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == awkward.count() and back.select("shard").distinct().count() == 3


def test_query(spark, folder):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.queries()["op10_external_shuffle"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(docs[r["doc_id"]]) + 16, zlib.crc32(docs[r["doc_id"]]))
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 40


def test_digests_are_those_of_the_shuffled_records(spark, folder, monkeypatch):
    """A record changed in a bucket file changes the result."""
    def harmed(df, name):
        kept = sharding_store(df, name)
        text = F.when(F.col("record.doc_id") == 7, "changed").otherwise(F.col("record.text"))
        return kept.withColumn("record", F.col("record").withField("text", text))

    sharding_store = sharding.store
    before = {r["doc_id"]: r for r in sharding.op10(spark, folder).collect()}
    monkeypatch.setattr(sharding, "store", harmed)
    after = {r["doc_id"]: r for r in sharding.op10(spark, folder).collect()}
    assert after[7]["text_crc32"] == zlib.crc32(b"changed") != before[7]["text_crc32"] and after[7]["size"] == 23
    assert all(after[i]["text_crc32"] == before[i]["text_crc32"] for i in before if i != 7)


def test_clashing_names(spark, awkward, tmp_path):
    clash = awkward.withColumnsRenamed({"lang": "shard", "score": "slot", "count": "place", "source": "bucket"})
    out = sharding.shards(clash, 3, size())
    assert out.columns == [*clash.columns, "shard_", "slot_"]
    key = lambda r: tuple(r[c] for c in clash.columns)
    assert Counter(map(key, out.collect())) == Counter(map(key, clash.collect()))
    sharding.write_shards(out, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == clash.count()


def test_shard_sizes_equal_sql(spark, folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = sorted(con.execute(f"SELECT shard, rows FROM ({sharding.SQL})").fetchall())
    assert sorted((r["shard"], r["rows"]) for r in sharding.shard_sizes(spark, folder).collect()) == want
