"""Shards in random order by a two-pass external shuffle.

Pass one scatters the records with a seeded hash into buckets small enough for the
memory of one task and stores them in the shared folder. Pass two gathers one bucket
at a time, permutes it (Spark's `shuffle(array, seed)` is a Fisher-Yates shuffle) and
numbers the records: all of bucket 0, then bucket 1, and so on. Equal slices of that
order are the shards, so their counts are at most one apart.

The hash covers the record and its place in the input, so repeated rows and one very
frequent key spread over all buckets. The place is stable for stored tables, whose
splits are read again alike; store other inputs first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.registry import query, table, unused
from stayline.sources.store import store

BUCKET_BYTES = 16 << 20


def scatter(df: DataFrame, size: Column, seed: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Pass one: the rows as `record`, with `bucket` and a sort key `draw`, stored."""
    total = df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    draw = F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), *[F.col(c) for c in df.columns])
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("record"), draw.alias("draw"))
    return store(rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.lit(buckets))), "buckets")


def shuffled(df: DataFrame, size: Column, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """All rows of df with `place` (see `unused`), their position from 0 in one random order, and
    the number of rows. `size` is the expected bytes of a row; buckets are about
    `bucket_bytes`, whatever the number of rows. An empty table stays empty."""
    pieces, (place,) = scatter(df, size, seed, bucket_bytes), unused(df, "place")
    counts = pieces.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))  # one row a bucket
    rows = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    starts = counts.select(
        "bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start")
    )
    gathered = (
        pieces.groupBy("bucket")
        .agg(F.array_sort(F.collect_list(F.struct("draw", "record"))).alias("rows"))
        .sortWithinPartitions("bucket")
        .select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
    )
    placed = (
        gathered.join(starts, "bucket")
        .select("start", F.posexplode("rows").alias("pos", "row"))
        .select(F.col("row.record.*"), (F.col("start") + F.col("pos")).alias(place))
    )
    return placed, rows


def shards(
    df: DataFrame, n_shards: int, size: Column, seed: int = 17, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Every row of df with `shard` (0 to n_shards - 1) and `slot` (from 0, without gaps).

    Law: row counts of shards are at most one apart. Whole records are shuffled: what is
    returned has been through the bucket files. Nulls, empty and very long texts, ties and
    repeated rows are ordinary records; none is lost or merged. Where df has columns of these
    names, underscores behind the new ones keep them apart (`unused`).
    """
    shard_as, slot_as = unused(df, "shard", "slot")
    placed, rows = shuffled(df, size, seed, bucket_bytes)
    place = placed.columns[-1]
    shard = F.expr(f"cast(`{place}` * {n_shards} div {max(rows, 1)} as int)")
    first = F.expr(f"(cast(`{shard_as}` as long) * {max(rows, 1)} + {n_shards - 1}) div {n_shards}")
    return placed.withColumn(shard_as, shard).withColumn(slot_as, F.col(place) - first).drop(place)


def write_shards(sharded: DataFrame, path: str, parts: int = 1) -> None:
    """Writes each shard to its own folder, rows in slot order; `parts` files a shard. The last two
    columns are shard and slot, as `shards` leaves them."""
    shard, slot = sharded.columns[-2:]
    files = F.pmod(F.col(slot), F.lit(parts))
    (
        sharded.repartition(F.col(shard), files)
        .sortWithinPartitions(shard, slot)
        .write.partitionBy(shard)
        .parquet(path)
    )


N_SHARDS = 40


@query("op10_external_shuffle")
def op10(spark, sf_dir):
    """Documents in 40 shards of equal row counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    shuffled_docs = shards(table(spark, sf_dir, "documents").select("doc_id", "text"), N_SHARDS, size)
    return shuffled_docs.select(
        "doc_id", size.alias("size"), F.crc32(text).cast("long").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


SQL = """
select shard, count(*) as rows from (
    select (row_number() over () - 1) * 40 // (select count(*) from documents) as shard from documents)
group by shard
"""


@query("shard_sizes", SQL)
def shard_sizes(spark, sf_dir):
    """How many documents each shard of op10_external_shuffle holds, by its greatest slot."""
    return op10(spark, sf_dir).groupBy(F.col("shard").cast("long").alias("shard")).agg((F.max("slot") + 1).alias("rows"))
