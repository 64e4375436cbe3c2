"""Packing documents into batches by optimal length buckets.

One pass makes the global histogram of lengths. Dynamic programming over it chooses the
bucket boundaries with the least padding, when every document is padded to its bucket's
longest. Inside a bucket, batches take as many documents as fit the token budget at that
length; only the last batch of a bucket may be smaller.

Places within a bucket are numbered without gathering it: rows are dealt by a seeded hash
of the row and its place in the input to chunks of about CHUNK_ROWS, numbered in their
chunk, and moved up by the sizes of the chunks before. The rows carried are ids and lengths.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.registry import query, table
from stayline.sources.store import store

BUCKETS = 16
BUDGET = 65_536  # tokens in a batch, padding included
EXACT = 4096  # lengths up to here are bins of their own; above, 128 bins a doubling
CHUNK_ROWS = 50_000


def tokens(text: Column | str) -> Column:
    """Number of words, split at white space; 0 for null and blank texts."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(r"\S+")), F.lit(0)).cast("int")


def bin_of(length: Column) -> Column:
    """The bin of a length: the largest length it can hold."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - 7).cast("long")
    return F.when(length <= EXACT, length.cast("long")).otherwise(F.ceil(length / step) * step).cast("long")


def boundaries(longest: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Last bin of each bucket, for bins in ascending order with their longest length, number
    and total length of documents: the split into at most `buckets` runs with the least
    padding. Each further bucket is placed by divide and conquer, as the best start of a
    run never moves back when its end moves on."""
    m = len(longest)
    n, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(totals)])

    def padding(starts: np.ndarray, end: int) -> np.ndarray:
        return longest[end] * (n[end + 1] - n[starts]) - (t[end + 1] - t[starts])

    best = np.array([padding(np.array([0]), j)[0] for j in range(m)], dtype=float)
    came = []
    for _ in range(1, min(buckets, m)):
        after, start = best.copy(), np.zeros(m, int)
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            starts = np.arange(first, min(mid, last) + 1)
            cost = np.where(starts > 0, best[starts - 1], 0.0) + padding(starts, mid)
            at = int(cost.argmin())
            after[mid], start[mid] = cost[at], starts[at]
            todo += [(lo, mid - 1, first, int(starts[at])), (mid + 1, hi, int(starts[at]), last)]
        came.append(start)
        best = after
    ends, end = [], m - 1
    for start in reversed(came):
        ends.append(end)
        end = int(start[end]) - 1
        if end < 0:
            break
    else:
        ends.append(end)
    return ends[::-1]


def length_bounds(lengths: DataFrame, length_col: str, buckets: int) -> list[tuple[int, int, int]]:
    """(largest bin, longest document, documents) of every bucket. The histogram has a row
    for each bin, at most EXACT and 128 for each doubling above."""
    rows = (
        lengths.groupBy(bin_of(F.col(length_col)).alias("bin"))
        .agg(F.max(length_col).alias("longest"), F.count(F.lit(1)).alias("n"), F.sum(length_col).alias("total"))
        .orderBy("bin").collect()
    )
    if not rows:
        return []
    longest, counts, totals = (np.array([r[c] for r in rows], dtype=float) for c in ("longest", "n", "total"))
    out, begin = [], 0
    for end in boundaries(longest, counts, totals, buckets):
        out.append((int(rows[end]["bin"]), int(longest[end]), int(counts[begin : end + 1].sum())))
        begin = end + 1
    return out


def packed(
    df: DataFrame, length: Column, id_cols: list[str], buckets: int = BUCKETS, budget: int = BUDGET,
    chunk_rows: int = CHUNK_ROWS, seed: int = 23,
) -> DataFrame:
    """id_cols, n_tokens, bucket, padded_to, batch, slot for every row of df.

    bucket counts from 0 by length, padded_to is its longest length, batch is a number from
    0 over all buckets, without gaps, and slot the place in it. A document longer than the
    budget has a batch of its own, whole. Null lengths count as 0; ties fall to the hash;
    repeated rows are rows of their own; an empty table gives an empty one. Other columns
    of df are not carried.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in id_cols], F.coalesce(length, F.lit(0)).cast("int").alias("n_tokens"))
    rows = rows.withColumn("_draw", F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), *[F.col(f"`{c}`") for c in id_cols]))
    rows = store(rows, "lengths")
    bounds = length_bounds(rows, "n_tokens", buckets) or [(0, 0, 0)]
    fits = [max(1, budget // max(1, longest)) for _, longest, _ in bounds]
    batches = [-(-n // fit) for (_, _, n), fit in zip(bounds, fits)]
    before = [sum(batches[:i]) for i in range(len(bounds))]
    chunks = [max(1, round(n / chunk_rows)) for _, _, n in bounds]

    def of_bucket(values: list[int]) -> Column:
        return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket"))

    bucket = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(bin_of(F.col("n_tokens")) <= bounds[i][0], i).otherwise(bucket)
    rows = rows.withColumn("bucket", bucket).withColumn("_chunk", F.pmod(F.xxhash64(F.lit(seed + 1), "_draw"), of_bucket(chunks)))
    counts = rows.groupBy("bucket", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    start = F.sum("n").over(Window.partitionBy("bucket").orderBy("_chunk")) - F.col("n")
    starts = counts.select("bucket", "_chunk", start.alias("_start"))
    place = F.row_number().over(Window.partitionBy("bucket", "_chunk").orderBy("_draw", *[F.col(f"`{c}`") for c in id_cols])) - 1
    rows = rows.withColumn("_place", place).join(starts, ["bucket", "_chunk"]).withColumn("_at", F.col("_start") + F.col("_place"))
    rows = rows.withColumn("_fit", of_bucket(fits))
    return rows.select(
        *[F.col(f"`{c}`") for c in id_cols], "n_tokens", F.col("bucket").cast("int").alias("bucket"),
        of_bucket([b[1] for b in bounds]).cast("int").alias("padded_to"),
        (of_bucket(before) + F.expr("_at div _fit")).alias("batch"), F.pmod("_at", "_fit").cast("int").alias("slot"),
    )


@query("op5_length_buckets")
def op5(spark, sf_dir):
    """All documents in batches of at most 65,536 padded words."""
    return packed(table(spark, sf_dir, "documents"), tokens("text"), ["doc_id"])
