"""SimHash fingerprints, and all fingerprints within a Hamming radius. SQL functions only.

Terms are the distinct lower-case words of a text, split at white space; each votes with
its number of characters, so that short function words count little, for the bits of its
64-bit hash that are set and against the others. A bit of the fingerprint is set if more
than half of the weight is for it. Two counters share one 64-bit sum: a text's weight is
below 2^31, so the low counter never overflows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.registry import query, table
from stayline.sources.store import store

BITS = 64
_PAIR = 0x0000000100000001


def words(text: Column) -> Column:
    """Distinct terms of a text. Null and blank texts have the empty term, which has no weight."""
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"))


def fingerprints(df: DataFrame, keys: list[str], terms: str) -> DataFrame:
    """One row for each group of equal `keys` with `fingerprint` (long), from one row for
    each text with its array of terms. Texts without terms have fingerprint 0."""
    votes = df.select(*keys, F.explode(terms).alias("_term"))
    votes = votes.select(
        *keys,
        F.xxhash64("_term").alias("_hash"),
        F.char_length("_term").cast("long").alias("_weight"),
    )
    sums = [
        F.sum(F.shiftrightunsigned("_hash", j).bitwiseAND(F.lit(_PAIR)) * F.col("_weight")).alias(f"_s{j}")
        for j in range(BITS // 2)
    ]
    summed = votes.groupBy(*keys).agg(F.sum("_weight").alias("_weight"), *sums)
    print_ = F.lit(0).cast("long")
    for j in range(BITS // 2):
        low = F.col(f"_s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_s{j}", 32)
        for votes_for, bit in ((low, j), (high, j + 32)):
            one = F.shiftleft(F.lit(1).cast("long"), bit)
            print_ = print_.bitwiseOR(F.when(votes_for * 2 > F.col("_weight"), one).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, print_.alias("fingerprint"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits of two fingerprints."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def as_hex(fingerprint: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


# -- search within a radius ---------------------------------------------------


def block_keys(fingerprint: Column, radius: int, blocks: int) -> Column:
    """Array of (table, key): for every choice of blocks - radius blocks one permuted
    table, keyed by the bits of these blocks. Two fingerprints within the radius differ in
    at most `radius` blocks, so they share a key in some table."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for i in chosen:
            mask |= ((1 << (edges[i + 1] - edges[i])) - 1) << edges[i]
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.struct(F.lit(number).alias("table"), fingerprint.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All (query_fingerprint, fingerprint, distance) with distance <= radius.

    Both frames have a column `fingerprint`; equal fingerprints are taken once, so a large
    group of copies is one row, and nulls take no part. Exact: no cap on partners.
    """
    def keyed(df: DataFrame, name: str) -> DataFrame:
        distinct = df.filter(F.col("fingerprint").isNotNull()).select(F.col("fingerprint").alias(name)).distinct()
        return distinct.select(name, F.inline(block_keys(F.col(name), radius, blocks)))

    distance = F.bit_count(F.col("query_fingerprint").bitwiseXOR(F.col("fingerprint")))
    return (
        keyed(queries, "query_fingerprint")
        .join(keyed(rows, "fingerprint"), ["table", "key"])
        .select("query_fingerprint", "fingerprint", distance.alias("distance"))
        .filter(F.col("distance") <= radius)
        .distinct()
    )


# -- documents next to each other ---------------------------------------------


def with_next(df: DataFrame, order_col: str, text_col: str, blocks: int) -> DataFrame:
    """(block, place, border, id, text, next): every row with the text that follows it in
    ascending order_col (nulls first, ties by text hash), after the last row the first.

    Rows are dealt to blocks, ranges of order_col; the smallest row of each block is also
    sent, as border row, behind the end of the block before, so that each block can be
    worked on alone and texts move once. Cuts are approximate quantiles found in one pass:
    they decide which task has a row, never the result. What the driver sees is one row a
    block. order_col must be a number; many rows that share one value stay in one block.
    """
    rows = df.select(
        F.col(f"`{order_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    found = rows.stat.approxQuantile("id", [i / blocks for i in range(1, blocks)], 0.2 / blocks) if blocks > 1 else []
    cuts = sorted({int(c) for c in found})
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]

    def longs(values: list) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col("id")))

    block = F.lit(0)
    if cuts:  # first the group of cuts, then the cut in it
        group = passed(longs([g[0] for g in groups])) - 1
        block = F.when(group >= 0, group * step + passed(F.get(F.array(*map(longs, groups)), group))).otherwise(0)
    rows = rows.withColumn("block", F.coalesce(block, F.lit(0)))
    order = F.struct(F.col("id").isNotNull(), "id", "tie")
    first = sorted(rows.groupBy("block").agg(F.min(order).alias("first")).collect(), key=lambda r: r["block"])
    before = {r["block"]: first[i - 1]["block"] for i, r in enumerate(first)}
    is_first, target = F.lit(False), F.lit(0)
    if first:
        every = range(first[-1]["block"] + 1)
        starts = {r["block"]: r["first"] for r in first}
        of = lambda f: F.get(longs([f(b) if b in starts else None for b in every]), F.col("block"))
        is_first = F.col("id").eqNullSafe(of(lambda b: starts[b]["id"])) & (F.col("tie") == of(lambda b: starts[b]["tie"]))
        target = of(lambda b: before[b])
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("border"))
    border = F.struct(target.cast("int").alias("block"), F.lit(1).alias("border"))
    sent = rows.select("id", "text", "tie", F.inline(F.when(is_first, F.array(own, border)).otherwise(F.array(own))))
    in_block = Window.partitionBy("block").orderBy("border", F.asc_nulls_first("id"), "tie")
    return sent.select(
        "block", F.row_number().over(in_block).alias("place"), "border", "id", "text",
        F.lead("text").over(in_block).alias("next"),
    )


def edited(df: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    """One row for each row of df: id, n_chars, edited_text, fingerprint,
    edited_fingerprint, next_fingerprint (long).

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next row's text. Null texts count as empty; empty texts have
    fingerprint 0; very long texts are taken whole; repeated rows each have their row; an
    empty table gives an empty one; other columns of df are not looked at.
    """
    half = F.expr("n_chars div 2").cast("int")
    near = (
        with_next(df, id_col, text_col, blocks)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited_text", F.concat(
            F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring(F.coalesce("next", F.lit("")), F.lit(1), half),
        ))
    )
    own = F.struct(F.lit(0).alias("kind"), words(F.col("text")).alias("terms"))
    other = F.struct(F.lit(1).alias("kind"), words(F.col("edited_text")).alias("terms"))
    terms = near.select(
        "block", "place", F.inline(F.when(F.col("border") == 1, F.array(own)).otherwise(F.array(own, other)))
    )
    prints = fingerprints(terms, ["block", "place", "kind"], "terms").groupBy("block", "place").agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    prints = prints.withColumn(
        "next_fingerprint", F.lead("fingerprint").over(Window.partitionBy("block").orderBy("place"))
    )
    return (
        near.filter("border = 0").select("block", "place", "id", "n_chars", "edited_text")
        .join(prints, ["block", "place"]).drop("block", "place")
    )


def _blocks(spark) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("op7_simhash")
def op7(spark, sf_dir):
    """Fingerprints of all documents, of their edited texts and of their neighbours."""
    out = edited(table(spark, sf_dir, "documents"), "doc_id", "text", _blocks(spark))
    out = out.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        as_hex("fingerprint").alias("fingerprint"), as_hex("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


@query("fingerprint_search")
def fingerprint_search(spark, sf_dir):
    """For every document whose id is divisible by 20, all other fingerprints of the
    corpus within 3 bits, each with its number of documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("terms"))
    prints = store(fingerprints(docs, ["doc_id"], "terms"), "fingerprints")
    asked = prints.filter("doc_id % 20 = 0")
    held = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("documents"))
    near = within_radius(asked, prints).join(held, "fingerprint")
    near = near.withColumnRenamed("fingerprint", "near_fingerprint")
    return (
        asked.join(near, asked["fingerprint"] == near["query_fingerprint"])
        .select("doc_id", as_hex("query_fingerprint").alias("fingerprint"),
                as_hex("near_fingerprint").alias("near_fingerprint"), "distance", "documents")
    )
