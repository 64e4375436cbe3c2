"""Near-duplicates by order MinHash, verified by banded alignment.

A text is the sequence of its five-word k-mers (lower-case words; a shorter text is one
k-mer), each labelled with its number of earlier occurrences, so that no labelled k-mer
comes twice. A sketch takes the few labelled k-mers with the smallest seeded hashes and
keeps them in text order; texts that agree in a whole sketch share a bucket. Texts at the
threshold share no bucket with a chance of about one in 10^5 (see LEVELS).

Candidates are verified by aligning the labelled k-mers of both texts inside a band.
As none comes twice, the best alignment is a longest increasing subsequence. With M
aligned of n and m k-mers the similarity is M / (n + m - M): the Jaccard similarity of
the labelled k-mers if their order agrees, less otherwise. No pair outside the band can
belong to an alignment that reaches the threshold.

Classes are the connected components of the links. Within a bucket, every text is compared
with the bucket's smallest. After a first round of components, the texts outside their
bucket's main component are compared with all members of other components, in blocks of at
most BLOCK by BLOCK texts inside the tasks, so every pair of a bucket that components leave
open is verified, and only links become rows. A large group of copies costs one comparison
a text. Exact copies are one text from the start. No group is ever gathered in one
task, and links never reach the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table, unused
from stayline.sources.store import store

K = 5
SIMILARITY = 0.8
# (least k-mers, k-mers below, smallest hashes in a sketch, sketches). Ranges overlap by
# more than the threshold, so two similar texts always have a range in common. At
# similarity 0.8 a sketch agrees with a chance of at least 0.4, 0.26 and 0.26.
LEVELS = [(1, 16, 3, 20), (12, 80, 5, 32), (64, 1 << 62, 6, 40)]
_WORD = re.compile(r"\w+")
_KNOWN: dict[str, int] = {}
TABLE_WORDS = 300_000
CELLS = 1 << 20  # hashes computed at once
BLOCK = 256  # texts on either side of a block of comparisons


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(text: str) -> np.ndarray:
    """32-bit hashes of a text's words, in order."""
    words = _WORD.findall(text.lower())
    try:
        return np.array([_KNOWN[w] for w in words], dtype=np.uint32)
    except KeyError:
        if len(_KNOWN) > TABLE_WORDS:
            _KNOWN.clear()
        for w in set(words):
            if w not in _KNOWN:
                _KNOWN[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.array([_KNOWN[w] for w in words], dtype=np.uint32)


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of the k-mers with their occurrence numbers; all differ."""
    if not len(words):
        return np.zeros(0, np.uint64)
    k, w = min(K, len(words)), words.astype(np.uint64)
    n = len(w) - k + 1
    kmers = np.full(n, k, np.uint64)
    for i in range(k):
        kmers = _mix(kmers ^ (w[i : i + n] + np.uint64(i + 1)))
    order = np.argsort(kmers, kind="stable")
    same = kmers[order][1:] == kmers[order][:-1]
    if same.any():
        starts = np.concatenate([[True], ~same])
        at = np.arange(n)
        earlier = at - np.maximum.accumulate(np.where(starts, at, 0))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = earlier
        kmers = _mix(kmers + occurrence * np.uint64(0x9E3779B97F4A7C15))
    return kmers


def sketches(kmers: np.ndarray) -> list[int]:
    """One bucket for each sketch: 64-bit hashes of level, sketch number and the chosen
    k-mers in text order."""
    out, n = [], len(kmers)
    for level, (least, below, length, count) in enumerate(LEVELS):
        if not least <= n < below:
            continue
        take, step = min(length, n), max(1, CELLS // n)
        for at in range(0, count, step):
            seeds = _SEEDS[at : min(at + step, count)]
            drawn = _mix(kmers[None, :] ^ seeds[:, None])
            near = np.argpartition(drawn, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(seeds), 1))
            chosen = kmers[np.sort(near, axis=1)]
            h = seeds + np.uint64(level)
            for i in range(take):
                h = _mix(h ^ (chosen[:, i] + np.uint64(i + 1)))
            out += h.view(np.int64).tolist()
    return out


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two arrays of labelled k-mers: aligned / (all of both - aligned);
    below `least` it may be an upper bound that is also below."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    bound = min(n, m) / max(n, m)
    if bound < least:
        return bound
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (1 - least) / (1 + least) * (n + m) + 1
    inside = np.abs(at - to) <= band
    at, to = at[inside], to[inside]
    both = len(at)
    if both / (n + m - both) < least:
        return both / (n + m - both)
    to = to[np.argsort(at)]
    if (np.diff(to) < 0).any():
        tails: list[int] = []
        for x in to.tolist():
            i = bisect_left(tails, x)
            tails[i : i + 1] = [x]
        both = len(tails)
    return both / (n + m - both)


# -- Spark --------------------------------------------------------------------


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, lists = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            words = word_hashes(text)
            kmers = labelled_kmers(words)
            said = " ".join(_WORD.findall(text.lower())) if len(words) else "\x00" + text
            keys.append(blake2b(said.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            lists.append(sketches(kmers))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), batch.column("raw"), pa.array(keys, pa.binary()),
             pa.array(lists, pa.list_(pa.int64()))],
            ["row", "id", "raw", "key", "buckets"],
        )


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [word_hashes(t.as_py() or "").view(np.int32) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(lists, pa.list_(pa.int32()))], ["node", "words"])


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("a_words", "b_words"):
                column = batch.column(name)
                sides.append((column.offsets.to_numpy(), column.values.to_numpy().view(np.uint32)))
            (ao, av), (bo, bv) = sides
            good, last, known = [], None, None
            left = batch.column("a").to_numpy()
            for i in range(batch.num_rows):
                if left[i] != last:
                    last, known = left[i], labelled_kmers(av[ao[i] : ao[i + 1]])
                good.append(aligned(known, labelled_kmers(bv[bo[i] : bo[i + 1]]), least) >= least)
            links = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            if links.num_rows:
                yield links

    return run


def _flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All values of some arrays, and the number of the array each comes from."""
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def _blocks_compared(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the strays and the members of one block of a bucket. A pair that
        shares a smaller bucket is left to that one."""
        links: list[tuple[int, int]] = []
        strays, members = rows[rows["stray"]], rows[~rows["stray"]]
        if len(strays) and len(members):
            bucket = rows["bucket"].iloc[0]
            node, root = members["node"].to_numpy(), members["root"].to_numpy()
            kmers = [labelled_kmers(w.astype(np.int32).view(np.uint32)) for w in members["words"]]
            sizes = np.array([len(k) for k in kmers])
            buckets, bucket_of = _flat(list(members["buckets"]))
            smaller = buckets < bucket
            buckets, bucket_of = buckets[smaller], bucket_of[smaller]
            flat, of = _flat(kmers)
            for own, own_root, words, own_buckets in strays[["node", "root", "words", "buckets"]].itertuples(index=False):
                mine = labelled_kmers(words.astype(np.int32).view(np.uint32))
                open_ = (root != own_root) & (np.minimum(sizes, len(mine)) >= least * np.maximum(sizes, len(mine)))
                if not open_.any():
                    continue
                open_[bucket_of[np.isin(buckets, own_buckets)]] = False
                if not open_.any():
                    continue
                inside = open_[of]
                sought, sorted_ = flat[inside], np.sort(mine)
                at = np.minimum(np.searchsorted(sorted_, sought), len(sorted_) - 1)
                both = np.bincount(of[inside][sorted_[at] == sought], minlength=len(node))
                for i in np.flatnonzero(open_ & (both >= least * (sizes + len(mine) - both))):
                    if aligned(mine, kmers[i], least) >= least:
                        links.append((min(own, node[i]), max(own, node[i])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b); root is the smallest node it is connected
    to. Labels pass along links and jump to their labels' labels until nothing changes."""
    both = store(links.union(links.select("b", "a")).distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(heard, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = lower.join(jump, "root").select("node", F.least("root", "far").alias("root"), "was")
        after = store(after, "labels")
        labels = after.select("node", "root")
        if after.filter("root <> was").isEmpty():
            return labels


class Duplicates:
    """Classes of near-duplicate texts of one table.

    `rows` has, for every row of df, row (a number), id, raw (hash of the text), key (of the
    normalised text) and buckets; `nodes` has the smallest row of each key.
    """

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY):
        self.least = least
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        self.texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("raw"))
        made = self.texts.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "raw", "text").mapInArrow(
            _sketched, "row long, id long, raw long, key binary, buckets array<long>")
        self.rows = store(made, "sketches")
        self.nodes = self.rows.groupBy("key").agg(F.min("row").alias("node"))

    def members(self) -> DataFrame:
        """(bucket, node, pivot) of buckets that at least two different texts share."""
        firsts = self.rows.select("row", "buckets").join(self.nodes.select(F.col("node").alias("row")), "row", "left_semi")
        every = firsts.select(F.explode("buckets").alias("bucket"), F.col("row").alias("node"))
        shared = every.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("most")).filter("pivot <> most")
        return store(every.join(shared.select("bucket", "pivot"), "bucket"), "members")

    def words(self, members: DataFrame) -> DataFrame:
        """(node, words) of the texts in shared buckets."""
        wanted = members.select("node").distinct().join(self.rows.select(F.col("row").alias("node"), "id", "raw"), "node")
        same = (wanted["raw"] == self.texts["raw"]) & wanted["id"].eqNullSafe(self.texts["id"])
        texts = self.texts.join(wanted, same).select("node", "text")
        words = texts.mapInArrow(_worded, "node long, words array<int>")
        return store(words.dropDuplicates(["node"]), "words")

    def verified(self, pairs: DataFrame, words: DataFrame) -> DataFrame:
        """The pairs (a, b) whose similarity reaches the threshold."""
        sides = pairs.join(words.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b").join(
            words.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a")
        return store(sides.select("a", "b", "a_words", "b_words").mapInArrow(_verified(self.least), "a long, b long"), "links")

    def roots(self) -> DataFrame:
        """(node, root) of the texts that have a near-duplicate with another text."""
        members = self.members()
        words = self.words(members)
        stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        links = self.verified(stars, words)
        first = components(links)
        # what the first components leave open, bucket by bucket
        placed = members.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mains = placed.filter("node = pivot").select("bucket", F.col("root").alias("main"))
        placed = store(placed.join(mains, "bucket").withColumn("stray", F.col("root") != F.col("main")), "placed")
        placed = placed.filter("node <> pivot")  # pivots met all members
        sizes = placed.groupBy("bucket").agg(
            F.count_if("stray").alias("strays"), F.count(F.lit(1)).alias("all"),
            F.min("root").alias("least"), F.max("root").alias("most"),
        ).filter("strays > 0 and least <> most")
        parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
        open_ = placed.join(
            sizes.select("bucket", parts("strays").alias("columns"), parts("all").alias("rows")), "bucket")
        draw = F.xxhash64("node")
        each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        as_member = open_.withColumn("row", F.pmod(draw, F.col("rows")).cast("int")).withColumn("column", F.explode(each("columns")))
        as_stray = open_.filter("stray").withColumn("column", F.pmod(draw, F.col("columns")).cast("int")).withColumn("row", F.explode(each("rows")))
        dealt = as_member.withColumn("stray", F.lit(False)).unionByName(as_stray)
        texts = words.join(self.rows.select(F.col("row").alias("node"), "buckets"), "node")
        dealt = dealt.select("bucket", "row", "column", "node", "root", "stray").join(texts, "node")
        more = dealt.groupBy("bucket", "row", "column").applyInPandas(_blocks_compared(self.least), "a long, b long")
        more = store(more.distinct(), "links")
        return first if more.isEmpty() else components(links.union(more))

    def classes(self) -> DataFrame:
        """(row, id, raw, class, class_id) for every row: class is a number, class_id the
        smallest id of the class (null if it has none)."""
        placed = self.rows.select("row", "id", "raw", "key").join(self.nodes, "key").drop("key")
        placed = placed.join(self.roots(), "node", "left").select("row", "id", "raw", F.coalesce("root", "node").alias("class"))
        placed = store(placed, "classes")
        named = placed.groupBy("class").agg(F.min("id").alias("class_id"))
        return placed.join(named, "class")


def duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, class_id) for every row of df: the smallest id of its class of near-duplicates.

    Equal words make equal texts. Null texts count as empty; texts without words are
    alike only if they are equal; texts of any length are compared whole; repeated rows are
    in one class; rows without an id have the class of their text; an empty table gives an
    empty one. Other columns of df are not looked at.
    """
    out = Duplicates(df, id_col, text_col, least).classes()
    return out.select(F.col("id").alias(id_col), "class_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The row of each class with the smallest id (ids before none), with df's own columns."""
    found = Duplicates(df, id_col, text_col, least).classes()
    own, key, raw, alike = unused(df, "_own", "_id", "_raw", "_alike")
    best = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    kept = found.groupBy("class").agg(best.alias("best")).select(F.col("best.row").alias("row"))
    same = found.groupBy("id", "raw").agg(F.count(F.lit(1)).alias(alike))
    kept = found.select("row", "id", "raw").join(kept, "row", "left_semi")
    kept = kept.join(same, kept["id"].eqNullSafe(same["id"]) & (kept["raw"] == same["raw"])).select(
        kept["id"].alias(key), kept["raw"].alias(raw), alike)
    marked = df.withColumn(own, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    out = marked.join(kept, (marked[own] == kept[raw]) & marked[f"`{id_col}`"].cast("long").eqNullSafe(kept[key]))
    once = out.filter(F.col(alike) == 1)
    repeated = out.filter(F.col(alike) > 1).dropDuplicates([key, raw])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in df.columns])


@query("op3_order_minhash")
def op3(spark, sf_dir):
    """The class of near-duplicates of every document."""
    return duplicate_classes(table(spark, sf_dir, "documents"))
