"""Newton-boosted trees: histograms of first and second derivatives, merged over partitions.

Each round fits a tree to the logistic loss at the current margins. A row has the derivative
g = (p - y) w and the curvature h = p (1 - p) w; a leaf is worth -G / (H + penalty), a split gains
GL^2 / (HL + penalty) + GR^2 / (HR + penalty) - G^2 / (H + penalty). Rows are binned once and
stay in their partitions: for each level of a tree every partition sums g and h by node,
feature and bin, the sums of one feature meet in one task, which proposes the best cut of
every node, and only these proposals reach the driver. Where the sums of all partitions are few
bytes (MERGED_BYTES), the driver adds them up itself: one stage a level in place of two. Sums are
whole numbers (fixed point), so the trees do not depend on partitioning or row order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions import synth
from stayline.operators.ordering import InOrder
from stayline.sources.store import save, store

MISSING = 255  # bin of null and NaN values
ONE = float(1 << 30)  # fixed-point unit of g and h
ROWS_A_TASK = 50_000
KEEP_ROUNDS = 5  # rounds after which margins are stored
LEAST_GAIN = 1e-6
MERGED_BYTES = 64 << 20  # sums of one level that the driver adds up, at most


@dataclass
class Tree:
    """Nodes in lists; node 0 is the root. Rows with bin <= `bin` of `feature` go left, missing
    values where `missing_left` says; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def leaf(self, value: float, cover: float) -> int:
        for name, x in (("feature", -1), ("bin", 0), ("missing_left", True), ("left", -1), ("right", -1),
                        ("value", value), ("cover", cover), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        missing = np.array(self.missing_left)
        at = np.zeros(len(bins), np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            x = bins[inner, feature[node]]
            goes = np.where(x == MISSING, missing[node], x <= cut[node])
            at[inner] = np.where(goes, left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        return at


@dataclass
class NewtonTrees:
    """A fitted model: feature names, the cuts of each, trees and the starting margin."""

    columns: list[str]
    cuts: list[list[float]]
    trees: list[Tree]
    base: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bins of rows of feature values: how many cuts lie below each."""
        out = np.empty(x.shape, np.uint8)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(cuts, x[:, f], side="left"))
        return out

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[tree.nodes_of(bins)]
        return out

    def margin(self) -> Column:
        """The margin of a row as a column over the features."""

        @F.arrow_udf("double")
        def margins(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch])
                yield pa.array(self.margins(x))

        return margins(*[F.col(c).cast("double") for c in self.columns])

    def score(self, df: DataFrame) -> DataFrame:
        """df with churn_prob, the probability of label 1."""
        return df.withColumn("churn_prob", 1 / (1 + F.exp(-self.margin())))

    def gains(self) -> list[float]:
        """Share of each feature in the gains of all splits; zeros without splits."""
        total = np.zeros(len(self.columns))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    total[f] += gain
        return (total / total.sum() if total.sum() else total).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a tree and one for the rest."""
        rows = [(-1, json.dumps([self.columns, self.cuts, self.base]))]
        rows += [(i, json.dumps(tree.__dict__)) for i, tree in enumerate(self.trees)]
        save(spark.createDataFrame(rows, "tree int, content string"), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NewtonTrees:
        rows = {r["tree"]: json.loads(r["content"]) for r in spark.read.parquet(path).collect()}
        columns, cuts, base = rows.pop(-1)
        return cls(columns, cuts, [Tree(**rows[i]) for i in sorted(rows)], base)


def cut_points(
    df: DataFrame, columns: list[str], key: str, bins: int, rows: int | None, seed: int, capped: bool = False
) -> list[list[float]]:
    """For each column at most `bins` - 1 values that split its rows evenly; each value of a column with
    fewer. The greatest value is no cut. All rows count, unless `rows` asks for a hashed draw of about
    so many. If `capped`, the rows of one value count as no more than a bin, so that common values
    leave cuts for the others."""
    if rows is not None:
        df = df.filter(synth.uniform(seed, "cuts", key) < min(1.0, rows / max(1, df.count())))
    fields = [F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    long = df.select(F.explode(F.array(*fields)).alias("e")).select("e.m", "e.v")
    counts = long.filter(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("m", "v").agg(F.count(F.lit(1)).alias("n"))
    ordered = InOrder(counts, "m", "v")
    sizes = {r["m"]: r for r in ordered.rows.groupBy("m").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.max("v").alias("greatest")).collect()}
    totals = {m: r["n"] for m, r in sizes.items()}
    if capped:
        ordered.rows, totals = _capped(ordered.rows, totals, bins)
    before, starts = 0, {}
    for m in sorted(totals):
        starts[m], before = before, before + totals[m]
    running = ordered.running({"until": "n"})
    # rank of the value's last row among its column's, in steps of the column's size
    step = lambda c, m: F.floor((c - starts[m]) * (bins - 1) / totals[m])
    crosses = F.lit(False)
    for m, r in sizes.items():
        jump = step(F.col("until"), m) > step(F.col("until") - F.col("n"), m)
        crosses = F.when(F.col("m") == m, F.lit(True) if r["kinds"] < bins else jump).otherwise(crosses)
    out: list[list[float]] = [[] for _ in columns]
    for r in running.filter(crosses).select("m", "v").orderBy("m", "v").collect():  # at most bins a column
        out[r["m"]].append(r["v"])
    return [[v for v in cuts if v < sizes[m]["greatest"]] for m, cuts in enumerate(out)]


def _capped(counts: DataFrame, totals: dict[int, int], bins: int) -> tuple[DataFrame, dict[int, int]]:
    """Counts n of values, at most a bin of the lowered totals each, and these totals, by column m.
    No value is lowered below a quarter of an even bin, so few counts need to be known here."""
    by_column = lambda of: F.coalesce(*[F.when(F.col("m") == m, F.lit(v)) for m, v in of.items()], F.lit(0))
    floor = {m: n // (4 * bins) + 1 for m, n in totals.items()}
    common: dict[int, list[int]] = {m: [] for m in totals}
    for r in counts.filter(F.col("n") > by_column(floor)).select("m", "n").collect():  # at most 4 * bins a column
        common[r["m"]].append(r["n"])
    caps, lowered = {}, {}
    for m, n in totals.items():
        cap, rest = float(n), n - sum(common[m])
        for _ in range(100):
            cap = (rest + sum(min(c, cap) for c in common[m])) / (bins - 1)
        caps[m] = max(floor[m], int(1.02 * cap) + 2)  # a little more than a bin: a cut follows each
        lowered[m] = rest + sum(min(c, caps[m]) for c in common[m])
    return counts.withColumn("n", F.least("n", by_column(caps)).cast("long")), lowered


def _derivatives(bins: np.ndarray, y: np.ndarray, margin: np.ndarray, trees: list[Tree], weight: float):
    """Whole-number g and h of some rows, margins with the newest trees."""
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.nodes_of(bins)]
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, weight, 1.0)
    return np.rint((p - y) * w * ONE), np.rint(np.maximum(p * (1 - p), 1e-16) * w * ONE), margin


def _unpacked(batch: pa.RecordBatch, width: int):
    column = batch.column("bins")  # as many bytes in every row
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    bins = np.frombuffer(column.buffers()[2], np.uint8)[first : first + batch.num_rows * width].reshape(-1, width)
    return bins, batch.column("y").to_numpy(), batch.column("margin").to_numpy()


def _summed(trees: list[Tree], growing: Tree, places: dict[int, int], width: int, weight: float):
    """Sums of g and h by feature, for each open node and bin, of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(places) * 256
        total = np.zeros((width, 2, size), np.int64)
        place = np.full(len(growing.feature), -1)
        place[list(places)] = list(places.values())
        for batch in batches:
            bins, y, margin = _unpacked(batch, width)
            slot = place[growing.nodes_of(bins)]
            inside = slot >= 0
            g, h, _ = _derivatives(bins[inside], y[inside], margin[inside], trees, weight)
            base = slot[inside] * 256
            for f in range(width):
                at = base + bins[inside, f]
                for k, x in enumerate((g, h)):  # a batch's sums are exact in doubles
                    total[f, k] += np.bincount(at, x, size).astype(np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())], ["feature", "sums"])

    return run


def _proposed(nodes: int, penalty: float, least: float):
    """The best cut of one feature for each open node."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros((2, nodes, 256), np.int64)
        for x in rows["sums"]:
            total += np.frombuffer(x.as_buffer(), np.int64).reshape(2, nodes, 256)
        g, h = total / ONE  # (nodes, bins) each
        all_g, all_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
        rows_, found = np.arange(nodes), None
        for missing_left in (True, False):
            left_g, left_h = (np.cumsum(x[:, :MISSING], axis=1) + (x[:, MISSING:] if missing_left else 0) for x in (g, h))
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - all_g**2 / (all_h + penalty)
            gain[(left_h < least) | (right_h < least)] = 0.0
            at = gain.argmax(axis=1)  # the first of the greatest
            new = (gain[rows_, at], at, np.full(nodes, missing_left), left_g[rows_, at], left_h[rows_, at])
            if found is None:
                found = new
            else:
                better = new[0] > found[0]
                found = tuple(np.where(better, y, x) for x, y in zip(found, new))
        out = (rows_, np.full(nodes, key[0].as_py()), *found, all_g[:, 0], all_h[:, 0])
        return pa.table([pa.array(c) for c in out], names=["node", "feature", "gain", "bin", "missing_left", "g", "h", "all_g", "all_h"]).cast(_PROPOSAL)

    return run


_PROPOSAL = pa.schema([
    ("node", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("bin", pa.int32()), ("missing_left", pa.bool_()),
    ("g", pa.float64()), ("h", pa.float64()), ("all_g", pa.float64()), ("all_h", pa.float64())])


def _grown(
    rows: DataFrame, parts: int, trees: list[Tree], width: int, depth: int, rate: float, penalty: float, least: float, weight: float
) -> Tree:
    """One tree, level by level; rows have `parts` partitions at most."""
    tree = Tree()
    tree.leaf(0.0, 0.0)
    open_ = [0]
    for level in range(depth):
        places = {node: i for i, node in enumerate(open_)}
        sums = rows.mapInArrow(_summed(trees, tree, places, width, weight), "feature int, sums binary")
        propose = _proposed(len(open_), penalty, least)
        if parts * width * len(open_) * 2 * 256 * 8 <= MERGED_BYTES:
            table = sums.toArrow()
            proposals = [r for f in sorted(set(table["feature"].to_pylist()))
                         for r in propose((pa.scalar(f),), table.filter(pc.equal(table["feature"], f))).to_pylist()]
        else:
            proposals = sums.groupBy("feature").applyInArrow(
                propose,
                "node int, feature int, gain double, bin int, missing_left boolean, g double, h double, all_g double, all_h double").collect()
        best: dict[int, tuple] = {}
        for r in proposals:  # one row an open node and feature
            rank = (-r["gain"], r["feature"])
            if r["node"] not in best or rank < best[r["node"]][0]:
                best[r["node"]] = (rank, r)
        after = []
        for node in open_:
            if places[node] not in best:
                continue
            r = best[places[node]][1]
            if level == 0:
                tree.value[0], tree.cover[0] = -rate * r["all_g"] / (r["all_h"] + penalty), r["all_h"]
            if r["gain"] <= LEAST_GAIN:
                continue
            tree.feature[node], tree.bin[node], tree.gain[node] = r["feature"], r["bin"], r["gain"]
            tree.missing_left[node] = r["missing_left"]
            for side, g, h in (("left", r["g"], r["h"]), ("right", r["all_g"] - r["g"], r["all_h"] - r["h"])):
                child = tree.leaf(-rate * g / (h + penalty), h)
                getattr(tree, side)[node] = child
                after.append(child)
        open_ = after
        if not open_:
            break
    return tree


def fit(
    df: DataFrame, columns: list[str], label: str = "churn", key: str = "customer_id", rounds: int = 200, depth: int = 6,
    rate: float = 0.1, penalty: float = 1.0, least_curvature: float = 1.0, weight: float | None = None, bins: int = 254,
    cut_rows: int | None = None, seed: int = 42, cuts: list[list[float]] | None = None,
) -> NewtonTrees:
    """Newton-boosted trees on the rows of df with label 0 or 1.

    `weight` is what a row of label 1 counts; without it, as many times a row of label 0 as there
    are more of these. Null and NaN features go to the side that gains more. Without rows, or with rows of
    one label only, there may be no splits and the model scores every row alike; margins start
    at 0. Cuts come from all rows, unless they are given or `cut_rows` asks for a hashed draw of
    about so many; everything else covers all rows.
    """
    data = df.filter(F.col(label).isin(0, 1))
    sizes = {r[label]: r["count"] for r in data.groupBy(label).count().collect()}
    if weight is None:
        weight = sizes.get(0, 0) / max(1, sizes.get(1, 0)) or 1.0
    cuts = cuts or cut_points(data, columns, key, bins, cut_rows, seed)
    model, width = NewtonTrees(list(columns), [[float(v) for v in c] for c in cuts], []), len(columns)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f"x{f}").to_numpy(zero_copy_only=False).astype(float) for f in range(width)])
            rows = [r.tobytes() for r in model.binned(x)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("y"), pa.array(np.zeros(len(x)))], ["bins", "y", "margin"])

    plain = data.select(F.col(label).cast("int").alias("y"), *[F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(columns)])
    schema = "bins binary, y int, margin double"
    parts = max(1, -(-sum(sizes.values()) // ROWS_A_TASK))  # fewer tasks than partitions where rows are few
    rows = store(plain.coalesce(parts).mapInArrow(packed, schema), "binned")
    recent: list[Tree] = []
    for _ in range(rounds):
        tree = _grown(rows, parts, recent, width, depth, rate, penalty, least_curvature, weight)
        model.trees.append(tree)
        recent.append(tree)
        if tree.feature[0] < 0 and abs(tree.value[0]) < 1e-12:
            break  # nothing left to gain
        if len(recent) == KEEP_ROUNDS:
            rows, recent = store(rows.mapInArrow(_advanced(recent, width, weight), schema), "binned"), []
    return model


def _advanced(trees: list[Tree], width: int, weight: float):
    """Rows with their margins after some trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, y, margin = _unpacked(batch, width)
            margin = _derivatives(bins, y, margin, trees, weight)[2]
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), pa.array(margin)], ["bins", "y", "margin"])

    return run
