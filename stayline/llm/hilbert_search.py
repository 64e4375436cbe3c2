"""Approximate nearest neighbours along shifted Hilbert curves.

Every curve projects the vectors on a few random orthogonal directions, shifts and
scales them and orders them by their place on a Hilbert curve. Spark range-partitions all
(curve, key) pairs, so each curve becomes a sequence of cells. A query is compared with all
vectors of its own cell and of the two beside it, in double precision; the best of all
curves are merged, and ranked once more. A cell has one point in SHARE of all, so recall
does not fall as the table grows; a curve has at most SHARE cells. Comparisons are dealt
in tiles of at most TILE points of a cell and about TILE queries.

Equal vectors are one point with its smallest ids, as many as a result can need, so a
vector that a third of the rows share costs no more than any other. All cells have the same
number of points, whatever the distribution. Only the scale of the projections comes
from a sample, of FIT_POINTS points; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.registry import query, table
from stayline.operators.ordering import InOrder
from stayline.sources.store import store

CURVES = 32
DIRECTIONS, BITS = 8, 3  # of each curve; a key has DIRECTIONS * BITS bits
CELL = 512  # points of a cell, at least
SHARE = 160  # a cell has one point in so many, at least
TILE = 4096  # points of a cell, and queries, that one task compares at once
FIT_POINTS = 10_000
NEIGHBOURS = 10
BLOCK = 1 << 22  # numbers in a block of products or differences


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows) with `bits` bits a coordinate.

    The bits of the coordinates are turned into the curve's transposed index, from the
    highest bit down: a set bit mirrors the first coordinate, a clear one swaps it.
    """
    axes = [c.astype(np.int64) for c in places.T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i, axis in enumerate(axes):
            mirror = (axis >> bit & 1).astype(bool)
            swap = np.where(mirror, 0, (axes[0] ^ axis) & low)
            axes[i] = axis ^ swap
            axes[0] = axes[0] ^ swap ^ np.where(mirror, low, 0)
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(places), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros(len(places), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | ((axis ^ flip) >> bit & 1)
    return key


class Curves:
    """Directions, shifts and scales of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, seed: int):
        rng, dim = np.random.default_rng(seed), sample.shape[1]
        take = min(DIRECTIONS, dim)
        self.center = sample.mean(axis=0)
        self.axes, self.shifts, self.scales = [], [], []
        for _ in range(curves):
            axes = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :take]
            spread = ((sample - self.center) @ axes).std(axis=0)
            self.axes.append(axes)
            self.scales.append(np.where(spread > 0, spread, 1.0))
            self.shifts.append(rng.uniform(-0.5, 0.5, take))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For every curve the keys of all vectors; a cell of the grid is as wide as the
        projections' spread times five, divided by the number of steps."""
        out, steps = [], 1 << BITS
        for axes, scale, shift in zip(self.axes, self.scales, self.shifts):
            at = ((vectors - self.center) @ axes / scale + shift) / 5 + 0.5
            out.append(hilbert_keys(np.clip(at * steps, 0, steps - 1).astype(np.int64), BITS))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows with an id and a vector that is not null, empty or zero, has
    neither null nor non-finite components, and is as long as most of them are."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vec") == (sizes["n"] if sizes else 0))
    return rows.withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)))  # no -0


def cell_size(points: int) -> int:
    """Points of a cell, for so many points on each curve."""
    return max(CELL, -(-points // SHARE))


def nearest_of(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, id, distance) of the k nearest rows of x, ties to the smaller id.

    Products find the rows within rounding of the k-th distance; the distances
    of these are then sums of squared differences."""
    k, size = min(k, len(x)), (x**2).sum(axis=1)
    step, parts = max(1, BLOCK // len(x)), []
    for at in range(0, len(q), step):
        some = q[at : at + step]
        own = (some**2).sum(axis=1)[:, None]
        near = own + size - 2 * (some @ x.T)
        slack = 4 * (x.shape[1] + 4) * np.finfo(float).eps * (own + size.max())
        row, col = np.nonzero(~(near > np.partition(near, k - 1, axis=1)[:, k - 1 : k] + slack))  # keeps overflows
        score, pairs = np.empty(len(row)), max(1, BLOCK // x.shape[1])
        for a in range(0, len(row), pairs):
            score[a : a + pairs] = np.sqrt(((some[row[a : a + pairs]] - x[col[a : a + pairs]]) ** 2).sum(axis=1))
        order = np.lexsort((ids[col], score, row))
        row, col, score = row[order], col[order], score[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        parts.append((row[best] + at, ids[col[best]], score[best]))
    return tuple(np.concatenate(p) for p in zip(*parts))


def nearest(
    vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = NEIGHBOURS, curves: int = CURVES,
    cell: int | None = None, seed: int = 5,
) -> DataFrame:
    """(query_id, rank, id, score): for every row that is_query (a condition on `id`) selects,
    the k nearest other rows found, by Euclidean distance, ties to the smaller id.

    Rows with an unusable vector (see `usable`) take no part; repeated rows of an id with
    the same vector count once; with fewer than k other rows all are found; an empty table
    gives an empty result. Columns other than the two named are not looked at. Without
    `cell` the cells grow with the points (`cell_size`).
    """
    spark = vectors.sparkSession
    rows = store(usable(vectors, id_col, vec_col).groupBy("vec", "id").agg(F.lit(1).alias("one")).drop("one"), "vectors")
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    firsts = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    points = firsts.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.filter(is_query)
    flags = asked.select("vec").distinct().withColumn("asks", F.lit(True))
    points = points.join(flags, "vec", "left").select(
        F.get("ids", F.lit(0)).alias("point"), "ids", "vec", F.coalesce("asks", F.lit(False)).alias("asks"))
    points = store(points, "points")

    sample = points.orderBy(F.xxhash64(F.lit(seed), "point"), "point").limit(FIT_POINTS).select("vec").toArrow().column("vec")
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    fitted = Curves(_matrix(sample.combine_chunks()), curves, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for curve, keys in enumerate(fitted.keys(_matrix(batch.column("vec")))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), curve, np.int32)), pa.array(keys), batch.column("point"), batch.column("asks")],
                    ["curve", "key", "point", "asks"])

    keys = points.select("point", "vec", "asks").mapInArrow(keyed, "curve int, key long, point long, asks boolean")
    ordered = InOrder(keys, "curve", "key", "point")
    cell = cell or cell_size(ordered.count // curves)
    cells = ordered.numbered().select(
        "point", "asks", F.expr(f"(position - 1) div {cell}").alias("cell"),
        F.expr(f"(position - 1) % {cell} div {TILE}").cast("int").alias("tile"))
    tiles = -(-cell // TILE)
    # queries that come to each cell, in parts; at most curves * SHARE cells
    asking = {r["cell"]: r["count"] for r in cells.filter("asks").groupBy("cell").count().collect()}
    coming = {c + d for c in asking for d in (-1, 0, 1)}
    parts = {c: -(-sum(asking.get(c + d, 0) for d in (-1, 0, 1)) // TILE) for c in coming}
    met = spark.createDataFrame(
        [(c, *[parts.get(c + d, 0) for d in (-1, 0, 1)]) for c in sorted(coming)],
        "cell long, before int, here int, after int")
    placed = points.select("point", "vec").join(cells.join(F.broadcast(met), "cell"), "point")

    def role(to: Column, tile: Column, part: Column, query: bool) -> Column:
        return F.struct(to.alias("to"), tile.alias("tile"), part.cast("int").alias("part"), F.lit(query).alias("query"))

    held = F.transform(F.sequence(F.lit(0), F.col("here") - 1), lambda p: role(F.col("cell"), F.col("tile"), p, False))
    every = F.sequence(F.lit(0), F.lit(tiles - 1))

    def put(offset: int, number: str) -> Column:
        part = F.pmod(F.xxhash64("point"), F.greatest(F.col(number), F.lit(1)))
        return F.transform(every, lambda t: role(F.col("cell") + offset, t, part, True))

    asked_of = F.concat(put(-1, "before"), put(0, "here"), put(1, "after"))
    dealt = placed.select("point", "vec", F.inline(F.when(F.col("asks"), F.concat(held, asked_of)).otherwise(held)))

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        held, put = (rows[rows["query"] == q].drop_duplicates("point") for q in (False, True))
        if not len(held) or not len(put):
            return pd.DataFrame({"query": [], "point": [], "score": []})
        x, q = (np.stack(side["vec"].to_numpy()).astype(np.float64) for side in (held, put))
        row, ids, score = nearest_of(q, x, held["point"].to_numpy(), k + 1)
        return pd.DataFrame({"query": put["point"].to_numpy()[row], "point": ids, "score": score})

    found = dealt.groupBy("to", "tile", "part").applyInPandas(compared, "query long, point long, score double")
    found = found.groupBy("query", "point").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "point"))
    found = found.withColumn("best", best).filter(F.col("best") <= k + 1)
    found = found.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("id"))
    askers = asked.select(F.col("id").alias("query_id"), "vec").join(
        points.select(F.col("point").alias("query"), "vec"), "vec").drop("vec")
    answers = askers.join(found, "query").filter(F.col("query_id") != F.col("id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return answers.select("query_id", rank.cast("int").alias("rank"), "id", "score").filter(F.col("rank") <= k)


@query("op1_hilbert_curves")
def op1(spark, sf_dir):
    """The ten nearest vectors of every hundredth one."""
    found = nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
