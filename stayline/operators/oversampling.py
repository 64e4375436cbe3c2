"""Synthetic minority rows between near neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import synth
from stayline.operators.ordering import InOrder, sample_exact
from stayline.session import freeze
from stayline.sources.store import store

SHARED_BYTES = 64 << 20  # points that go to every task, at most
PIVOTS = 512  # at most
BLOCK = 4096  # points of a cell that one task holds, and queries that meet them


def nearest_neighbours(points: DataFrame, columns: list[str], k: int, shared_bytes: int = SHARED_BYTES) -> DataFrame:
    """Exact k nearest other rows of each row: distances d (squared) and coordinates near, k rows
    after one another.

    points needs customer_id and a 1-based position, and more than k rows. One copy of the points
    is compared with every row in every task if it is small enough, measured by its bytes;
    beyond that the rows are joined by pivots (`pivot_neighbours`). No list of all pairs is
    built or shuffled.
    """
    rows = points.select("customer_id", "position", F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    if rows.count() * (len(columns) + 1) * 8 <= shared_bytes:
        return shared_neighbours(rows, len(columns), k)
    return pivot_neighbours(rows, len(columns), k)


def shared_neighbours(rows: DataFrame, width: int, k: int) -> DataFrame:
    """Neighbours by comparing every row with one broadcast copy of all, in blocks."""
    key_type = dict(rows.dtypes)["customer_id"]
    schema = f"customer_id {key_type}, position long, x array<double>, d array<double>, near array<double>"
    held = rows.select("position", "x").orderBy("position").toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((held["position"].to_numpy(), np.stack(held["x"])))

    def search(batches):
        places, others = shared.value
        squares = (others**2).sum(axis=1)
        step = max(1, 4_000_000 // len(others))
        for batch in batches:
            if not len(batch):
                continue
            x, own = np.stack(batch["x"]), batch["position"].to_numpy()
            best, near = np.empty((len(x), k)), np.empty((len(x), k * width))
            for at in range(0, len(x), step):
                part = x[at:at + step]
                dist = (part**2).sum(axis=1)[:, None] + squares[None, :] - 2 * part @ others.T
                dist[own[at:at + step][:, None] == places[None, :]] = np.inf
                found = np.argpartition(dist, k - 1, axis=1)[:, :k]
                exact = ((part[:, None, :] - others[found]) ** 2).sum(axis=2)
                order = np.lexsort((found, exact), axis=1)
                best[at:at + step] = np.take_along_axis(exact, order, axis=1)
                near[at:at + step] = others[np.take_along_axis(found, order, axis=1)].reshape(len(part), -1)
            yield batch.assign(d=list(best), near=list(near))

    return rows.mapInPandas(search, schema)


def _points(table: pa.Table | pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, without cancellation."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        out += (a[:, i, None] - b[None, :, i]) ** 2
    return out


def _compared(width: int, k: int):
    def run(key: tuple, held: pa.Table, asked: pa.Table) -> pa.Table:
        """The k nearest of a block of points to each query that reaches it. Only points whose distance
        to the pivot differs from the query's by no more than the query's bound can be nearer."""
        out: list[list] = [[], [], []]
        if held.num_rows and asked.num_rows:
            held, asked = held.sort_by("pivot"), asked.sort_by("pivot")
            x, q = _points(held, "x", width), _points(asked, "x", width)
            ring, places, own, at, bound = (t[c].to_numpy() for t, c in (
                (held, "pivot"), (held, "position"), (asked, "position"), (asked, "pivot"), (asked, "bound")))
            for first in range(0, len(q), 256):
                part = slice(first, first + 256)
                low = np.searchsorted(ring, (at[part] - bound[part]).min() * (1 - 1e-12) - 1e-12)
                high = np.searchsorted(ring, (at[part] + bound[part]).max() * (1 + 1e-12) + 1e-12, "right")
                if low >= high:
                    continue
                far = _apart(q[part], x[low:high])
                far[own[part][:, None] == places[None, low:high]] = np.inf
                far[far > (bound[part] ** 2 * (1 + 1e-9))[:, None]] = np.inf
                n = min(k, far.shape[1])
                near = np.argpartition(far, n - 1, axis=1)[:, :n]
                value = np.take_along_axis(far, near, axis=1)
                row, col = np.nonzero(np.isfinite(value))
                for part_, values in zip(out, (own[part][row], places[low:high][near[row, col]], value[row, col])):
                    part_.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                        names=["position", "other", "d"])

    return run


def _met(held: DataFrame, asked: DataFrame, visits: dict[int, int], width: int, k: int) -> DataFrame:
    """(position, other, d) of the nearest found where queries (cell, position, x, pivot, bound) visit
    the cells of held. Cells are split in blocks of points and parts of queries, so that neither a
    crowded cell nor one that many queries visit fills a task."""
    spark = held.sparkSession
    sizes = {r["cell"]: r["count"] for r in held.groupBy("cell").count().collect()}  # one row a cell
    split = spark.createDataFrame(
        [(c, -(-n // BLOCK), -(-visits[c] // BLOCK)) for c, n in sizes.items() if visits.get(c)], "cell int, blocks int, parts int")
    number = lambda n: F.pmod(F.xxhash64("position"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = held.join(F.broadcast(split), "cell").withColumn("block", number("blocks")).withColumn("part", every("parts"))
    right = asked.join(F.broadcast(split), "cell").withColumn("part", number("parts")).withColumn("block", every("blocks"))
    left = left.select("cell", "block", "part", "position", "x", "pivot")
    right = right.toDF(*right.columns).select("cell", "block", "part", "position", "x", "pivot", "bound")
    keys = ["cell", "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compared(width, k), "position long, other long, d double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("position").orderBy("d", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def pivot_neighbours(rows: DataFrame, width: int, k: int, pivots: int | None = None) -> DataFrame:
    """Neighbours by a join over cells, exact.

    Pivots, a hashed draw of the rows, are at most PIVOTS and go to every task; each row belongs to the
    cell of its nearest one and knows its distance to it. A row's neighbours in its own cell
    bound the distance of its k nearest. By the triangle inequality it then visits only cells whose
    ring of distances its ball can reach and whose side of the bisecting plane is near enough, and
    meets in them only points of the ring around its own distance to the pivot.
    """
    spark = rows.sparkSession
    count = pivots or max(1, min(PIVOTS, math.isqrt(rows.count())))
    drawn = sample_exact(rows, "position", count, synth.uniform(7, "pivots", "position"))
    centres = np.stack([r["x"] for r in drawn.orderBy("position").collect()])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _apart(_points(batch, "x", width), centres)
            cell = far.argmin(axis=1)
            pivot = np.sqrt(far[np.arange(len(far)), cell])
            yield pa.RecordBatch.from_arrays(
                [batch.column("position"), batch.column("x"), pa.array(cell, pa.int32()), pa.array(pivot)], ["position", "x", "cell", "pivot"])

    held = store(rows.select("position", "x").mapInArrow(placed, "position long, x array<double>, cell int, pivot double"), "cells")
    cells = {r["cell"]: r for r in held.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("pivot").alias("low"), F.max("pivot").alias("high")).collect()}
    own = held.withColumn("bound", F.lit(float("inf")))
    near = store(_met(held, own, {c: r["n"] for c, r in cells.items()}, width, k), "own")
    bounds = _nearest(near, k).groupBy("position").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n"))
    bound = F.when(F.col("n") == k, F.sqrt("d")).otherwise(F.lit(float("inf")))  # fewer in its cell: no bound
    asked = held.join(bounds, "position", "left").withColumn("bound", F.coalesce(bound, F.lit(float("inf"))))
    numbers = np.array(sorted(cells))
    low, high = (np.array([cells[c][name] for c in numbers]) for name in ("low", "high"))
    between = np.sqrt(_apart(centres, centres))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, home, bound = _points(batch, "x", width), batch.column("cell").to_numpy(), batch.column("bound").to_numpy()
            squares = _apart(x, centres)
            far = np.sqrt(squares[:, numbers])
            reach = bound[:, None] * (1 + 1e-9) + 1e-9
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (squares[:, numbers] - squares[np.arange(len(x)), home][:, None]) / (2 * between[home][:, numbers])
            goes = (far - reach <= high) & (far + reach >= low) & ~(plane > reach) & (numbers[None, :] != home[:, None])
            row, col = np.nonzero(goes)
            taken = batch.select(["position", "x", "bound"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[col], pa.int32()), *taken.columns, pa.array(far[row, col])], ["cell", "position", "x", "bound", "pivot"])

    away = store(asked.select("position", "x", "cell", "bound").mapInArrow(
        sent, "cell int, position long, x array<double>, bound double, pivot double"), "visits")
    visits = {r["cell"]: r["count"] for r in away.groupBy("cell").count().collect()}
    found = _nearest(near.unionByName(_met(held, away, visits, width, k)), k)
    others = rows.select(F.col("position").alias("other"), F.col("x").alias("there"))
    listed = found.join(others, "other").groupBy("position").agg(
        F.array_sort(F.collect_list(F.struct("rank", "d", "there"))).alias("near"))  # k of them
    return rows.join(listed, "position").select("customer_id", "position", "x", "near.d", F.flatten("near.there").alias("near"))


def smote(
    train: DataFrame, columns: list[str], cfg: Settings, label: str = "churn", origin: bool = False
) -> DataFrame:
    """Adds synthetic minority rows until both labels are equally frequent.

    Each new row lies between a minority row and one of its nearest minority
    neighbours. Base rows take turns, so the numbers of rows match exactly. With `origin`,
    the arrays own and other hold the two parents of a synthetic row (null for others).
    """
    def marked(df: DataFrame) -> DataFrame:
        none = F.lit(None).cast("array<double>")
        return df.withColumns({"own": none, "other": none}) if origin else df

    train = freeze(train.select("customer_id", label, *columns))
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    if len(sizes) < 2:
        return marked(train)
    minority = min(sizes, key=lambda value: (sizes[value], value))
    n, need = sizes[minority], max(sizes.values()) - sizes[minority]
    k = min(cfg.smote_neighbours, n - 1)
    if not need or k < 1:
        return marked(train)
    rows = InOrder(train.filter(F.col(label) == minority), "customer_id")
    near = nearest_neighbours(rows.numbered(), columns, k)
    each, extra = divmod(need, n)
    copies = F.lit(each) + (F.col("position") <= extra).cast("int")
    copy = near.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    made = copy.withColumns(
        {
            "pick": F.floor(synth.uniform(cfg.seed, "neighbour", "customer_id", "copy") * k).cast("int"),
            "gap": synth.uniform(cfg.seed, "gap", "customer_id", "copy"),
        }
    )

    def between(i: int):
        own, other = F.get("x", F.lit(i)), F.get("near", F.col("pick") * len(columns) + i)
        return own + F.col("gap") * (other - own)

    parents = [F.col("x").alias("own"), F.slice("near", F.col("pick") * len(columns) + 1, len(columns)).alias("other")]
    parents = parents if origin else []
    synthetic = made.select("customer_id", F.lit(minority).cast(dict(train.dtypes)[label]).alias(label),
                            *[between(i).alias(c) for i, c in enumerate(columns)], *parents)
    return marked(train).unionByName(synthetic)
