"""k-means segments: choosing k, naming clusters, silhouette, projection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.functions import synth
from stayline.operators.labels import standardise
from stayline.operators.ordering import sample_exact
from stayline.session import freeze
from stayline.sources.store import store

STEPS = float(1 << 26)
TOLERANCE = 1e-4
TILE = 1 << 21  # distances held at once
SAMPLE_BLOCK = 1024  # sampled rows whose sums meet in one task

# Features that clusters are made of.
CLUSTER_FEATURES = ["recency_days", "frequency", "monetary", "engagement_score", "avg_order_value"]


def cluster_input(df: DataFrame) -> DataFrame:
    """Customers with standardised cluster features, in steps of 2^-26: sums of them are exact, so
    centres don't depend on partitions."""
    data = df.select(
        "customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in CLUSTER_FEATURES]
    )
    scaled = standardise(data, CLUSTER_FEATURES)
    return scaled.withColumns({c: F.rint(F.col(c) * STEPS) / STEPS for c in CLUSTER_FEATURES})


@dataclass
class Centres:
    """One k-means run."""

    k: int
    restart: int
    points: np.ndarray
    inertia: float = math.inf
    passes: int = 0


def _matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])


def _nearest(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest point (ties to the smaller one) and squared distance to it, for all
    columns of x (features, rows): one point after the other, with no matrix of all distances."""
    best, square, part = (np.empty(x.shape[1]) for _ in range(3))
    near, less = np.zeros(x.shape[1], np.int64), np.empty(x.shape[1], bool)
    for c, point in enumerate(points):
        to = square if c else best
        for i, value in enumerate(point):
            np.subtract(x[i], value, out=part if i else to)
            if i:
                np.multiply(part, part, out=part)
                np.add(to, part, out=to)
            else:
                np.multiply(to, to, out=to)
        if c:
            np.less(square, best, out=less)
            np.copyto(near, c, where=less)
            np.minimum(best, square, out=best)
    return near, best


def _squares(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all points, without cancellation."""
    out = np.zeros((len(x), len(points)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - points[None, :, i]) ** 2
    return out


def _draws(keys: np.ndarray, salt: int) -> np.ndarray:
    """Exponential draws of rows with 64-bit keys."""
    h = keys.astype(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return -np.log((h.astype(np.float64) + 1) / 2**64)


def starts(data: DataFrame, columns: list[str], sets: list[tuple[int, int]], seed: int) -> list[Centres]:
    """k-means++ starts of all (k, restart) sets together: each pass draws the next centre of every
    set that lacks one, with the squared distance to the nearest centre as weight. A row's draw
    is an exponential one over its weight; the smallest of all rows wins."""
    runs = [Centres(k, restart, np.zeros((0, len(columns)))) for k, restart in sets]
    keyed = data.select(F.xxhash64(F.lit(seed), "customer_id").alias("key"), *columns)
    schema = "run int, draw double, " + ", ".join(f"x{i} double" for i in range(len(columns)))
    types = pa.schema([("run", pa.int32()), ("draw", pa.float64()), *[(f"x{i}", pa.float64()) for i in range(len(columns))]])
    for turn in range(max((k for k, _ in sets), default=0)):
        open_ = [(i, r.points, r.restart * 64 + turn) for i, r in enumerate(runs) if len(r.points) < r.k]

        def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple] = {}
            for batch in batches:
                x, keys = _matrix(batch, columns), batch.column("key").to_numpy().view(np.uint64)
                if not len(x):
                    continue
                by_column = np.ascontiguousarray(x.T)
                for i, points, salt in open_:
                    weight = _nearest(by_column, points)[1] if len(points) else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        draw = _draws(keys, salt) / weight
                    at = int(draw.argmin())
                    found = (float(draw[at]), *x[at].tolist())
                    best[i] = min(best.get(i, found), found)
            rows = [(i, *row) for i, row in best.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types) if rows else (
                pa.RecordBatch.from_pylist([], schema=types))

        rows = keyed.mapInArrow(drawn, schema)
        first = F.min(F.struct("draw", *[f"x{i}" for i in range(len(columns))])).alias("first")
        for r in rows.groupBy("run").agg(first).collect():  # one row a set
            run = runs[r["run"]]
            run.points = np.vstack([run.points, [r["first"][f"x{i}"] for i in range(len(columns))]])
    return [r for r in runs if len(r.points)]


def converged(data: DataFrame, columns: list[str], runs: list[Centres], most: int = 300, tolerance: float = TOLERANCE) -> list[Centres]:
    """Lloyd's updates of all runs together: one pass over the rows sums every cluster of every run
    that still moves by more than the tolerance, in each partition first. A cluster that
    loses all rows keeps its centre."""
    sums = ", ".join(f"s{i} double" for i in range(len(columns)))
    types = pa.schema([("run", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("cost", pa.float64()),
                       *[(f"s{i}", pa.float64()) for i in range(len(columns))]])
    open_ = list(range(len(runs)))
    for _ in range(most):
        if not open_:
            break
        moving = [(i, runs[i].points) for i in open_]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {i: np.zeros((len(points), len(columns) + 2)) for i, points in moving}
            for batch in batches:
                x = np.ascontiguousarray(_matrix(batch, columns).T)
                for i, points in moving:
                    near, own = _nearest(x, points)
                    for j, values in enumerate((None, own, *x)):
                        total[i][:, j] += np.bincount(near, values, len(points))
            rows = [(i, c, int(row[0]), *row[1:]) for i, part in total.items() for c, row in enumerate(part) if row[0]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

        parts = data.select(*columns).mapInArrow(summed, f"run int, cluster int, n long, cost double, {sums}")
        found = parts.groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in types.names[2:]]).collect()
        shift = dict.fromkeys(open_, 0.0)
        cost = dict.fromkeys(open_, 0.0)
        for r in found:  # one row a cluster
            run = runs[r["run"]]
            centre = np.array([r[f"s{i}"] for i in range(len(columns))]) / r["n"]
            shift[r["run"]] = max(shift[r["run"]], float(((centre - run.points[r["cluster"]]) ** 2).sum()))
            cost[r["run"]] += r["cost"]
            run.points[r["cluster"]] = centre
        for i in open_:
            runs[i].inertia, runs[i].passes = cost[i], runs[i].passes + 1
        open_ = [i for i in open_ if shift[i] > tolerance**2]
    return runs


def best_runs(data: DataFrame, columns: list[str], cfg: Settings) -> dict[int, Centres]:
    """For each k the run of least inertia among all restarts, carried on until nothing moves: every
    row is nearest to its own centre, and the centre is the mean of its rows."""
    sets = [(k, restart) for k in cfg.cluster_range for restart in range(cfg.cluster_restarts)]
    runs = converged(data, columns, starts(data, columns, sets, cfg.seed))
    best = {}
    for run in runs:
        if run.k not in best or run.inertia < best[run.k].inertia:
            best[run.k] = run
    converged(data, columns, list(best.values()), tolerance=0.0)
    return best


def nearest_centre(run: Centres, columns: list[str]) -> Column:
    """Number of the nearest centre, ties to the smaller one."""
    squares = [sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(columns, point)), F.lit(0.0)) for point in run.points]
    far = F.array(*squares)
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def euclidean_silhouettes(
    data: DataFrame, columns: list[str], labels: dict[str, Column], cfg: Settings, key: str = "customer_id"
) -> dict[str, float | None]:
    """Mean silhouette of each labelling, with Euclidean distances between all rows and a sample
    of Settings.silhouette_rows of them, drawn by a hash of the key.

    The sample goes to every task (its size is the setting's). Tiles of rows meet it; each
    distance is computed once for all labellings, and only its sums for each sampled row
    and cluster leave the tile. A row alone in its cluster scores 0; with a single
    cluster the result is null.
    """
    names, width = list(labels), len(columns)
    marked = store(data.select(key, *columns, *[c.cast("int").alias(f"_{i}") for i, c in enumerate(labels.values())]), "labelled")
    sample = sample_exact(marked, key, cfg.silhouette_rows, synth.uniform(cfg.seed, "silhouette", key)).drop(key).toArrow()
    points = np.column_stack([sample.column(c).to_numpy() for c in columns]) if sample.num_rows else np.zeros((0, width))
    sizes, of, offsets, total = [], [], [], 0
    for i in range(len(names)):
        counts = {r[f"_{i}"]: r["count"] for r in marked.groupBy(f"_{i}").count().collect()}
        place = {label: j for j, label in enumerate(sorted(counts, key=lambda v: (v is None, v)))}
        sizes.append((place, np.array([counts[label] for label in place])))
        of.append(np.array([place[v] for v in sample.column(f"_{i}").to_pylist()], dtype=int))
        offsets.append(total)
        total += len(place)
    places = [place for place, _ in sizes]
    shared = data.sparkSession.sparkContext.broadcast(points)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        sums = np.zeros((len(points), total))
        step = max(1, TILE // max(1, len(points)))
        for batch in batches:
            x = _matrix(batch, columns)
            member = np.zeros((len(x), total))
            for i, place in enumerate(places):
                member[np.arange(len(x)), offsets[i] + np.array([place[v] for v in batch.column(f"_{i}").to_pylist()], dtype=int)] = 1
            for at in range(0, len(x), step):
                sums += np.sqrt(_squares(points, x[at : at + step])) @ member[at : at + step]
        for at in range(0, len(points), SAMPLE_BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sums[at : at + SAMPLE_BLOCK].tobytes()], pa.binary())], ["first", "sums"])

    def scored(key: tuple, rows: pa.Table) -> pa.Table:
        first = key[0].as_py()
        sums = sum(np.frombuffer(x).reshape(-1, total) for x in rows["sums"].to_pylist())
        out = []
        for i, (place, n) in enumerate(sizes):
            part, own = sums[:, offsets[i] : offsets[i] + len(n)], of[i][first : first + len(sums)]
            rows_ = np.arange(len(part))
            inside = part[rows_, own] / np.maximum(n[own] - 1, 1)
            means = part / n
            means[rows_, own] = np.inf
            outside = means.min(axis=1, initial=np.inf)
            most = np.maximum(inside, outside)
            value = np.where((n[own] == 1) | (most == 0), 0.0, (outside - inside) / np.where(most == 0, 1, most))
            out.append((i, float(value.sum()) if len(n) > 1 else None, len(part)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.float64(), pa.int64()))], names=["label", "sum", "n"])

    rows = marked.mapInArrow(tiles, "first int, sums binary").groupBy("first").applyInArrow(scored, "label int, sum double, n long")
    found = {r["label"]: r for r in rows.groupBy("label").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).collect()}
    return {name: found[i]["sum"] / found[i]["n"] if i in found and found[i]["sum"] is not None else None for i, name in enumerate(names)}


def silhouette(clustered: DataFrame, columns: list[str], label: str = "prediction") -> DataFrame:
    """Mean silhouette over all rows, with squared Euclidean distances.

    The mean squared distance of a row to a cluster needs only the cluster's size, sums
    and sum of squares, so one pass learns these (a row for each cluster) and a second one
    scores every row: linear, without pairs. A row alone in its cluster scores 0; with a
    single cluster the result is null.
    """
    x = [F.col(c).cast("double") for c in columns]
    data = clustered.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], F.col(label).cast("int").alias("g"))
    names = [f"x{i}" for i in range(len(columns))]
    norm = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    groups = data.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("squares"), *[F.sum(c).alias(c) for c in names]
    ).orderBy("g").collect()
    if len(groups) < 2:
        return clustered.sparkSession.createDataFrame([(None,)], "silhouette double")

    def distance(r, n: int):
        dot = sum((F.col(c) * F.lit(float(r[c])) for c in names), F.lit(0.0))
        return F.greatest((F.lit(float(r["n"])) * norm - 2 * dot + F.lit(float(r["squares"]))) / F.lit(float(max(n, 1))), F.lit(0.0))

    inside, alone = F.lit(None).cast("double"), F.lit(False)
    others = []
    for r in groups:
        own = F.col("g") == r["g"]
        inside = F.when(own, distance(r, r["n"] - 1)).otherwise(inside)
        alone = F.when(own, F.lit(r["n"] == 1)).otherwise(alone)
        others.append(F.when(~own, distance(r, r["n"])))
    outside = F.least(*others)
    value = F.when(alone, 0.0).otherwise(F.coalesce(F.try_divide(outside - inside, F.greatest(inside, outside)), F.lit(0.0)))
    return data.agg(F.avg(value).alias("silhouette"))


def sweep(data: DataFrame, cfg: Settings) -> tuple[list[dict], dict[int, Centres]]:
    """Inertia and silhouette per k."""
    runs = best_runs(data, CLUSTER_FEATURES, cfg)
    labels = {str(k): nearest_centre(run, CLUSTER_FEATURES) for k, run in runs.items()}
    values = euclidean_silhouettes(data, CLUSTER_FEATURES, labels, cfg)
    rows = [{"k": k, "inertia": runs[k].inertia, "silhouette": values[str(k)]} for k in cfg.cluster_range if k in runs]
    return rows, runs


def sweep_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def fixpoints(data: DataFrame, runs: dict[int, Centres]) -> DataFrame:
    """For each k: customers, how many lie nearer to another centre than to their own, the greatest
    distance of a centre from the mean of its rows along one feature, and the inertia's
    difference from the sum over rows."""
    spark, out = data.sparkSession, None
    for k, run in runs.items():
        squares = lambda p: sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(CLUSTER_FEATURES, p)), F.lit(0.0))
        marked = data.withColumn("cluster", nearest_centre(run, CLUSTER_FEATURES))
        own = F.get(F.array(*[squares(p) for p in run.points]), F.col("cluster"))
        nearer = F.least(*[squares(p) for p in run.points]) < own
        groups = marked.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(nearer).alias("misplaced"), F.sum(own).alias("cost"),
            *[F.avg(c).alias(c) for c in CLUSTER_FEATURES])
        centres = spark.createDataFrame(
            [(i, *map(float, p)) for i, p in enumerate(run.points)], "cluster int, " + ", ".join(f"m_{c} double" for c in CLUSTER_FEATURES))
        apart = F.greatest(*[F.abs(F.col(c) - F.col(f"m_{c}")) for c in CLUSTER_FEATURES])
        row = groups.join(F.broadcast(centres), "cluster").agg(
            F.sum("n").alias("customers"), F.sum("misplaced").alias("misplaced"), F.max(apart).alias("off_mean"),
            F.abs(F.sum("cost") - F.lit(run.inertia)).alias("off_inertia"))
        row = row.select(F.lit(k).alias("k"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def cluster_profile(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        *[F.avg(c).alias(c) for c in CLUSTER_FEATURES], F.count(F.lit(1)).alias("customers")
    )


def average_rank(column: str, descending: bool = False):
    """Rank with ties at their average place; for a few rows only."""
    order = F.desc(column) if descending else F.asc(column)
    ties = F.count(F.lit(1)).over(Window.partitionBy(column))
    return F.rank().over(Window.orderBy(order)) + (ties - 1) / 2


def cluster_ranks(profiles: DataFrame) -> DataFrame:
    return profiles.withColumns(
        {"m_rank": average_rank("monetary", True), "r_rank": average_rank("recency_days")}
    )


def cluster_names(profiles: DataFrame) -> DataFrame:
    """Business name per cluster, one row per cluster; a repeated name gets the id."""
    k = profiles.agg(F.count(F.lit(1))).scalar()
    m, r = F.col("m_rank"), F.col("r_rank")
    active = r <= k * 0.5
    name = (
        F.when((m <= k * 0.25) & active, "High Value Active")
        .when(m <= k * 0.25, "High Value At Risk")
        .when((m <= k * 0.5) & active, "Medium Value Active")
        .when(m <= k * 0.5, "Medium Value Declining")
        .when(active, "Low Value Active")
        .otherwise("Low Value Dormant")
    )
    again = F.row_number().over(Window.partitionBy("name").orderBy("cluster")) > 1
    return cluster_ranks(profiles).withColumn("name", name).select(
        "cluster",
        F.when(again, F.concat("name", F.lit(" ("), F.col("cluster").cast("string"), F.lit(")")))
        .otherwise(F.col("name"))
        .alias("kmeans_segment"),
    )


def segments_of(df: DataFrame, data: DataFrame, rows: list[dict], runs: dict[int, Centres]) -> tuple[DataFrame, int]:
    """Cluster and its name for every customer, with the k of the best silhouette in a sweep."""
    best = max(rows, key=lambda r: -2.0 if r["silhouette"] is None else r["silhouette"])["k"]
    assigned = data.select("customer_id", nearest_centre(runs[best], CLUSTER_FEATURES).alias("cluster"))
    out = df.join(assigned, "customer_id", "left")
    names = cluster_names(cluster_profile(out))
    # one row per cluster, at most the largest k tried
    return out.join(F.broadcast(names), "cluster", "left"), best


def kmeans_segments(df: DataFrame, cfg: Settings) -> tuple[DataFrame, int]:
    """Sweep and segments of all customers."""
    data = store(cluster_input(df), "clusters")
    return segments_of(df, data, *sweep(data, cfg))


def pca_2d(df: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two principal components of every customer, with their explained variance."""
    data = freeze(cluster_input(df).select("customer_id", *CLUSTER_FEATURES))
    means = data.agg(*[F.avg(c).alias(c) for c in CLUSTER_FEATURES]).first()
    centred = data.withColumns({c: F.col(c) - F.lit(float(means[c] or 0.0)) for c in CLUSTER_FEATURES})
    vectors = VectorAssembler(inputCols=CLUSTER_FEATURES, outputCol="features").transform(centred)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors)
    pc = vector_to_array("pc")
    points = model.transform(vectors).select("customer_id", pc[0].alias("pc1"), pc[1].alias("pc2"))
    return points, [float(v) for v in model.explainedVariance]
