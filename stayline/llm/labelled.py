"""A bounded sample of labelled rows to fit a classifier on, and the held-out fold."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bag = tuple[np.ndarray, np.ndarray]  # terms (int32) and what each counts (float32)
BLOCK = 256  # texts whose terms are counted at once


def held_out(doc_id: Column | str) -> Column:
    """True for the fifth of the ids that no classifier learns from; false for null ids."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def drawn(labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", seed: int = 11) -> DataFrame:
    """(id, label, draw) of at most `per_class` ids of either label outside the held-out fold:
    those with the smallest seeded hashes. Null ids and labels don't count."""
    key = F.col(f"`{id_col}`")
    rows = labels.select(key.alias("id"), F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(seed), key).alias("draw"))
    rows = rows.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id")).distinct()
    least = [rows.filter(F.col("label") == value).orderBy("draw", "id").limit(per_class) for value in (0, 1)]
    return least[0].unionByName(least[1])


def sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text",
    seed: int = 11,
) -> DataFrame:
    """(id, label, draw, text) of at most `per_class` rows of either label.

    One row an id: of several texts with one id the one with the smallest hash counts, so
    an id that a large share of the rows has is worth as much as any other. Null texts, and
    labels of documents that docs lacks, don't count; an id with both labels counts twice.
    """
    ids = F.broadcast(drawn(labels, label, per_class, id_col, seed))  # at most two times per_class rows
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).filter(F.col("text").isNotNull())
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return texts.join(ids, "id").groupBy("id", "label", "draw").agg(one.alias("one")).select("id", "label", "draw", "one.text")


def fitted(rows: DataFrame, count: Callable[[list[str]], list[Bag]], fit: Callable[[list[Bag], list[int]], object]):
    """The model that `fit` makes of a sample's bags and labels.

    Terms are counted where the texts lie; a bag has at most one entry a term, however long
    its text. The bags of the sample (bounded in rows by its draw, in bytes by rows times
    terms) meet in one task, ordered by draw, and only the model reaches the driver.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                bags = count(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column("draw"), some.column("id"), some.column("label"),
                     *[pa.array([np.asarray(bag[i], kind).tobytes() for bag in bags], pa.binary())
                       for i, kind in enumerate((np.int32, np.float32))]],
                    ["draw", "id", "label", "terms", "counts"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, labels = [], []
        for batch in batches:
            labels += batch.column("label").to_pylist()
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                bags.append((np.frombuffer(terms, np.int32), np.frombuffer(counts, np.float32)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(bags, labels))], pa.binary())], ["model"])

    kind = dict(rows.dtypes)["id"]
    bags = rows.mapInArrow(counted, f"draw long, id {kind}, label int, terms binary, counts binary")
    one = bags.repartition(1).sortWithinPartitions("draw", "id", "label").mapInArrow(learnt, "model binary")
    model = one.first()
    return fit([], []) if model is None else pickle.loads(model["model"])
