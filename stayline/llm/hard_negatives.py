"""Hard negatives by slot-decomposed selection.

A row's score at an anchor is the integer inner product of their scaled vectors. The anchor's
positives are its best rows of the same label; a negative of a positive lies in the window
from a share of the positive's score up to that score. The windows of one anchor overlap, so
they are not searched one by one: the positives' scores, their upper limits, cut the scores
into disjoint slots, each row falls into one slot, and only the best few of each slot are
kept, in every block first and then over all blocks. The best of a window are the best of
its own slot and of those below it, so merging slots from the top down answers all windows.

Anchors are a stated set of queries against all rows, in blocks: every block of rows meets
every block of anchors in a task of its own, which takes the products of a tile at a time.
A block emits at most `k` rows for each of its anchors (and slot), whatever it holds, and the
last merge is a ranking that Spark cuts before the shuffle. Blocks are dealt by hash, so a
label, a slot or a vector that a large share of the rows has is spread over all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.registry import query, table
from stayline.sources.store import store

SCALE = 256
LABELS = 10
POSITIVES = 5
NEGATIVES = 5
ANCHOR_BLOCK = 2048
ROW_BLOCK = 16384
TILE = 1 << 21  # products held at once
_EXACT = 2**53  # doubles add whole numbers exactly below this
_LONG = 2**63 - 1


def usable(vectors: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec) of the rows with an id, a label and a vector of finite components, each
    component x as floor(SCALE * x); equal rows count once."""
    vec = F.col(f"`{vec_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    whole = F.transform("vec", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return rows.select("id", "label", whole.alias("vec")).distinct()


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with those of x, exactly; beyond a long they are
    its ends. Whole numbers too large for doubles are multiplied as Python's."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if top < _EXACT:
        return (a @ x.T).astype(np.int64)
    exact = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in x]
    out = [[max(-_LONG - 1, min(_LONG, sum(map(int.__mul__, p, q)))) for q in exact[1]] for p in exact[0]]
    return np.array(out, dtype=np.int64).reshape(len(a), len(x))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in that order."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _tiles(anchors: pa.Table, rows: pa.Table):
    """(places of some anchors, their products with all rows)."""
    a, x = _matrix(anchors["vec"]), _matrix(rows["vec"])
    step = max(1, TILE // max(1, len(x)))
    for at in range(0, len(a), step):
        yield range(at, min(at + step, len(a))), products(a[at : at + step], x)


def _positives(k: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The k best rows of its own label for each anchor of the block."""
        out: list[list] = [[], [], []]
        if anchors.num_rows and rows.num_rows:
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            anchor, own, own_label = (anchors[c].to_numpy() for c in ("anchor", "id", "label"))
            for places, scores in _tiles(anchors, rows):
                for i, score in zip(places, scores):
                    at = np.flatnonzero((labels == own_label[i]) & (ids != own[i]))
                    at = at[_best(score[at], ids[at], k)]
                    out[0].append(np.full(len(at), anchor[i]))
                    out[1].append(ids[at])
                    out[2].append(score[at])
        return _rows(["anchor", "id", "score"], out)

    return run


def _slots(k: int, low: int, high: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The k best rows of another label in each slot of each anchor of the block. Slot i
        holds scores up to limit i and above limit i + 1; below the window of limit i a
        row of slot i lies in no window."""
        out: list[list] = [[], [], [], []]
        if anchors.num_rows and rows.num_rows:
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            anchor, own_label = anchors["anchor"].to_numpy(), anchors["label"].to_numpy()
            limits = [np.array(x, dtype=np.int64) for x in anchors["limits"].to_pylist()]  # descending, distinct
            for places, scores in _tiles(anchors, rows):
                for i, score in zip(places, scores):
                    at = np.flatnonzero((labels != own_label[i]) & (score <= limits[i][0]))
                    slot = len(limits[i]) - 1 - np.searchsorted(limits[i][::-1], score[at])
                    for s in np.unique(slot):
                        limit, held = int(limits[i][s]), at[slot == s]
                        held = held[score[held] >= -(-low * limit // high)]
                        held = held[_best(score[held], ids[held], k)]
                        for part, values in zip(out, (anchor[i], s, ids[held], score[held])):
                            part.append(np.broadcast_to(values, len(held)))
        return _rows(["anchor", "slot", "id", "score"], out)

    return run


def _rows(names: list[str], parts: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate(p) if p else [], pa.int64()) for n, p in zip(names, parts)})


def _grid(anchors: DataFrame, rows: DataFrame, a_blocks: int, r_blocks: int):
    """Both sides dealt to all pairs of blocks, grouped; vectors meet only those as long."""
    block = lambda c, n: F.pmod(F.xxhash64(F.lit(3), c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"dim": F.size("vec"), "a": block("anchor", a_blocks)}).withColumn("r", every(r_blocks))
    right = rows.withColumns({"dim": F.size("vec"), "r": block("id", r_blocks)}).withColumn("a", every(a_blocks))
    return left.groupBy("dim", "a", "r").cogroup(right.groupBy("dim", "a", "r"))


def mined(
    vectors: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column, positives: int = POSITIVES,
    k: int = NEGATIVES, low: int = 80, high: int = 100, anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row
    that is_anchor (a condition on `id`) selects and each of its best `positives` other rows
    of the same label, the first k rows of another label whose score is at most the positive's and at
    least low / high of it. Higher scores come first, ties by smaller id.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part;
    equal rows count once, and rows that share an id but differ are rows of their own
    (no row is a positive of its own id). Vectors meet only vectors of the same length. An anchor
    without positives, or whose windows are empty, has no rows; an empty table gives an empty
    result. Columns other than those named are not looked at.
    """
    rows = store(usable(vectors, id_col, vec_col, label), "vectors")
    asked = rows.filter(is_anchor).withColumn("anchor", F.xxhash64("id", "label", "vec"))
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(is_anchor).alias("asked")).first()
    blocks = max(1, math.ceil(n["asked"] / anchor_block)), max(1, math.ceil(n["all"] / row_block))

    first = _grid(asked, rows, *blocks).applyInArrow(_positives(positives), "anchor long, id long, score long")
    best = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    found = store(first.withColumn("place", best).filter(F.col("place") <= positives), "positives")

    limits = F.sort_array(F.collect_set("score"), asc=False).alias("limits")  # at most `positives`
    bounded = store(asked.join(found.groupBy("anchor").agg(limits), "anchor"), "limits")
    slots = _grid(bounded, rows, *blocks).applyInArrow(_slots(k, low, high), "anchor long, slot long, id long, score long")
    best = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    slots = slots.withColumn("place", best).filter(F.col("place") <= k)
    order = F.struct((-F.col("score")).alias("below"), "id", "score")
    merged = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(order)).alias("down"))  # at most k a slot
    # a limit's own slot and those below it: what follows the scores above the limit
    window = F.slice(F.filter("down", lambda x: x["score"] <= F.col("score")), 1, k)
    wide = lambda c, n: c.cast("decimal(20,0)") * n
    window = F.filter(window, lambda x: wide(x["score"], high) >= wide(F.col("score"), low))
    answers = found.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor").join(merged, "anchor")
    answers = answers.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(window))
    return answers.select(
        "anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias("negative_id"),
        "positive_score", F.col("col.score").alias("negative_score"))


SQL = """
with rows as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as vec
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id,
        cast(list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: p[1] * p[2])) as bigint) as score
    from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""


@query("op12_slot_negatives", SQL)
def op12(spark, sf_dir):
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mined(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("id") % 100 == 0)
