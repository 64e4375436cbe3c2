"""Exact positions, quantiles and running totals over a whole table.

An unpartitioned window would put every row into one task. Here rows are range
partitioned by their sort keys, which also splits a value that a large share of
the rows have, because the last key is unique. Partition number and row number
inside the partition give the position; only one row count per partition and the
few rows at wanted positions reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import freeze

_SLOT = "_slot"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _part() -> Column:
    return F.shiftright(F.col(_SLOT), _ROW_BITS).cast("int")


def _row() -> Column:
    return F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def _starts(sizes: dict[int, int]) -> list:
    """Total of all earlier partitions, by partition number."""
    out, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        out.append(total)
        total += sizes.get(p, 0)
    return out


def _per_part(values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), _part())


class InOrder:
    """A frozen, globally sorted frame; the sort keys must identify a row."""

    def __init__(self, df: DataFrame, *keys: Column | str):
        self.rows = freeze(df.orderBy(*keys).withColumn(_SLOT, F.monotonically_increasing_id()))
        counts = self.rows.groupBy(_part().alias("part")).count().collect()
        self._sizes = {r["part"]: r["count"] for r in counts}
        self.count = sum(self._sizes.values())

    def numbered(self, name: str = "position") -> DataFrame:
        """All rows with their 1-based global position."""
        if not self.count:
            return self.rows.withColumn(name, F.lit(0).cast("long")).drop(_SLOT)
        position = _per_part(_starts(self._sizes)) + _row() + 1
        return self.rows.withColumn(name, position.cast("long")).drop(_SLOT)

    def at(self, positions: list[int]) -> dict[int, tuple]:
        """Rows at a few 1-based positions."""
        starts = _starts(self._sizes)
        slots = {}
        for position in set(positions):
            for part, size in self._sizes.items():
                row = position - 1 - starts[part]
                if 0 <= row < size:
                    slots[(part << _ROW_BITS) + row] = position
        if not slots:
            return {}
        found = self.rows.filter(F.col(_SLOT).isin(list(slots))).collect()
        return {slots[r[_SLOT]]: r for r in found}

    def running(self, totals: dict[str, str]) -> DataFrame:
        """Adds {name: running total of a whole-number column} in sort order.

        Each range partition is summed by one task; totals of the earlier
        partitions are added as constants.
        """
        if not self.count:
            blank = {name: F.col(c).cast("long") for name, c in totals.items()}
            return self.rows.withColumns(blank).drop(_SLOT)
        sums = (
            self.rows.groupBy(_part().alias("part"))
            .agg(*[F.sum(c).alias(name) for name, c in totals.items()])
            .collect()
        )
        frame = (
            Window.partitionBy("_part")
            .orderBy(_SLOT)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        before = {n: _starts({r["part"]: r[n] or 0 for r in sums}) for n in totals}
        added = {
            name: (F.sum(c).over(frame) + _per_part(before[name])) for name, c in totals.items()
        }
        return self.rows.withColumn("_part", _part()).withColumns(added).drop(_SLOT, "_part")


def _stacked(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """One row per (column number, value); null values are left out."""
    fields = [
        F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v"))
        for i, c in enumerate(columns)
    ]
    long = df.select(F.col(key).alias("k"), F.explode(F.array(*fields)).alias("e"))
    return long.select("e.m", "e.v", "k").filter(F.col("v").isNotNull())


def _column_starts(ordered: InOrder, n_columns: int) -> list[tuple[int, int]]:
    sizes = {r["m"]: r["count"] for r in ordered.rows.groupBy("m").count().collect()}
    out, start = [], 0
    for i in range(n_columns):
        out.append((start, sizes.get(i, 0)))
        start += sizes.get(i, 0)
    return out


def quantiles(df: DataFrame, wanted: dict[str, list[float]], key: str) -> dict[str, list]:
    """Linear-interpolated quantiles of several columns from one sort.

    Returns {column: [value per requested share]}, None for an empty column.
    """
    columns = list(wanted)
    ordered = InOrder(_stacked(df, columns, key), "m", "v", "k")
    spans = _column_starts(ordered, len(columns))
    places = {}
    for column, (start, n) in zip(columns, spans):
        for share in wanted[column]:
            spot = (n - 1) * share
            low = int(spot)
            places[column, share] = (start + low + 1, start + min(low + 1, n - 1) + 1, spot - low)
    rows = ordered.at([p for low, high, _ in places.values() for p in (low, high)])
    out: dict[str, list] = {}
    for column, (start, n) in zip(columns, spans):
        out[column] = []
        for share in wanted[column]:
            low, high, rest = places[column, share]
            if n == 0:
                out[column].append(None)
                continue
            a, b = rows[low]["v"], rows[high]["v"]
            out[column].append(a + (b - a) * rest)
    return out


def quantile_buckets(
    df: DataFrame, key: str, wanted: dict[str, tuple[str, int]], alone: int | None = None
) -> DataFrame:
    """Adds {name: bucket 1..q of a column}, equal-sized by rank, ties split by key.

    Only the keys at the q-1 cut positions are looked up, so that every row is
    bucketed by comparing with constants: no join back. `alone` is the bucket when
    there is a single row.
    """
    columns = [c for c, _ in wanted.values()]
    ordered = InOrder(_stacked(df, columns, key), "m", "v", "k")
    spans = _column_starts(ordered, len(columns))
    cuts = {}
    for (name, (_, q)), (start, n) in zip(wanted.items(), spans):
        cuts[name] = [start + (k * (n - 1)) // q + 1 for k in range(1, q)] if n > 1 else []
    rows = ordered.at([p for positions in cuts.values() for p in positions])
    added = {}
    for (name, (column, _)), (_, n) in zip(wanted.items(), spans):
        value = F.col(column).cast("double")
        bucket = F.lit(1)
        for position in cuts[name]:
            cut = rows[position]
            above = (value > cut["v"]) | ((value == cut["v"]) & (F.col(key) > F.lit(cut["k"])))
            bucket = bucket + above.cast("int")
        if n <= 1 and alone is not None:
            bucket = F.lit(alone)
        added[name] = F.when(value.isNotNull(), bucket)
    return df.withColumns(added)


def group_medians(df: DataFrame, group: str, value: str, key: str, name: str) -> DataFrame:
    """Exact median of value per group.

    Rows are numbered over (group, value, key), so a group with a large share of
    the rows spans many partitions; the middle rows are then found by position,
    which is unique and cannot be skewed.
    """
    numbered = InOrder(df.select(group, value, key), group, value, key).numbered()
    span = numbered.groupBy(group).agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("n")
    )
    first, n = F.col("first"), F.col("n")
    middle = span.select(
        group,
        F.explode(
            F.array_distinct(
                F.array(first + F.floor((n - 1) / 2), first + F.floor(n / 2))
            )
        ).alias("position"),
    )
    return (
        middle.join(numbered.select("position", value), "position")
        .groupBy(group)
        .agg(F.avg(value).alias(name))
    )


def group_cut(df: DataFrame, group: str, order: str, key: str, share: float) -> Column:
    """True for the first round(share * n) rows of each group, in (order, key) order.

    For few groups: one (order, key) constant per group is collected.
    """
    ordered = InOrder(df.select(group, order, key), group, order, key)
    sizes = ordered.rows.groupBy(group).count().orderBy(group).collect()
    inside, start, places = F.lit(False), 0, {}
    for r in sizes:
        take = int(share * r["count"] + 0.5)
        if take:
            places[r[group]] = start + take
        start += r["count"]
    rows = ordered.at(list(places.values()))
    for g, position in places.items():
        cut = rows[position]
        upto = (F.col(order) < cut[order]) | (
            (F.col(order) == cut[order]) & (F.col(key) <= F.lit(cut[key]))
        )
        inside = F.when(F.col(group) == F.lit(g), upto).otherwise(inside)
    return inside


def sample_exact(df: DataFrame, key: str, n: int, draw: Column) -> DataFrame:
    """Exactly min(count, n) rows: those with the smallest draw.

    A threshold on the draw keeps the final sort near n rows; it is widened in
    the rare case that it leaves fewer than n.
    """
    total = df.count()
    if total <= n:
        return df
    drawn = df.withColumn("_draw", draw)
    share = min(1.0, (n + 6 * n**0.5 + 10) / total)
    kept = drawn.filter(F.col("_draw") < share)
    while share < 1.0 and kept.count() < n:
        share = min(1.0, share * 2)
        kept = drawn.filter(F.col("_draw") < share)
    return kept.orderBy("_draw", key).limit(n).drop("_draw")
