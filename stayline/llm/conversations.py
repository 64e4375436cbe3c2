"""Conversation repair by Hirschberg's divide and conquer over a four-state automaton.

A good conversation is empty, or a system turn, if any, and then user and assistant in
turn; the automaton of that rule has the states start, after system, after user and
after assistant. Every row is kept, given another role or deleted, and empty turns are
put in, at the costs of COSTS; the cheapest edits win, ties to the least audit (their initials
in order).

Forward vectors hold, for each state, the least cost of getting there and the rank of its
least audit among the four; backward vectors hold the least cost from each state to the end.
Both meet in the middle: the crossing with the least sum, then the least rank, splits the
conversation in two halves, which are solved alike. Audits are never held to be
compared: no audit that ends with a row's edit begins another one of the same rows, so
the ranks at one row follow from those at the row before. Memory is linear in the rows.

On Spark the same step runs on pieces. Rows are range partitioned in the order of
(conversation, turn) and cut into chunks of at most CHUNK_ROWS rows and CHUNK_BYTES of text
(or one row), so a conversation with a large share of all rows is spread over many tasks. What
lies in one chunk is solved there. A conversation that reaches the end of its chunk is reduced to
one summary, costs and ranks for each pair of states; summaries are chunked and reduced in
turn until one task sees a conversation's whole end, and the states at the borders then
go down again, level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table
from stayline.sources.store import store

# What edits cost; an undeleted row that was cut off costs one more.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20
FAN = 2048  # groups whose summaries one task reduces
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_TURN = {START: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}  # the only turn to put in after a state
_ROLE = {"u": "user", "a": "assistant"}
_ALTERNATES = ("su", "ua", "au")
FAR = 1 << 60

Step = tuple[int, str]  # cost and edits
Item = list[list[tuple[int, int]]]  # [from][to]: cost and rank of the audit among those from the same state


def steps_of(initial: str, must_go: bool, cut_off: bool) -> list[list[Step | None]]:
    """[from][to]: the cheapest edits of one row, with the turns put in before it; ties to
    the least. More than two turns put in pass a state twice."""
    out: list[list[Step | None]] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state, cost, edits = start, 0, ""
        for _ in range(3):
            options = [(state, DELETE, "D")]
            if not must_go:
                if (state, initial) in _AFTER:
                    options.append((_AFTER[state, initial], KEEP + CUT_OFF * cut_off, "K"))
                options.append((_AFTER[state, _TURN[state]], REROLE + CUT_OFF * cut_off, "R"))
            for to, more, edit in options:
                step = cost + more, edits + edit
                if out[start][to] is None or step < out[start][to]:
                    out[start][to] = step
            state, cost, edits = _AFTER[state, _TURN[state]], cost + INSERT, edits + "I"
    return out


def _ranked(steps: list[list[Step | None]]) -> Item:
    """Steps with audits replaced by their ranks."""
    out = []
    for row in steps:
        order = {e: i for i, e in enumerate(sorted(s[1] for s in row if s))}
        out.append([(s[0], order[s[1]]) if s else (FAR, 9) for s in row])
    return out


# Row kinds: 2 * place of the initial in "sua?" + cut off, or 8 for rows that must go.
_INITIALS = "sua?"
_STEPS = [steps_of(_INITIALS[k // 2], False, bool(k % 2)) for k in range(8)] + [steps_of("?", True, False)]
_ITEMS = [_ranked(s) for s in _STEPS]
# Turns put in after the last row, from each state.
_ENDS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]


def forward(items: list[Item], start: int, first: int = 0, last: int | None = None) -> list[tuple[int, int]]:
    """For each state after items[first:last]: least cost and rank of the least audit."""
    vector = [(0, 0) if s == start else (FAR, 9) for s in range(4)]
    for at in range(first, len(items) if last is None else last):
        item, came = items[at], []
        for to in range(4):
            best = (FAR, 9, 9)
            for s in range(4):
                cost, rank = vector[s]
                if cost < FAR:
                    more, own = item[s][to]
                    found = (cost + more, rank, own)
                    if found < best:
                        best = found
            came.append(best)
        order = sorted(range(4), key=lambda to: came[to][1:])
        vector = [(came[to][0], order.index(to)) if came[to][0] < FAR else (FAR, 9) for to in range(4)]
    return vector


def backward(items: list[Item], end: int, first: int, last: int) -> list[int]:
    """For each state before items[first:last]: least cost of ending in `end`."""
    vector = [0 if s == end else FAR for s in range(4)]
    for at in range(last - 1, first - 1, -1):
        item = items[at]
        vector = [min(FAR, min(item[s][to][0] + vector[to] for to in range(4))) for s in range(4)]
    return vector


def states(items: list[Item], start: int, end: int) -> list[int]:
    """The state after each item on the best way from start to end."""
    out = [0] * len(items)
    open_ = [(0, len(items), start, end)]
    while open_:
        first, last, a, b = open_.pop()
        if last - first == 1:
            out[first] = b
        elif last > first:
            middle = (first + last) // 2
            there, back = forward(items, a, first, middle), backward(items, b, middle, last)
            crossing = min(range(4), key=lambda s: (there[s][0] + back[s], there[s][1]))
            open_ += [(first, middle, a, crossing), (middle, last, crossing, b)]
    return out


def best_end(items: list[Item]) -> int:
    """The state after all items on the best way from the start, ends included."""
    vector = forward(items, START)
    return min(range(4), key=lambda s: (vector[s][0] + _ENDS[s][0], vector[s][1]))


def summary(items: list[Item]) -> Item:
    """All items as one."""
    return [forward(items, s) for s in range(4)]


def audit(kinds: list[int], start: int, end: int) -> tuple[int, list[str]]:
    """Cost and edits of each row on the best way between two states."""
    cost, edits, state = 0, [], start
    for kind, to in zip(kinds, states([_ITEMS[k] for k in kinds], start, end)):
        more, said = _STEPS[kind][state][to]
        cost, state = cost + more, to
        edits.append(said)
    return cost, edits


def applied(edits: str, state: int, role: str | None, text: str | None) -> tuple[int, list[tuple[str, str, str]]]:
    """The state after a row's edits, and what they leave: edit, role and text of each."""
    out = []
    for edit in edits:
        if edit == "D":
            out.append((edit, role, text))
            continue
        turn = role[:1] if edit == "K" else _TURN[state]
        state = _AFTER[state, turn]
        out.append((edit, role if edit == "K" else _ROLE[turn], "" if edit == "I" else text))
    return state, out


# -- Spark --------------------------------------------------------------------


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the stated damage: by crc32 of `conv:turn` modulo 20 a row
    is dropped (0), loses its text (1) or its full stops (2), comes twice (3) or is a user's (4).
    A null role or text is one space, as is a null in what is hashed."""
    rows = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    rows = rows.withColumn("harm", F.crc32(F.concat_ws(":", *said)) % 20).filter("harm <> 0")
    harm, text_now = F.col("harm"), F.col("text")
    text_now = F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text_now, "[.!?]", "")).otherwise(text_now)
    times = F.when(harm == 3, 2).otherwise(1)
    return rows.select(
        "conv", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"), text_now.alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


_BLANK = "[\\\\x20\\\\x09-\\\\x0D]"  # white space, as a pattern in SQL text


def _kinds() -> tuple[Column, Column]:
    """A row's kind (see _STEPS) and fault, apart from duplicates."""
    told = F.expr(f"text rlike '[^{_BLANK[1:]}'")
    ended = F.expr(f"text rlike '[.!?]{_BLANK}*\\\\z'")
    first = F.substring("role", 1, 1)
    place = F.when(first == "s", 0).when(first == "u", 2).when(first == "a", 4).otherwise(6)
    kind = F.when(~told, 8).otherwise(place + F.when(ended, 0).otherwise(1))
    return kind.cast("int"), F.when(~told, "blank").when(~ended, "truncated")


def _numbered(chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a sorted partition with the partition, `at` (their order over all) and chunk."""
        part = TaskContext.get().partitionId()
        at = chunk = part << 33
        weight = rows = 0
        for batch in batches:
            chunks = []
            for size in batch.column("size").to_pylist():
                if rows and (rows == chunk_rows or weight + size > CHUNK_BYTES):
                    chunk, weight, rows = chunk + 1, 0, 0
                weight, rows = weight + size, rows + 1
                chunks.append(chunk)
            n = batch.num_rows
            more = [pa.array([part] * n, pa.int64()), pa.array(range(at, at + n), pa.int64()), pa.array(chunks, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "at", "chunk"])
            at += n

    return run


def ordered(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows (conv, turn, role, text) sorted by conv and turn (nulls first; equal turns by role and
    a hash of the text) and cut into chunks, stored."""
    kind, fault = _kinds()
    keyed = rows.select(
        "conv", "turn", "role", "text", F.md5("text").alias("hash"), kind.alias("kind"), fault.alias("fault"),
        (F.octet_length("text") + F.octet_length("role")).cast("long").alias("size"))
    keyed = keyed.orderBy("conv", F.asc_nulls_first("turn"), "role", "hash")
    schema = ("conv long, turn long, role string, text string, hash string, kind int, fault string, size long, "
              "part long, at long, chunk long")
    return store(keyed.mapInArrow(_numbered(chunk_rows), schema), "ordered")


def repeated(rows: DataFrame) -> DataFrame:
    """(chunk, at) of the rows whose role and text stand earlier in their conversation."""
    told = rows.filter("kind <> 8").select("chunk", "at", "conv", "role", "hash")
    seen = told.groupBy("conv", "role", "hash").agg(F.min("at").alias("first"), F.max("at").alias("most"))
    seen = seen.filter("first <> most").drop("most")
    same = told["conv"].eqNullSafe(seen["conv"]) & (told["role"] == seen["role"]) & (told["hash"] == seen["hash"])
    return told.join(seen, same).filter("at <> first").select("chunk", "at")


def _runs(values: list) -> list[tuple[int, int]]:
    """First and last + 1 place of each run of equal values."""
    starts = [i for i in range(len(values)) if not i or values[i] != values[i - 1]]
    return list(zip(starts, starts[1:] + [len(values)]))


def _flat(item: Item) -> list[int]:
    return [x for row in item for cell in row for x in cell]


def _item(flat: list[int]) -> Item:
    return [[(flat[8 * s + 2 * t], flat[8 * s + 2 * t + 1]) for t in range(4)] for s in range(4)]


def _kept_open(group: int, convs: list, items: list[Item]) -> pa.Table:
    """Summaries of the first and the last conversation of a group, which may go on beside it."""
    runs = _runs(convs)
    ends = [(0, runs[0])] + [(1, run) for run in runs[1:][-1:]]
    rows = [(group, side, convs[a], _flat(summary(items[a:b]))) for side, (a, b) in ends]
    return pa.table(list(map(list, zip(*rows))), schema=_SUMMARY)


_SUMMARY = pa.schema([("below", pa.int64()), ("side", pa.int32()), ("conv", pa.int64()), ("item", pa.list_(pa.int64()))])
_SUMMARIES = "below long, side int, conv long, item array<long>"
_BORDERS = "below long, side int, start int, end int, head boolean, tail boolean"


def _up_rows(key: tuple, rows: pa.Table, notes: pa.Table) -> pa.Table:
    """Summaries of a chunk's open conversations."""
    if not rows.num_rows:
        return _SUMMARY.empty_table()
    rows = rows.sort_by("at")
    again = set(notes["at"].to_pylist())
    kinds = [8 if at in again else k for at, k in zip(rows["at"].to_pylist(), rows["kind"].to_pylist())]
    return _kept_open(key[0].as_py(), rows["conv"].to_pylist(), [_ITEMS[k] for k in kinds])


def _up(key: tuple, rows: pa.Table) -> pa.Table:
    """Summaries of the open conversations of a group of summaries."""
    rows = rows.sort_by([("below", "ascending"), ("side", "ascending")])
    return _kept_open(key[0].as_py(), rows["conv"].to_pylist(), [_item(x) for x in rows["item"].to_pylist()])


def _between(runs: list[tuple[int, int]], borders: list[dict]) -> list[tuple[int, int | None, bool, bool]]:
    """(start, end, head, tail) of each run: as the level above says, or a whole conversation."""
    out = [(START, None, True, True)] * len(runs)
    for b in borders:
        out[0 if b["side"] == 0 else -1] = (b["start"], b["end"], b["head"], b["tail"])
    return out


def _down(key: tuple, rows: pa.Table, borders: pa.Table) -> pa.Table:
    """States before and after each summary of a group."""
    out: list[list] = [[] for _ in range(6)]
    if rows.num_rows:
        rows = rows.sort_by([("below", "ascending"), ("side", "ascending")])
        runs = _runs(rows["conv"].to_pylist())
        below, side = rows["below"].to_pylist(), rows["side"].to_pylist()
        items = [_item(x) for x in rows["item"].to_pylist()]
        for (a, b), (start, end, head, tail) in zip(runs, _between(runs, borders.to_pylist())):
            own = items[a:b]
            for i, to in zip(range(a, b), states(own, start, best_end(own) if end is None else end)):
                for part, x in zip(out, (below[i], side[i], start, to, head and i == a, tail and i == b - 1)):
                    part.append(x)
                start = to
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
    return pa.table([pa.array(x, t) for x, t in zip(out, types)], names=["below", "side", "start", "end", "head", "tail"])


_PIECE = pa.schema([
    ("conv", pa.int64()), ("chunk", pa.int64()), ("at", pa.int64()), ("head", pa.bool_()), ("tail", pa.bool_()),
    ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("initials", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
    ("sha", pa.string()),
    ("lines", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))),
])
_PIECES = (
    "conv long, chunk long, at long, head boolean, tail boolean, turns long, low long, high long, blank long, duplicate long, "
    "truncated long, illegal long, initials string, cost long, audit string, sha string, "
    "lines array<struct<edit string, role string, text string>>")


def _solved(all_lines: bool):
    def run(key: tuple, rows: pa.Table, notes: pa.Table) -> pa.Table:
        """One piece for each conversation of a chunk: its counts, audit and repaired lines. A
        whole conversation has its hash; its lines are left out unless all are wanted."""
        if not rows.num_rows:
            return _PIECE.empty_table()
        rows = rows.sort_by("at")
        noted = notes.to_pylist()
        again = {n["at"] for n in noted if n["at"] is not None}
        convs, at, turns, roles, texts, kinds, faults = (
            rows[c].to_pylist() for c in ("conv", "at", "turn", "role", "text", "kind", "fault"))
        for i, x in enumerate(at):
            if x in again:
                kinds[i], faults[i] = 8, "duplicate"
        runs, out = _runs(convs), []
        for (a, b), (start, end, head, tail) in zip(runs, _between(runs, [n for n in noted if n["at"] is None])):
            own = kinds[a:b]
            end = best_end([_ITEMS[k] for k in own]) if end is None else end
            cost, edits = audit(own, start, end)
            lines, state = [], start
            for i, edit in zip(range(a, b), edits):
                state, more = applied(edit, state, roles[i], texts[i])
                lines += more
            if tail:
                more, last = _ENDS[end]
                cost += more
                edits.append(last)
                lines += applied(last, state, None, None)[1]
            known = [t for t in turns[a:b] if t is not None]
            initials = [r[:1] for r in roles[a:b]]
            whole = head and tail
            said = "\n".join(f"{r}:{t}" for e, r, t in lines if e != "D")
            out.append((
                convs[a], key[0].as_py(), at[a], head, tail, len(set(known)), min(known, default=None), max(known, default=None),
                *(faults[a:b].count(f) for f in ("blank", "duplicate", "truncated")),
                sum(p + q not in _ALTERNATES for p, q in zip(initials, initials[1:])),
                "".join([initials[0] or " ", initials[-1] or " "]), cost, "".join(edits),
                hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest() if whole else None,
                [dict(zip(("edit", "role", "text"), x)) for x in lines] if all_lines or not whole else []))
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*out), _PIECE)], schema=_PIECE)

    return run


def pieces(rows: DataFrame, all_lines: bool = True, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """One row for each conversation of rows (conv, turn, role, text) and chunk it lies in: see
    _PIECES. `head` and `tail` tell whether the conversation starts and ends in it."""
    placed = ordered(rows, chunk_rows)
    spark = rows.sparkSession
    again = store(repeated(placed), "duplicates")
    last = placed.agg(F.max("part").alias("n")).first()["n"]
    narrow = placed.select("chunk", "at", "conv", "kind")
    level = narrow.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(_up_rows, _SUMMARIES)
    # chunks, then partitions, then FAN of those at a time, until one task sees all ends
    levels, group, groups = [], F.shiftright("below", 33), (last or 0) + 1
    while True:
        levels.append(store(level.withColumn("above", group), "summaries"))
        if groups == 1:
            break
        level = levels[-1].groupBy("above").applyInArrow(_up, _SUMMARIES)
        group, groups = F.expr(f"below div {fan}"), -(-groups // fan)
    borders = spark.createDataFrame([], _BORDERS)
    for level in reversed(levels):
        here = borders.withColumnRenamed("below", "above")
        borders = level.groupBy("above").cogroup(here.groupBy("above")).applyInArrow(_down, _BORDERS)
        borders = store(borders, "borders")
    notes = again.unionByName(borders.withColumnRenamed("below", "chunk"), allowMissingColumns=True)
    taken = placed.select("chunk", "at", "conv", "turn", "role", "text", "kind", "fault")
    return taken.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(_solved(all_lines), _PIECES)


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, chunk, place, edit, role, text) of every row of df's conversations after the cheapest
    repair, deleted rows with edit D, rows put in with edit I; chunk and place give the order.

    Null roles and texts count as one space; null turns come first; equal turns are ordered by
    role and a hash of the text; rows without a conversation id are one conversation;
    texts of any length stay whole; an empty table gives an empty one. Other columns of df
    are not looked at.
    """
    rows = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    lines = pieces(rows).select(F.col("conv").alias(conv), "chunk", "at", F.posexplode("lines").alias("pos", "line"))
    return lines.select(conv, "at", "pos", "line.edit", "line.role", "line.text").withColumnsRenamed({"at": "chunk", "pos": "place"})


_TOTALS = (
    "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of several pieces, from their lines in order; texts only pass through."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    conv, now = None, None
    done: list[list] = []

    def end():
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        done.append([conv, gaps, *(now[c] for c in names[2:7]), "".join(now["audit"]), now["sha"].hexdigest()])

    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if now is None or r["conv"] != conv:
                if now is not None:
                    end()
                conv = r["conv"]
                now = dict.fromkeys(names[2:7], 0) | {"audit": [], "low": None, "high": None, "turns": 0, "tail": None,
                                                      "sha": hashlib.sha256(), "said": False}
            if r["pos"] == 0:
                for c in names[2:7]:
                    now[c] += r[c]
                now["audit"].append(r["audit"])
                if now["tail"] is not None:
                    now["illegal"] += now["tail"] + r["initials"][0] not in _ALTERNATES
                now["tail"] = r["initials"][1]
                if r["low"] is not None:
                    now["turns"] += r["turns"] - (now["high"] == r["low"])
                    now["low"] = r["low"] if now["low"] is None else now["low"]
                    now["high"] = r["high"]
            if r["edit"] != "D":
                now["sha"].update((("\n" if now["said"] else "") + f"{r['role']}:{r['text']}").encode("utf-8", "surrogatepass"))
                now["said"] = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names)
    done = []
    if now is not None:
        end()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names)


def digests(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of each conversation.

    A hash over a text can only be taken in order, so the lines of a conversation of several
    pieces pass through one task, a batch at a time; nothing of them is gathered but the
    audit, which is a value of the result."""
    found = store(pieces(rows, False, chunk_rows, fan), "pieces")
    whole = found.filter("head and tail")
    gaps = F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).cast("long").alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole = whole.select("conv", gaps, *counts, "sha")
    parts = found.filter("not (head and tail)")
    once = ["turns", "low", "high", "initials", *counts]
    lines = parts.select("conv", "at", *once, F.posexplode("lines").alias("pos", "line"))
    lines = lines.select("conv", "at", "pos", "line.edit", "line.role", "line.text",
                         *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in once])
    joined = lines.repartition("conv").sortWithinPartitions("conv", "at", "pos").mapInArrow(_joined, _TOTALS)
    return whole.unionByName(joined)


# CRC-32 of an ASCII text `said`, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(
        list_concat([4294967295::bigint], list_transform(string_split(said, ''), lambda c: ord(c)::bigint)),
        lambda a, c: list_reduce(list_concat([xor(a, c)], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))"""

# The same by dynamic programming over whole prefixes: `best` has, for each conversation, number
# of rows and state, the cheapest edits and what they leave.
SQL = """
with recursive rows as (
    select conv_id as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {crc} % 20 as harm
    from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as said from conversations)
), harmed as (
    select conv, turn, case when harm = 4 then 'user' else role end as role,
        case when harm = 1 then '' when harm = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case when harm = 3 then 2 else 1 end)) as copy
    from rows where harm <> 0
), placed as (
    select *, row_number() over (partition by conv order by turn nulls first, role, md5(text), copy) as i,
        row_number() over (partition by conv, role, text order by turn nulls first, copy) > 1 as again,
        not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
        not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as cut
    from harmed
), moves as (
    select * from (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) as t(a, c, b)
), puts as (
    select a, a as b, 0 as cost, '' as edits, '' as lines from (values (0), (1), (2), (3)) as t(a)
    union all select a, b, 2, 'I', case c when 'u' then chr(10) || 'user:' else chr(10) || 'assistant:' end from moves where c <> 's'
    union all select m.a, n.b, 4, 'II', case m.c when 'u' then chr(10) || 'user:' || chr(10) || 'assistant:'
        else chr(10) || 'assistant:' || chr(10) || 'user:' end
    from moves m join moves n on m.b = n.a where m.c <> 's' and n.c <> 's'
), options as (
    select conv, i, p.a, p.b as b, p.cost + 3 as cost, p.edits || 'D' as edits, p.lines as lines from placed, puts p
    union all
    select conv, i, p.a, m.b, p.cost + cut::int, p.edits || 'K', p.lines || chr(10) || role || ':' || text
    from placed, puts p join moves m on p.b = m.a where not blank and not again and m.c = left(role, 1)
    union all
    select conv, i, p.a, m.b, p.cost + 2 + cut::int, p.edits || 'R',
        p.lines || chr(10) || case m.c when 'u' then 'user:' else 'assistant:' end || text
    from placed, puts p join moves m on p.b = m.a where not blank and not again and m.c <> 's'
), best as (
    select distinct conv, 0::bigint as i, 0 as s, 0 as cost, '' as audit, '' as lines from placed
    union all
    select conv, i, s, x.cost, x.audit, x.lines from (
        select o.conv, o.i, o.b as s, min({{'cost': w.cost + o.cost, 'audit': w.audit || o.edits, 'lines': w.lines || o.lines}}) as x
        from best w join options o on w.conv is not distinct from o.conv and o.i = w.i + 1 and o.a = w.s
        group by all)
), sizes as (
    select conv, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum(blank::int) as blank,
        sum((again and not blank)::int) as duplicate, sum((cut and not again and not blank)::int) as truncated
    from placed group by conv
), pairs as (
    select conv, sum((pair not in ('su', 'ua', 'au'))::int) as illegal from (
        select conv, lag(left(role, 1)) over (partition by conv order by i) || left(role, 1) as pair from placed) group by conv
), ended as (
    select w.conv, min({{'cost': w.cost + p.cost, 'audit': w.audit || p.edits, 'lines': w.lines || p.lines}}) as x
    from best w join sizes z on w.conv is not distinct from z.conv and w.i = z.n join puts p on p.a = w.s
    where p.b in (0, 3) group by w.conv
)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(x.cost, 0)::bigint as cost,
    coalesce(x.audit, '') as audit, sha256(coalesce(x.lines[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join sizes z on c.conv_id is not distinct from z.conv left join pairs q on c.conv_id is not distinct from q.conv
left join ended e on c.conv_id is not distinct from e.conv
"""


@query("op11_hirschberg_repair", SQL.format(crc=CRC32_SQL))
def op11(spark, sf_dir):
    """What damage and repair make of every conversation."""
    talks = table(spark, sf_dir, "conversations")
    found = digests(damaged(talks))
    every = talks.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in
              ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
