"""Exact removal of repeated byte strings with suffix arrays by induced sorting.

Every byte that a string of WINDOW bytes covers goes if the string also starts earlier: in a
smaller document, or earlier in the same one.

A suffix array sorts all suffixes of a text. Suffixes are classified as smaller or larger than
their successor; the leftmost smaller ones cut the text into substrings, which are
sorted by inducing and named; if names repeat, the string of names is sorted in the same way,
recursively; two linear passes induce the order of all suffixes from that of the leftmost
smaller ones. Common prefixes of neighbours are computed in text order (permuted): where
the characters before a suffix and its neighbour agree, the prefix is one shorter than the one before,
so only the others are compared. Neighbours that agree in WINDOW bytes are one string.

The corpus is sorted in shards that need not know each other. The fingerprint of a window is
the least hash among its substrings of GRAM bytes, so equal windows have equal fingerprints.
Neighbouring windows with one fingerprint form a run, each window lies in exactly one run, and
a shard gets the runs of its fingerprints: everything that can be equal meets in one
array. Runs whose fingerprint the corpus has once are not shipped; equal runs of a batch of
documents are shipped once, with their first place. A fingerprint with more than HOT
different runs is split further, by the hash of the whole window, so that a phrase that a large
share of the documents holds does not fill one shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table

WINDOW = 100
GRAM = 50
SPREAD = WINDOW - GRAM + 1  # grams of a window
STEP = 1 << 19  # windows hashed at once
RUN = 4096  # windows of a run, at most
BATCH_BYTES = 8 << 20  # text of a batch of documents
SHARD_BYTES = 4 << 20  # text that a shard of fingerprints stands for
BUCKET_BYTES = 24 << 20  # text that a bucket of fingerprint counts stands for
HOT = 4096
_BASE = 0x9E3779B97F4A7C15


# -- suffix arrays ------------------------------------------------------------


def _smaller(t: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor; t ends with its only least symbol."""
    differs = np.flatnonzero(t[:-1] != t[1:])
    out = np.ones(len(t), bool)
    out[:-1] = np.repeat(t[differs] < t[differs + 1], np.diff(differs, prepend=-1))
    return out


def _dealt(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, the different symbols, their counts, and ranks inside them."""
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(first, append=len(ordered))
    return order, ordered[first], counts, np.arange(len(ordered)) - np.repeat(first, counts)


def _induced(t: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The order of all suffixes that an order of the leftmost smaller ones induces. A bucket,
    the suffixes with one first symbol, is taken in waves: all at once that it holds so far."""
    sizes = np.bincount(t)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(len(t), np.int64)
    order, symbols, counts, _ = _dealt(t[leftmost])
    given = dict(zip(symbols.tolist(), np.split(leftmost[order], np.cumsum(counts)[:-1])))
    present = np.flatnonzero(sizes).tolist()

    head = starts.copy()
    for c in present:
        at = starts[c]
        while True:
            wave = out[at : head[c]]
            at = head[c]
            if not len(wave):
                if c not in given:
                    break
                wave = given.pop(c)  # behind the larger ones of the bucket
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                order, symbols, counts, rank = _dealt(t[before])
                out[np.repeat(head[symbols], counts) + rank] = before[order]
                head[symbols] += counts

    tail = ends.copy()
    out[0] = len(t) - 1
    tail[0] = 0
    for c in reversed(present):
        at, done = ends[c], False
        while True:
            wave = out[tail[c] : at][::-1]
            at = tail[c]
            if not len(wave):
                if done:
                    break
                wave, done = out[starts[c] : head[c]][::-1], True  # the larger ones
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                order, symbols, counts, rank = _dealt(t[before])
                out[np.repeat(tail[symbols], counts) - 1 - rank] = before[order]
                tail[symbols] -= counts
    return out


def _induced_singly(t: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The same, one suffix after the other: for texts of many symbols."""
    ends = np.cumsum(np.bincount(t))
    starts = np.concatenate([[0], ends[:-1]])
    out = np.full(len(t), -1, np.int64)
    order, symbols, counts, rank = _dealt(t[leftmost])
    out[np.repeat(ends[symbols] - counts, counts) + rank] = leftmost[order]
    sa, text, small, head = out.tolist(), t.tolist(), smaller.tolist(), starts.tolist()
    for i in sa:
        if i > 0 and not small[i - 1]:
            c = text[i - 1]
            sa[head[c]] = i - 1
            head[c] += 1
    tail = ends.tolist()
    for j in range(len(sa) - 1, -1, -1):
        i = sa[j]
        if i > 0 and small[i - 1]:
            c = text[i - 1]
            tail[c] -= 1
            sa[tail[c]] = i - 1
    return np.array(sa, np.int64)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Places of all suffixes of t in order; t holds whole numbers and ends with 0, which it
    has nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _smaller(t)
    induced = _induced if n > 100 * int(t.max()) else _induced_singly
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) > 1:
        mark = np.zeros(n, bool)
        mark[leftmost] = True
        sa = induced(t, smaller, leftmost)
        sorted_ = sa[mark[sa]]
        size = np.zeros(n, np.int64)
        size[leftmost] = np.diff(leftmost, append=n - 1) + 1
        a, b = sorted_[:-1], sorted_[1:]
        new = size[a] != size[b]
        open_ = np.flatnonzero(~new)
        at = 0
        while len(open_):  # substrings that agree so far
            differ = t[a[open_] + at] != t[b[open_] + at]
            new[open_[differ]] = True
            at += 1
            open_ = open_[~differ]
            open_ = open_[size[a[open_]] > at]
        names = np.empty(n, np.int64)
        names[sorted_] = np.concatenate([[0], np.cumsum(new)])
        leftmost = leftmost[suffix_array(names[leftmost])] if not new.all() else sorted_
    return induced(t, smaller, leftmost)


def common_prefixes(data: np.ndarray, t: np.ndarray, sa: np.ndarray, start: np.ndarray, most: int) -> np.ndarray:
    """Length of the prefix that each suffix of data has in common with the one before it in
    sa, the order of the suffixes of t, at its place in the text; `most` at most. Where `start`
    holds, the length isn't derived from the place before."""
    n = len(data)
    near = np.empty(n, np.int64)
    near[sa[1:]] = sa[:-1]
    near[sa[0]] = n  # none
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).tobytes()
    words = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded, "<u8", offset=k, count=(len(padded) - k) // 8)
        slots = words[k::8]
        slots[:] = part[: len(slots)]
    own = start.copy()
    own[0] = True
    inside = np.flatnonzero(~own)
    other = near[inside] - 1
    own[inside] = (near[inside] == n) | (other < 0) | (t[inside - 1] != t[np.maximum(other, 0)])
    first = np.flatnonzero(own)
    length = np.zeros(len(first), np.int64)
    open_ = np.flatnonzero(near[first] < n)
    a, b = first[open_], near[first[open_]]
    while len(open_):
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        ended = (differ != 0) | (np.maximum(a, b) >= n)
        low = differ & (~differ + np.uint64(1))
        length[open_] += np.where(differ == 0, 8, np.frexp(low.astype(np.float64))[1] - 1 >> 3)
        keep = ~ended & (length[open_] < most)
        open_, a, b = open_[keep], a[keep] + 8, b[keep] + 8
    spread = np.diff(first, append=n)
    return np.minimum(np.repeat(length, spread) - (np.arange(n) - np.repeat(first, spread)), most)


def equal_windows(parts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, offset, group) of the windows of some texts that occur more than once, by group."""
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\x00".join(parts) + b"\x00", np.uint8)
    breaks = starts + sizes
    t = data.astype(np.int16) + 2
    t[breaks] = 1
    sa = suffix_array(np.concatenate([t, np.zeros(1, np.int16)]))[1:]
    after = np.zeros(len(data), bool)
    after[starts] = True
    lcp = common_prefixes(data, t, sa, after, int(sizes.max(initial=0)) + 1)
    of = np.repeat(np.arange(len(parts)), sizes + 1)
    left = breaks[of] - np.arange(len(data))  # a match ends with its text
    before = np.concatenate([[0], sa[:-1]])
    same = (np.minimum(lcp[sa], np.minimum(left[sa], left[before])) >= window) & (np.arange(len(sa)) > 0)
    group = np.cumsum(~same)
    shared = same | np.concatenate([same[1:], [False]])
    places = sa[shared]
    return of[places], places - starts[of[places]], group[shared]


# -- fingerprints -------------------------------------------------------------


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _slid(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of every `width` neighbours."""
    done = 1
    while 2 * done <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


class Runs:
    """Runs of windows with one fingerprint in a buffer of documents: print, at, windows,
    body (hash of the run's bytes) and again (whether the fingerprint's gram comes twice in it)."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, parts = data, []
        for a in range(0, len(data) - WINDOW + 1, STEP):
            parts.append(self._block(a, min(a + STEP, len(data) - WINDOW + 1), ends))
        columns = zip(*parts) if parts else [[np.zeros(0, d)] for d in (np.uint64, np.int64, np.int64, np.uint64, bool)]
        self.print, self.at, self.windows, self.body, self.again = (np.concatenate(list(c)) for c in columns)

    def _sums(self, a: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums that give the hash of any substring, and what they are scaled with."""
        n = e - a
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data[a:e].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, STEP + WINDOW)[:n], out=sums[1:])
        return sums, _powers(pow(_BASE, -1, 1 << 64), STEP + WINDOW)

    def _block(self, a: int, b: int, ends: np.ndarray):
        sums, back = self._sums(a, b + WINDOW - 1)
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(sums) - GRAM])
        least = _slid(grams, SPREAD, np.minimum)
        near = ends[np.searchsorted(ends, a, "right") : np.searchsorted(ends, b + WINDOW, "left") + 1] - a
        edge = np.zeros(len(least) + 1, np.int64)
        np.add.at(edge, np.clip(near - WINDOW + 1, 0, len(least)), 1)
        np.add.at(edge, np.clip(near, 0, len(least)), -1)
        whole = np.cumsum(edge[:-1]) == 0  # the window lies in one document
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(change)
        windows = np.diff(at, append=len(least))
        at, windows = at[whole[at]], windows[whole[at]]
        if len(windows) and windows.max() > RUN:
            pieces = -(-windows // RUN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at, left = np.repeat(at, pieces) + nth * RUN, np.repeat(windows, pieces) - nth * RUN
            windows = np.minimum(left, RUN)
        prints = least[at]
        body = _mix((sums[at + windows + WINDOW - 1] - sums[at]) * back[at])
        # places of grams that are the least of a window
        wide = np.concatenate([np.zeros(SPREAD - 1, np.uint64), least, np.zeros(SPREAD - 1, np.uint64)])
        chosen = np.flatnonzero(grams == _slid(wide, SPREAD, np.maximum))
        low, high = np.searchsorted(chosen, at), np.searchsorted(chosen, at + windows + SPREAD - 1)
        run = np.repeat(np.arange(len(at)), high - low)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        found = grams[chosen[low[run] + nth]] == prints[run]
        again = np.bincount(run[found], minlength=len(at)) > 1
        return prints, at + a, windows, body, again

    def singly(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash of the whole window) of every window of some runs."""
        windows = self.windows[runs]
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.repeat(self.at[runs], windows) + nth
        prints = np.empty(len(at), np.uint64)
        for a in range(0, len(self.data), STEP):
            here = np.flatnonzero((at >= a) & (at < a + STEP))
            if len(here):
                sums, back = self._sums(a, min(a + STEP + WINDOW - 1, len(self.data)))
                x = at[here] - a
                prints[here] = _mix(_mix((sums[x + WINDOW] - sums[x]) * back[x]) + np.uint64(1))
        return at, prints

    def classes(self, wanted: np.ndarray, hot: np.ndarray):
        """Equal runs among the wanted ones, hot ones window by window: (place, windows, print,
        whether a single window of a hot run, again, class) of each, in order, and the bytes of
        each class."""
        own = np.flatnonzero(wanted & ~hot)
        at, prints = self.singly(np.flatnonzero(wanted & hot))
        at, prints = np.concatenate([self.at[own], at]), np.concatenate([self.print[own], prints])
        windows = np.concatenate([self.windows[own], np.ones(len(at) - len(own), np.int64)])
        again = np.concatenate([self.again[own], np.zeros(len(at) - len(own), bool)])
        order = np.argsort(at)
        at, prints, windows, single, again = at[order], prints[order], windows[order], order >= len(own), again[order]
        known: dict[bytes, int] = {}
        raw = self.data.tobytes() if len(at) else b""
        of = [known.setdefault(raw[a : a + n], len(known)) for a, n in zip(at.tolist(), (windows + WINDOW - 1).tolist())]
        return at, windows, prints, single, again, np.array(of, np.int64), list(known)


# -- Spark --------------------------------------------------------------------


class _Batch:
    """The documents of a batch, in order, as one buffer."""

    def __init__(self, docs: pa.Table):
        docs = docs.sort_by([("doc", "ascending"), ("row", "ascending")])
        self.docs = docs
        text = docs["text"].combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks)
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        self.data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.ends = offsets[1:] - offsets[0]
        self.starts = offsets[:-1] - offsets[0]
        self.runs = Runs(self.data, self.ends[self.ends > self.starts])


def _counted(buckets: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        """Fingerprints of a batch with how many different runs they have, by bucket."""
        runs = _Batch(docs).runs
        order = np.lexsort((runs.body, runs.print))
        prints, body = runs.print[order], runs.body[order]
        new = np.ones(len(prints), bool)
        new[1:] = prints[1:] != prints[:-1]
        other = new.copy()
        other[1:] |= body[1:] != body[:-1]
        first = np.flatnonzero(new)
        kinds = np.add.reduceat(other.astype(np.uint32), first).astype(np.uint32) if len(first) else np.zeros(0, np.uint32)
        prints = prints[first]
        bucket = (prints % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1 if len(order) else []
        groups = np.split(order, cuts) if len(order) else []
        return pa.table({
            "bucket": pa.array([int(bucket[g[0]]) for g in groups], pa.int64()),
            "batch": pa.array([key[0].as_py()] * len(groups), pa.int64()),
            "prints": pa.array([prints[g].tobytes() for g in groups], pa.binary()),
            "kinds": pa.array([kinds[g].tobytes() for g in groups], pa.binary()),
        })

    return run


def _shared(most: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Fingerprints of a bucket that several batches have, or that are hot, for each batch."""
        lists = [np.frombuffer(x, np.uint64) for x in rows["prints"].to_pylist()]
        prints = np.concatenate(lists)
        kinds = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["kinds"].to_pylist()])
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        _, of, times = np.unique(prints, return_inverse=True, return_counts=True)
        hot = (np.bincount(of, kinds) > most)[of]
        wanted = np.flatnonzero((times[of] > 1) | hot)
        cuts = np.searchsorted(row[wanted], np.arange(1, len(lists)))
        groups = np.split(wanted, cuts)
        batch = rows["batch"].to_pylist()
        some = [i for i, g in enumerate(groups) if len(g)]
        return pa.table({
            "batch": pa.array([batch[i] for i in some], pa.int64()),
            "prints": pa.array([prints[groups[i]].tobytes() for i in some], pa.binary()),
            "hot": pa.array([hot[groups[i]].tobytes() for i in some], pa.binary()),
        })

    return run


def _joined(parts: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _shipped(shards: int):
    def run(key: tuple, docs: pa.Table, shared: pa.Table) -> pa.Table:
        """The different runs of a batch that may repeat, with their first place."""
        batch = _Batch(docs) if docs.num_rows else None
        if batch is None:
            return _SHIPPED.empty_table()
        runs = batch.runs
        prints = _joined(shared["prints"].to_pylist(), np.uint64)
        hot = prints[_joined(shared["hot"].to_pylist(), bool)]
        _, of, times = np.unique(runs.print, return_inverse=True, return_counts=True)
        here = np.unique(runs.print[runs.again | (times[of] > 1)]) if len(of) else prints
        wanted = np.isin(runs.print, prints) | np.isin(runs.print, here)
        at, _, found, single, again, of, bodies = runs.classes(wanted, np.isin(runs.print, hot))
        _, first = np.unique(of, return_index=True)
        at = at[first]
        doc = np.searchsorted(batch.ends, at, "right")
        return pa.table([
            pa.array((found[first] % np.uint64(shards)).astype(np.int64)), pa.array(np.full(len(at), key[0].as_py(), np.int64)),
            pa.array(batch.docs["doc"].to_numpy()[doc]), pa.array(batch.docs["row"].to_numpy()[doc]),
            pa.array(at - batch.starts[doc]), pa.array(at), pa.array(single[first]), pa.array(again[first]),
            pa.array(found[first].view(np.int64)), pa.array(bodies, pa.binary()),
        ], schema=_SHIPPED)

    return run


_SHIPPED = pa.schema([
    ("shard", pa.int64()), ("batch", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()),
    ("at", pa.int64()), ("single", pa.bool_()), ("again", pa.bool_()), ("print", pa.int64()), ("body", pa.binary())])


def _sorted(key: tuple, rows: pa.Table) -> pa.Table:
    """For each run of a shard where it is met first: its windows that are met earlier still,
    as bytes of 0 and 1; null where the whole run is met earlier. A run that is the only one of its
    fingerprint, which its bytes hold once, has no window that comes again and needs no array."""
    known: dict[bytes, int] = {}
    of = np.array([known.setdefault(b, len(known)) for b in rows["body"].to_pylist()], np.int64)
    doc, row, start = (rows[c].to_numpy() for c in ("doc", "row", "start"))
    order = np.lexsort((start, row, doc, of))
    first = order[np.concatenate([[True], of[order][1:] != of[order][:-1]])]  # by class
    _, kin, kinds = np.unique(rows["print"].to_numpy()[first], return_inverse=True, return_counts=True)
    open_ = np.flatnonzero((kinds[kin] > 1) | rows["again"].to_numpy(zero_copy_only=False)[first])
    bodies = list(known)
    part, offset, group = equal_windows([bodies[c] for c in open_])
    part = open_[part]
    place = first[part]
    order = np.lexsort((start[place] + offset, row[place], doc[place], group))
    later = order[1:][group[order][1:] == group[order][:-1]]
    sizes = np.array([len(b) - WINDOW + 1 for b in known])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    marks = np.zeros(bounds[-1], np.uint8)
    marks[bounds[part[later]] + offset[later]] = 1
    raw = marks.tobytes()
    told: list[bytes | None] = [None] * len(of)
    for c, i in enumerate(first.tolist()):
        told[i] = raw[bounds[c] : bounds[c + 1]]
    return pa.table([rows["batch"], rows["at"], rows["single"], pa.array(told, pa.binary())], names=["batch", "at", "single", "marks"])


def _removed(batch: _Batch, answers: pa.Table) -> np.ndarray:
    """True for the bytes of a batch that go."""
    runs, n = batch.runs, len(batch.data)
    edge = np.zeros(n + 1, np.int64)
    if answers.num_rows:
        places, single = answers["at"].to_numpy(), answers["single"].to_numpy(zero_copy_only=False)
        prints = runs.print[np.searchsorted(runs.at, places, "right") - 1]
        hot = np.isin(runs.print, prints[single])
        at, windows, _, _, _, of, _ = runs.classes(np.isin(runs.print, prints), hot)
        told = dict(zip(places.tolist(), answers["marks"].to_pylist()))
        _, first = np.unique(of, return_index=True)
        whole = np.ones(len(at), bool)
        for i in first.tolist():
            marks = told[int(at[i])]
            if marks is not None:
                whole[i] = False
                starts = at[i] + np.flatnonzero(np.frombuffer(marks, np.uint8))
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WINDOW, -1)
        np.add.at(edge, at[whole], 1)
        np.add.at(edge, at[whole] + windows[whole] + WINDOW - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """What is left of the documents of a batch."""
    if not docs.num_rows:
        return _CUT.empty_table()
    batch = _Batch(docs)
    gone = _removed(batch, answers)
    left = np.concatenate([[0], np.cumsum(~gone)])
    offsets = np.concatenate([left[batch.starts[:1]], left[batch.ends]])
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(batch.ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(batch.data[~gone])])
    spans = []
    for a, b, n in zip(batch.starts.tolist(), batch.ends.tolist(), np.diff(offsets).tolist()):
        if n == b - a:
            spans.append([])
            continue
        turn = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)).tolist()
        spans.append([{"start": x, "end": y} for x, y in zip(turn[::2], turn[1::2])])
    sizes = batch.ends - batch.starts
    return pa.table([
        batch.docs["id"].combine_chunks(), pa.array(sizes), pa.array(sizes - np.diff(offsets)),
        pa.array(spans, _CUT.field("spans").type), kept.cast(pa.binary())], schema=_CUT)


_CUT = pa.schema([
    ("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def deduplicated(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES, hot: int = HOT,
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row of df: its bytes in UTF-8, how many of
    them go, the spans that go (start and end, by bytes) and the bytes that stay.

    A null text counts as empty; texts of any length are whole; documents are ordered by id,
    those without one last; rows that share an id are documents of their own, in the
    order of the stored table, so of repeated rows the first stays; documents of less than
    100 bytes stay as they are; an empty table gives an empty one. Other columns of df are
    not looked at. df must be stored: it is read more than once.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text")
    key = F.col(f"`{id_col}`").cast("long")
    total = df.agg(F.sum(F.octet_length(f"`{text_col}`"))).first()[0] or 0
    batches, shards, buckets = (max(1, math.ceil(total / n)) for n in (batch_bytes, shard_bytes, bucket_bytes))
    docs = df.select(
        key.alias("id"), F.coalesce(key, F.lit(2**63 - 1)).alias("doc"), F.monotonically_increasing_id().alias("row"), text)
    docs = docs.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)))  # moved once: the three uses share it
    counts = docs.groupBy("batch").applyInArrow(_counted(buckets), "bucket long, batch long, prints binary, kinds binary")
    shared = counts.groupBy("bucket").applyInArrow(_shared(hot), "batch long, prints binary, hot binary")
    shipped = docs.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        _shipped(shards), "shard long, batch long, doc long, row long, start long, at long, single boolean, again boolean, print long, body binary")
    answers = shipped.groupBy("shard").applyInArrow(_sorted, "batch long, at long, single boolean, marks binary")
    return docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _cut, "id long, n_bytes long, n_removed long, spans array<struct<start long, end long>>, kept binary")


@query("op13_suffix_arrays")
def op13(spark, sf_dir):
    """What is left of every document without repeated strings of 100 bytes."""
    out = deduplicated(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
