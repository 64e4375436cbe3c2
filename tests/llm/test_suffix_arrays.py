"""Suffix arrays and what they remove, against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from stayline.llm import queries, suffix_arrays


def brute(texts, window=100):
    """(n_bytes, n_removed, n_spans, kept) of each text, in order, by a set of all windows."""
    seen, out = set(), []
    for b in texts:
        gone = bytearray(len(b))
        for o in range(len(b) - window + 1):
            w = b[o : o + window]
            if w in seen:
                gone[o : o + window] = b"\1" * window
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("symbols", [1, 2, 3, 8, 200])
@pytest.mark.parametrize("induced", ["_induced", "_induced_singly"])
def test_suffix_array(symbols, induced, monkeypatch):
    for name in ("_induced", "_induced_singly"):
        monkeypatch.setattr(suffix_arrays, name, getattr(suffix_arrays, induced))
    draw = random.Random(symbols)
    for _ in range(60):
        t = np.array([draw.randint(1, symbols) for _ in range(draw.randint(0, 60))] + [0])
        assert suffix_arrays.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_equal_windows():
    draw = random.Random(1)
    for _ in range(200):
        parts = list(dict.fromkeys(bytes(draw.choice([0, 97, 98]) for _ in range(draw.randint(3, 40))) for _ in range(5)))
        want, got = defaultdict(list), defaultdict(list)
        for p, b in enumerate(parts):
            for o in range(len(b) - 4):
                want[b[o : o + 5]].append((p, o))
        for p, o, g in zip(*(x.tolist() for x in suffix_arrays.equal_windows(parts, 5))):
            got[g].append((p, o))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    assert suffix_arrays.equal_windows([])[0].size == 0


def test_every_window_lies_in_one_run():
    draw = random.Random(2)
    docs = [bytes(draw.choice(b"abcd \x00") for _ in range(n)) for n in (0, 99, 100, 101, 700, 5000)] + [b"x" * 9000, b"ab" * 400]
    data, ends = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([len(d) for d in docs if d])
    runs = suffix_arrays.Runs(data, ends)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(runs.at, runs.windows)])
    starts = np.concatenate([[0], ends[:-1]])
    want = np.concatenate([np.arange(s, max(s, e - 99)) for s, e in zip(starts, ends)])
    assert np.array_equal(np.sort(covered), want) and runs.windows.max() <= suffix_arrays.RUN
    by_window = {}
    for a, n, p in zip(runs.at.tolist(), runs.windows.tolist(), runs.print.tolist()):
        for i in range(a, a + n):
            assert by_window.setdefault(data[i : i + 100].tobytes(), p) == p


def texts(seed):
    """Prose with copies, near copies, shared passages, periodic and short texts, wide characters."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(300)] + ["é", "日本", "\x00"]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage, phrase = prose(40), prose(12)
    out = [prose(draw.randint(0, 200)) for _ in range(40)]
    out += [out[3], out[3], out[5][:200] + "X" + out[5][200:], out[7] + out[8], "x" * 5000, "x" * 150, "ab" * 300, "", "short", "short"]
    out += [prose(30) + passage + prose(20) for _ in range(30)]  # a third holds one passage or phrase
    out += [prose(10) + phrase + prose(10) for _ in range(30)]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 5000, "shard_bytes": 4000, "bucket_bytes": 8000}, {"batch_bytes": 9000, "hot": 3}])
def test_removed_bytes_equal_brute_force(spark, sizes, tmp_path):
    said = texts(4)
    spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(said)], "doc_id long, text string, batch string, row int") \
        .repartition(6).write.parquet(f"{tmp_path}/d")
    rows = suffix_arrays.deduplicated(spark.read.parquet(f"{tmp_path}/d"), **sizes).orderBy("id").collect()
    want = brute([t.encode() for t in said])
    assert [(r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows] == want
    for r, t in zip(rows, said):
        b = t.encode()
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        ends = [0, *[x for s in r["spans"] for x in (s["start"], s["end"])], len(b)]
        assert b"".join(b[a:e] for a, e in zip(ends[::2], ends[1::2])) == bytes(r["kept"])


def test_awkward_rows(spark, awkward, empty, tmp_path):
    awkward.write.parquet(f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a")
    rows = suffix_arrays.deduplicated(stored).collect()
    assert len(rows) == awkward.count()
    for r in awkward.filter("doc_id = 14").collect():  # one word 3,000 times
        assert [x["n_removed"] for x in rows if x["id"] == 14] == [brute([r["text"].encode()])[0][1]]
    assert suffix_arrays.deduplicated(empty).count() == 0
    twice = spark.createDataFrame([(1, "q" * 50 + "w" * 80)] * 3 + [(None, "q" * 50 + "w" * 80)], "doc_id long, text string")
    twice.write.parquet(f"{tmp_path}/t")
    got = sorted((r["id"] is None, r["n_removed"]) for r in suffix_arrays.deduplicated(spark.read.parquet(f"{tmp_path}/t")).collect())
    assert got == [(False, 0), (False, 130), (False, 130), (True, 130)]


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    want = brute([(r["text"] or "").encode() for r in docs])
    rows = {r["doc_id"]: r for r in queries.queries()["op13_suffix_arrays"](spark, folder).collect()}
    assert len(rows) == len(docs)
    for r, (n, gone, spans, kept) in zip(docs, want):
        got = rows[r["doc_id"]]
        assert (got["n_bytes"], got["n_removed"], got["n_spans"], got["kept_sha256"]) == (n, gone, spans, hashlib.sha256(kept).hexdigest())
