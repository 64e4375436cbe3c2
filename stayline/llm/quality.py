"""Document quality by nearest-neighbour voting in a latent-semantic space.

A whole text becomes counts of hashed terms in two blocks. The first describes how it is
written: shapes of its tokens (case, digits, punctuation), pairs of neighbouring shapes,
shares of repeated tokens and lines, capitals and marks, and a size step. The second holds
what it is written with: its words, in lower case without marks around them, and their last
two and three letters. Sublinear counts with inverse document frequencies, each block
scaled to length one, are projected on the leading singular vectors of the labelled
sample. The labelled vectors are broadcast (at most 2 * PER_CLASS rows of DIM
floats); every document's cosine with every labelled vector is computed exactly, in blocks, and the NEIGHBOURS
most similar vote with the POWER of their similarity, corrected to the labels' true
shares. Texts are scored whole, where they lie: no rows move.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm import labelled
from stayline.llm.labelled import Bag, held_out, sample
from stayline.llm.registry import query, table

PER_CLASS = 2000  # labelled rows of either label that a model is fitted on, at most
STYLE_TERMS = 1 << 12  # buckets of the first block
TERMS = 1 << 14  # buckets of both
DIM = 48
NEIGHBOURS = 25
POWER = 4
THRESHOLD = 0.3
BLOCK = 256  # texts whose products are computed at once
TABLE_WORDS = 300_000


def shape(token: str) -> str:
    """Classes of a token's characters, runs shortened to one: 'Word!!' is 'Aa!'."""
    out = ""
    for ch in token:
        c = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        if not out.endswith(c):
            out += c
    return out[:8]


def bare(token: str) -> str:
    """The token in lower case, without what is neither letter nor digit at its ends."""
    if not token.isalnum():
        inner = [i for i, ch in enumerate(token) if ch.isalnum()]
        token = token[inner[0] : inner[-1] + 1] if inner else ""
    return token.lower()


def _bucket(term: str) -> int:
    return crc32(term.encode("utf-8", "surrogatepass")) % STYLE_TERMS


def _word_bucket(term: str) -> int:
    return STYLE_TERMS + crc32(term.encode("utf-8", "surrogatepass")) % (TERMS - STYLE_TERMS)


class Terms:
    """Hashed term counts of texts; terms of tokens and of pairs of shapes met before are
    kept, a bounded number."""

    def __init__(self):
        self.known: dict[str, tuple[str, int, tuple[int, ...]]] = {}
        self.pairs: dict[tuple[str, str], int] = {}

    def token(self, token: str) -> tuple[str, int, tuple[int, ...]]:
        """Shape of a token, its bucket, and those of the word and its endings."""
        got = self.known.get(token)
        if got is None:
            if len(self.known) > TABLE_WORDS:
                self.known.clear()
            s, word = shape(token), bare(token)
            terms = (_word_bucket("w " + word), _word_bucket("e " + word[-2:]), _word_bucket("e " + word[-3:])) if word else ()
            got = self.known[token] = (s, _bucket("s " + s), terms[:2] if len(word) < 3 else terms)
        return got

    def pair(self, pair: tuple[str, str]) -> int:
        got = self.pairs.get(pair)
        if got is None:
            if len(self.pairs) > TABLE_WORDS:
                self.pairs.clear()
            got = self.pairs[pair] = _bucket(f"p {pair[0]} {pair[1]}")
        return got

    def counts(self, text: str | None) -> dict[int, float]:
        """Occurrences of terms; a text without tokens has the one term 'empty'."""
        tokens = text.split() if text else []
        if not tokens:
            return {_bucket("empty"): 1.0}
        out: dict[int, float] = defaultdict(float)
        shapes = Counter()
        words = Counter(tokens)
        shape_of = {}
        for token, n in words.items():
            s, at, terms = self.token(token)
            shape_of[token] = s
            shapes[s] += n
            out[at] += n
            for term in terms:
                out[term] += n
        in_order = list(map(shape_of.__getitem__, tokens))
        for pair, n in Counter(zip(in_order, in_order[1:])).items():
            out[self.pair(pair)] += n
        n = len(tokens)
        again = n - len(words)
        lines = text.split("\n")
        # shares of the text, in steps, so that texts of any length compare
        for name, share in (
            ("repeats", again / n), ("lines", 1 - len(set(lines)) / len(lines)),
            ("next", sum(a == b for a, b in zip(tokens, tokens[1:])) / n),
            ("upper", sum(k for s, k in shapes.items() if s[:1] == "A" and "a" not in s) / n),
            ("marks", sum(k for s, k in shapes.items() if not s[-1:].isalnum()) / n),
            ("bare", sum(k for s, k in shapes.items() if not any(c.isalnum() for c in s)) / n),
        ):
            out[_bucket(f"{name} {int(share * 10)}")] += 0.1 * n
        out[_bucket(f"size {min(n, 1 << 20).bit_length()}")] += 0.05 * n
        return out


class Model:
    """Inverse frequencies, projection, labelled vectors and labels."""

    def __init__(self, idf, axes, vectors, labels, prior: float):
        self.idf, self.axes, self.vectors, self.labels, self.prior = idf, axes, vectors, labels, prior
        self.terms = Terms()

    def __reduce__(self):
        return Model, (self.idf, self.axes, self.vectors, self.labels, self.prior)

    def project(self, texts: list[str | None]) -> np.ndarray:
        return self.placed([_counted(self.terms.counts(text)) for text in texts])

    def placed(self, bags: list[Bag]) -> np.ndarray:
        """Vectors of length one of some bags."""
        dense = np.empty((len(bags), self.axes.shape[1]), np.float32)
        for row, bag in zip(dense, bags):
            at, values = _weighted(bag, self.idf)
            row[:] = values @ self.axes[at]
        return dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Share of label 1 in the weighted votes of the nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        out = np.empty(len(texts))
        shares = np.array([(self.labels == 0).mean(), (self.labels == 1).mean()])
        worth = np.array([1 - self.prior, self.prior]) / np.maximum(shares, 1e-12)
        for at in range(0, len(texts), BLOCK):
            cosines = self.project(texts[at : at + BLOCK]) @ self.vectors.T
            k = min(NEIGHBOURS, len(self.labels))
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6) ** POWER * worth[self.labels[near]]
            out[at : at + BLOCK] = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return out


def _counted(bag: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """Terms and counts of a text as arrays."""
    return np.fromiter(bag.keys(), np.int32, len(bag)), np.fromiter(bag.values(), np.float32, len(bag))


def _weighted(bag: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a text, the weights of either block of length one."""
    at, counts = bag
    values = np.log1p(counts) * idf[at]
    words = at >= STYLE_TERMS
    for block in (words, ~words):
        values[block] /= max(float(np.linalg.norm(values[block])), 1e-12)
    return at, values


def count(texts: list[str]) -> list[Bag]:
    """The bag of each text."""
    terms = Terms()
    return [_counted(terms.counts(t)) for t in texts]


def fit(texts: list[str], labels: list[int], prior: float) -> Model:
    """A model of whole texts, see `fit_bags`."""
    return fit_bags(count(texts), labels, prior)


def fit_bags(bags: list[Bag], labels: list[int], prior: float) -> Model:
    """Latent space and vectors of a labelled sample; prior is the share of label 1 among
    all labels. Without rows every text scores the prior."""
    y = np.array(labels, dtype=int)
    have = np.zeros(TERMS)
    for at, _ in bags:
        have[at] += 1
    idf = np.log((1 + len(bags)) / (1 + have)) + 0.1
    idf[have == 0] = 0.0
    idf = idf.astype(np.float32)
    axes = _leading([_weighted(bag, idf) for bag in bags], min(DIM, max(1, len(bags))))
    model = Model(idf, axes, np.zeros((0, axes.shape[1]), np.float32), y[:0], prior)
    if len(bags):
        model.vectors, model.labels = model.placed(bags), y
    return model


def _leading(rows: list[tuple[np.ndarray, np.ndarray]], dim: int, rounds: int = 12) -> np.ndarray:
    """Leading right singular vectors of weighted rows by block iteration; BLOCK rows are
    dense at a time."""
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(TERMS, dim)).astype(np.float32))[0]
    for _ in range(rounds):
        after = np.zeros_like(q)
        for first in range(0, len(rows), BLOCK):
            some = rows[first : first + BLOCK]
            dense = np.zeros((len(some), TERMS), np.float32)
            for row, (at, values) in zip(dense, some):
                row[at] = values
            after += dense.T @ (dense @ q)
        q = np.linalg.qr(after)[0]
    return q.astype(np.float32)


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model of `labels.quality` from the rows outside the held-out fold; the prior is
    counted over all of these labels."""
    learnt = labels.filter(~held_out("doc_id") & F.col("quality").isin(0, 1))
    prior = learnt.agg(F.avg("quality").alias("p")).first()["p"]
    prior = 1.0 if prior is None else float(prior)
    return labelled.fitted(sample(docs, labels, "quality", per_class), count, lambda bags, y: fit_bags(bags, y, prior))


def score(text: Column | str, model: Model) -> Column:
    """How much label 1 is likelier, from 0 to 1, for every text; null counts as empty."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.score([x.as_py() for x in batch[at : at + BLOCK]]) for at in range(0, len(batch), BLOCK)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scores(text)


def keep_good(df: DataFrame, text_col: str, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df whose score reaches the threshold, with df's own columns. Null and
    empty texts are scored as the empty text; equal texts have equal scores; an empty
    table stays empty."""
    return df.filter(score(F.col(f"`{text_col}`"), model) >= threshold)


@query("op2_neighbour_vote")
def op2(spark, sf_dir):
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), score("text", model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
