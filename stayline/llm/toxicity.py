"""Toxicity by averaged subword embeddings under a linear softmax, trained in numpy.

A word is the bag of its character n-grams, hashed into BUCKETS embeddings; a text is
the average of its words' averages; a linear softmax tells the two labels apart.
Embeddings and softmax are trained together, so a misspelt or inflected word that no
training text holds still gets its meaning from the n-grams it shares with known ones.

Both layers are linear, so for scoring each n-gram comes down to one number and each
word to the mean of a few. Workers keep the words they have met in a bounded table.
Only the fit uses a bounded sample of labelled rows (PER_CLASS of either label); every
text is scored whole, where it lies: no rows move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm import labelled
from stayline.llm.labelled import Bag, held_out, sample
from stayline.llm.registry import query, table

PER_CLASS = 2500  # labelled rows of either label that a model is fitted on, at most
BUCKETS = 1 << 16
SIZES = (3, 4, 5)
DIM = 4
EPOCHS, BATCH, RATE, DECAY = 12, 16, 0.05, 0.01
START = 0.01
PADDING = 10  # words with a zero embedding that every text is averaged with
LEAST_DOCS = 10  # n-grams of fewer documents of the sample keep the zero embedding
THRESHOLD = 0.5
TABLE_WORDS = 300_000
BLOCK = 256  # texts whose new words are looked up at once
_EDGES = ".,;:!?*$%&#|\"'()[]{}<>«»…-_=~`"


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, each marked at both ends, and of the whole
    words; beside them the number of the word."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(codes)) - np.repeat(starts, sizes)).astype(np.uint64)
    whole = np.add.reduceat(_mix(codes + (place << np.uint64(32))), starts)
    buckets, of = [(_mix(whole) % np.uint64(BUCKETS)).astype(np.int32)], [np.arange(len(words), dtype=np.int32)]
    for n in SIZES:
        count = len(codes) - n + 1
        if count < 1:
            continue
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = (h ^ codes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = word[:count] == word[n - 1 :]
        buckets.append((h[inside] % np.uint64(BUCKETS)).astype(np.int32))
        of.append(word[:count][inside])
    return np.concatenate(buckets), np.concatenate(of)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def split(text: str) -> list[str]:
    """Words with their punctuation; `plain` takes it off."""
    return text.split()


def plain(word: str) -> str:
    return word.strip(_EDGES).lower()


class Model:
    """One number for each n-gram bucket, and a bias: the softmax over mean embeddings."""

    def __init__(self, weights: np.ndarray, bias: float, default: float):
        self.weights, self.bias, self.default = weights.astype(np.float32), bias, default
        self.words: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.default)

    def learn(self, texts: list[list[str]]) -> None:
        """Put all words of some texts into the table."""
        new = list({w for words in texts for w in words if w not in self.words})
        if len(self.words) + len(new) > TABLE_WORDS:
            self.words.clear()
            new = list({w for words in texts for w in words})
        buckets, word = grams([plain(w) for w in new])
        worth = np.bincount(word, self.weights[buckets], len(new)) / np.maximum(np.bincount(word, minlength=len(new)), 1)
        self.words.update(zip(new, worth.tolist()))

    def scores(self, texts: list[str | None]) -> list[float]:
        bags, out = [split(t) if t else [] for t in texts], []
        self.learn(bags)
        for words in bags:
            z = sum(map(self.words.__getitem__, words)) / (len(words) + PADDING) + self.bias
            out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))) if words else self.default)
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _bags(texts: list[str]) -> list[Bag]:
    """For each text its n-gram buckets and what each adds to the average over its words."""
    index: dict[str, int] = {}
    rows = [[index.setdefault(plain(w), len(index)) for w in split(t)] for t in texts]
    buckets, word = grams(list(index))
    buckets = buckets[np.argsort(word, kind="stable")]
    ends = np.cumsum(np.bincount(word, minlength=len(index)))
    starts = np.concatenate([[0], ends[:-1]])
    out = []
    for row in rows:
        at, counts = np.unique(row, return_counts=True)
        own = [buckets[starts[i] : ends[i]] for i in at]
        sizes = ends[at] - starts[at]
        found, place = np.unique(np.concatenate(own), return_inverse=True)
        share = np.bincount(place, np.repeat(counts / (counts.sum() + PADDING) / sizes, sizes))
        out.append((found, share.astype(np.float32)))
    return out


def count(texts: list[str]) -> list[Bag]:
    """The bag of each text; empty for one without words."""
    full = [i for i, t in enumerate(texts) if t.split()]
    out: list[Bag] = [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * len(texts)
    for at in range(0, len(full), BLOCK):  # a block's words at a time, so that few are held
        some = full[at : at + BLOCK]
        for i, bag in zip(some, _bags([texts[i] for i in some])):
            out[i] = bag
    return out


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """A model of whole texts, see `fit_bags`."""
    return fit_bags(count(texts), labels, seed)


def fit_bags(bags: list[Bag], labels: list[int], seed: int = 7) -> Model:
    """Train on the bags of whole texts, both labels with equal weight: Adam over small batches,
    whose second moments tell n-grams with a steady effect from those with a chance one. Texts
    without words don't count; without rows of both labels every text scores 0."""
    keep = [i for i, (b, _) in enumerate(bags) if len(b)]
    y = np.array([labels[i] for i in keep], dtype=int)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(BUCKETS), -60.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(keep))
    y = y[order]
    bags = [bags[keep[i]] for i in order]
    in_docs = np.zeros(BUCKETS, int)
    for b, _ in bags:
        in_docs[b] += 1
    known = np.flatnonzero(in_docs >= min(LEAST_DOCS, len(y)))
    place = np.full(BUCKETS, -1, np.int32)
    place[known] = np.arange(len(known))
    for i, (b, x) in enumerate(bags):  # in place, so that the sample is held once
        at = place[b]
        bags[i] = at[at >= 0], x[at >= 0]
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())

    embed = rng.normal(0, START, (len(known), DIM))
    linear, bias = rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    params = [embed, linear, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    batches = [np.arange(i, min(i + BATCH, len(y))) for i in range(0, len(y), BATCH)]
    step = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            rows = batches[k]
            gram, share = (np.concatenate([bags[i][part] for i in rows]) for part in (0, 1))
            of = np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows])
            step += 1
            spread = embed[gram] * share[:, None]
            docs = np.stack([np.bincount(of, spread[:, d], len(rows)) for d in range(DIM)], 1)
            logits = docs @ linear + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[rows][:, None] / len(rows)
            back = (p @ linear.T)[of] * share[:, None]
            to_gram = np.stack([np.bincount(gram, back[:, d], len(known)) for d in range(DIM)], 1)
            for j, (param, grad) in enumerate(zip(params, [to_gram, docs.T @ p, p.sum(axis=0)])):
                first[j] += 0.1 * (grad - first[j])
                second[j] += 0.001 * (grad * grad - second[j])
                rate = RATE * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                param -= rate * first[j] / (np.sqrt(second[j]) + 1e-10) + RATE * DECAY * param
    weights = np.zeros(BUCKETS)
    weights[known] = embed @ (linear[:, 1] - linear[:, 0])
    return Model(weights, float(bias[1] - bias[0]), 0.0)


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model of `labels.toxic` from the rows outside the held-out fold."""
    return labelled.fitted(sample(docs, labels, "toxic", per_class), count, fit_bags)


def score(text: Column | str, model: Model) -> Column:
    """Probability of label 1; 0 for null texts and texts without words."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[float] = []
            for at in range(0, len(batch), BLOCK):
                out += model.scores(batch[at : at + BLOCK].to_pylist())
            yield pa.array(out, pa.float64())

    return scores(text)


def keep_clean(df: DataFrame, text_col: str, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df whose score is below the threshold, with df's own columns. Null and
    empty texts stay; equal texts have equal scores; an empty table stays empty."""
    return df.filter(score(F.col(f"`{text_col}`"), model) < threshold)


@query("op6_subword_softmax")
def op6(spark, sf_dir):
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), score("text", model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
