"""The corpus pipeline: toxicity, quality, near-duplicates, secrets, packing.

Every stage reads what its predecessor kept, written as Parquet in the shared folder.
The first four return the columns of documents: documents the classifiers reject go,
one document of each class of near-duplicates stays (the smallest doc_id), and secrets are
cut out of the texts. The last one gives each document its place in a batch.

Classifiers learn from the labels of the documents they are given, outside the held-out
fold. Nulls, empty texts, repeated rows and empty tables are treated as each operator says;
a row that repeats a kept document counts as its copy. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import order_minhash, packing, quality, secret_scan, toxicity
from stayline.llm.registry import table, unused
from stayline.sources.store import store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword softmax scores below its threshold."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, "text", model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours vote for them."""
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, "text", model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return order_minhash.keep_first(docs)


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; n_chars follows."""
    base, spans = unused(docs, "_base", "_spans")
    found = secret_scan.scan(docs, "text", base_as=base, spans_as=spans)
    clean = secret_scan.redact(F.col("text"), F.col(spans))
    out = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = F.when(F.size(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, padded_to, batch and slot of every document."""
    return packing.packed(docs, packing.tokens("text"), ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near-duplicates", drop_copies),
    ("secrets", cut_secrets),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result but the last is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
