"""The corpus pipeline: documents without toxic, repeated and leaked ones, mixed to target
weights and stored as token ids.

Each stage is one operator over all rows that the stage before has kept. Arrow batches hold
a bounded number of bytes: by rows alone, a batch of texts, or of pairs of shingle sets, is
tens of megabytes in every task, in the executor's native memory and in its Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from creditmill.llm.decontaminate import without_leaks
from creditmill.llm.minhash import one_of_each
from creditmill.llm.mixing import mixed_documents
from creditmill.llm.queries import table, vocabulary
from creditmill.llm.token_store import read_tokens, store_tokens
from creditmill.llm.toxicity import fit, without_toxic
from creditmill.operators.materialize import batches_within, computed_once

# Bytes in one Arrow batch, about.
BATCH_BYTES = 4 << 20
# Text bytes encoded together, half of what the token store takes when it has an executor alone.
CHUNK_BYTES = 1 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine learned from all labels does not reject."""
    with batches_within(spark, BATCH_BYTES):
        return computed_once(without_toxic(docs, fit(docs, table(spark, sf_dir, "labels"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 or more hold together."""
    with batches_within(spark, BATCH_BYTES):
        return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    with batches_within(spark, BATCH_BYTES):
        return computed_once(without_leaks(docs, table(spark, sf_dir, "benchmark")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeated, left out, or cut where a shard has
    its quota of the source. Each part is a row, and a document of the token output."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all documents in files; the rows are read back out of these."""
    return read_tokens(store_tokens(docs, vocabulary(), chunk_bytes=CHUNK_BYTES))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# A learned model, links of a similarity, edits and files are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = computed_once(stage(spark, docs, sf_dir))
    return docs
