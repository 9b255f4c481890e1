"""Latest snapshot per scope or key out of a stream of updates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill.sources.sinks import SNAPSHOT, add_snapshots, merge_snapshots


def add_batch(batch: DataFrame, path: str) -> None:
    """Append the newest update of each scope in the batch. A repeated batch adds versions
    that are there already, which changes no reader's result."""
    changes = batch.select(*SNAPSHOT.names)
    add_snapshots(merge_snapshots(changes.limit(0), changes, "escopo", "atualizado_em"), path)


def run_snapshots(updates: DataFrame, path: str, checkpoint: str) -> None:
    """Take in the updates that have arrived since the last run, then stop."""
    query = (
        updates.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: add_batch(batch, path))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_state(updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Per key, the row that is largest by `order` (all descending, nulls below values),
    kept in Spark's state store. The aggregate is partial before the shuffle, so a key
    with a third of all rows costs one row per task."""
    return updates.groupBy(key).agg(F.max(F.struct(*order)).alias("_latest"))


def write_latest(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """The keys a batch touched, with their latest row so far, under the batch's number;
    a repeated batch replaces its own file."""

    def write(batch: DataFrame, number: int) -> None:
        batch.select(key, "_latest.*").write.mode("overwrite").parquet(f"{path}/lote={number}")

    return write


def run_latest(updates: DataFrame, key: str, order: Sequence[str], path: str, checkpoint: str) -> None:
    """Takes in the updates that arrived since the last run, then stops (update mode: only
    keys with rows in a batch are written by it)."""
    query = (
        latest_state(updates, key, order).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint).foreachBatch(write_latest(path, key))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_latest(spark: SparkSession, path: str, schema: T.StructType, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of every key over all batches; none yet is an empty table."""
    stored = spark.createDataFrame([], schema)
    try:
        stored = spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    rest = [c for c in schema.names if c != key and c not in order]
    newest = stored.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_latest"))
    return newest.select(key, "_latest.*").select(*schema.names)
