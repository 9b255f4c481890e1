"""Results that several branches of one query read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the session names. Only a local session may have none and gets a
    temporary one: on a cluster each machine would write to its own disk."""
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="creditmill-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def computed_once(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared checkpoint folder, for plans that read it twice.

    The table outlives any executor, and each reader takes only the columns it needs.
    It stays until the folder is cleaned, or the surrounding `tables_dropped` ends.
    """
    path = f"{checkpoint_root(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_within(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of at most about `size` bytes, or one row, for what runs inside: by
    the number of rows alone, their memory grows with the length of texts, in the executor
    and in its Python workers. The session's own limit holds again afterwards."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


@contextmanager
def tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that `computed_once` writes inside; use their readers inside too."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
