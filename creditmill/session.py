"""Session settings the library is written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Shuffled bytes one task should take in.
TASK_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, task_bytes: int = TASK_BYTES) -> str:
    """Partition number to start a shuffle of that size with; adaptive execution only
    merges partitions afterwards, so it should not be too low."""
    return str(max(200, -(-shuffled_bytes // task_bytes)))


@contextmanager
def sized_shuffles(spark: SparkSession, shuffled_bytes: int | None) -> Iterator[None]:
    """Shuffles inside start with the partition number for that size; None leaves it."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if shuffled_bytes is not None:
        spark.conf.set(name, shuffle_partitions(shuffled_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
