"""Content digests of stored runs, and a manifest that names the current run.

A digest is a multiset fingerprint: the number of rows, the sum modulo 2^64 and the xor
of a 64-bit hash of every row. Sums and xors merge in any order, so tasks compute them
in one aggregate, the same rows give the same digest whatever their order, partitions
or file layout, and a changed, lost or added row changes it.

A run is visible to readers only through the manifest: an append-only table with one
row per run that was written and found intact on read-back. The row is appended last,
as one committed file, so a reader during a refresh finds the previous run, and a run
that failed its check is never named.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = (1 << 64) - 1
MANIFEST = "manifest"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("digest", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])
# Timestamps keep their microseconds in JSON, so they are read back the same.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class Digest(NamedTuple):
    rows: int
    total: int
    xor: int

    def __str__(self) -> str:
        return f"{self.rows}:{self.total:016x}:{self.xor:016x}"

    @classmethod
    def parse(cls, text: str) -> Digest:
        rows, total, xor = text.split(":")
        return cls(int(rows), int(total, 16), int(xor, 16))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns in order; null flags tell which ones were null, since
    the hash itself passes over nulls."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def digest_columns(df: DataFrame) -> list[Column]:
    h = row_hash(df)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("total"),
        F.coalesce(F.bit_xor(h), F.lit(0).cast("long")).alias("xor"),
    ]


def as_digest(values: Row | dict) -> Digest:
    return Digest(int(values["rows"]), int(values["total"]) & MASK, int(values["xor"]) & MASK)


def digest_of(df: DataFrame) -> Digest:
    """The digest of `df`, from one aggregate."""
    return as_digest(df.agg(*digest_columns(df)).first())


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df` with its digest gathered while it is written."""
    seen = Observation()
    return df.observe(seen, *digest_columns(df)), seen


def verified(path: str, written: Digest, stored: DataFrame, columns: list[str]) -> Digest:
    """`written`, if the stored rows, in the order of `columns` (partition columns come
    back last), have the same digest; an error otherwise."""
    found = digest_of(stored.select(*[F.col(f"`{c}`") for c in columns])) if written.rows else Digest(0, 0, 0)
    if found != written:
        raise RuntimeError(f"{path}: wrote {written}, found {found}")
    return written


def store_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> Digest:
    """Rows to a new folder; their digest, checked against the files read back."""
    watched, seen = observed(df)
    watched.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return verified(path, as_digest(seen.get), df.sparkSession.read.schema(df.schema).parquet(path), df.columns)


def store_json(df: DataFrame, path: str) -> Digest:
    """JSON lines to a new folder; their digest, checked against the files read back."""
    watched, seen = observed(df)
    watched.write.mode("errorifexists").option("ignoreNullFields", False).option("timestampFormat", TIMESTAMP_FORMAT).json(path)
    stored = df.sparkSession.read.schema(df.schema).option("timestampFormat", TIMESTAMP_FORMAT).json(path)
    return verified(path, as_digest(seen.get), stored, df.columns)


def run_path(root: str, run: str) -> str:
    return f"{root}/run={run}"


def publish(spark: SparkSession, root: str, run: str, digest: Digest, written_at: dt.datetime | None = None) -> None:
    """Names a stored, checked run current: one row appended to the manifest, last."""
    at = written_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(run, run_path(root, run), digest.rows, str(digest), at)], MANIFEST_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All published runs; none if nothing was published yet."""
    path = f"{root}/{MANIFEST}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(conf).exists(place):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def current(spark: SparkSession, root: str) -> Row | None:
    """The manifest row of the newest published run (later time, then larger run name)."""
    newest = manifest(spark, root).agg(F.max(F.struct("written_at", "run", "path", "rows", "digest")).alias("m")).first()["m"]
    return newest


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the current run; an error when no run was published."""
    found = current(spark, root)
    if found is None:
        raise FileNotFoundError(f"{root}: no published run")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(found["path"])


def changed_since(spark: SparkSession, root: str, seen: str | None) -> bool:
    """True when the current run's digest is not `seen` (the digest a reader last used)."""
    found = current(spark, root)
    return (found["digest"] if found is not None else None) != seen
