"""Sinks: run folders checked by digest on read-back, JSON records, keyed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions.calendar import month_label
from creditmill.operators.keys import first_per_key
from creditmill.sources import runs

# Columns of the snapshot table.
SNAPSHOT = T.StructType(
    [
        T.StructField("html", T.StringType()),
        T.StructField("atualizado_em", T.TimestampType()),
        T.StructField("escopo", T.StringType()),
    ]
)


def write_run(df: DataFrame, root: str, run: str, partition_by: tuple[str, ...] = ()) -> int:
    """Full refresh into a folder of its own, so no reader sees half a table and the
    table being read is never overwritten. Returns the rows; their content digest,
    taken while writing, must equal the digest of what is read back. A run that exists
    is an error.

    A partitioned run is rebalanced first: each partition value gets few files, and one
    that holds most rows (contracts without a month) is still written by many tasks.
    """
    return store_run(df, root, run, partition_by).rows


def store_run(df: DataFrame, root: str, run: str, partition_by: tuple[str, ...] = ()) -> runs.Digest:
    """As `write_run`; returns the digest of the run."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return runs.store_parquet(df, runs.run_path(root, run), partition_by)


def publish_run(df: DataFrame, root: str, run: str, partition_by: tuple[str, ...] = ()) -> runs.Digest:
    """Writes and checks the run, then names it current in the manifest of `root`."""
    digest = store_run(df, root, run, partition_by)
    runs.publish(df.sparkSession, root, run, digest)
    return digest


def read_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    return spark.read.parquet(f"{root}/run={run}")


def panel_rows(df: DataFrame) -> DataFrame:
    """Rows as the panel shows them: month labels, partner heading, no nulls."""
    shown = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name == s.MONTH:
            c = month_label(c)
        if isinstance(field.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        elif isinstance(field.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        shown.append(c.alias("Nome parceiro" if field.name == s.PARTNER else field.name))
    return df.select(*shown)


def json_records(df: DataFrame, name: str) -> DataFrame:
    """One JSON object per row under the name of its metric. Amounts are decimals, so
    they print in full and never in exponent form."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.lit(name).alias("metrica"), record.alias("registro"))


def write_json(df: DataFrame, path: str) -> int:
    """JSON records in a new folder. Returns the rows; their digest must equal that of
    the records read back."""
    return runs.store_json(df, path).rows


def merge_snapshots(stored: DataFrame, changes: DataFrame, key: str, changed_at: str) -> DataFrame:
    """Newest row of every key; on equal times the rows decide by their other columns."""
    both = stored.unionByName(changes, allowMissingColumns=True)
    rest = [F.desc(c) for c in both.columns if c not in (key, changed_at)]
    return first_per_key(both, key, [F.desc(changed_at), *rest])


def add_snapshots(changes: DataFrame, path: str) -> None:
    """Append versions of snapshots. Nothing stored is touched, so a reader finds each
    scope at all times, and an older version that comes later does not win."""
    changes.select(*SNAPSHOT.names).write.mode("append").partitionBy("escopo").parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every scope, one row each."""
    newest = spark.read.schema(SNAPSHOT).parquet(path).groupBy("escopo").agg(
        F.max(F.struct("atualizado_em", "html")).alias("_newest")
    )
    return newest.select("_newest.html", "_newest.atualizado_em", "escopo")


def read_snapshot(spark: SparkSession, path: str, scope: str) -> DataFrame:
    """The newest version of one scope; only its folder is read."""
    return read_snapshots(spark, path).where(F.col("escopo") == scope)


def snapshot_changed(spark: SparkSession, path: str, scope: str, seen) -> bool:
    """True when the stored time of the scope is not the one last seen."""
    newest = read_snapshot(spark, path, scope).first()
    return newest is not None and newest["atualizado_em"] != seen


def compact_snapshots(spark: SparkSession, path: str, target: str) -> None:
    """The newest versions alone, in a new folder that readers are then pointed to."""
    read_snapshots(spark, path).write.mode("errorifexists").partitionBy("escopo").parquet(target)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> runs.Digest:
    """A run as a table of the warehouse, hashed into `buckets` by `key` and sorted by it
    in each bucket. Later reads that group, rank or join by `key` (the dedupe of a
    refresh, joins on the contract id) find the rows already placed and need no
    exchange. Returns the digest of the rows, checked on the table read back; a table
    that exists is an error."""
    watched, seen = runs.observed(df)
    watched.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return runs.verified(table, runs.as_digest(seen.get), df.sparkSession.table(table), df.columns)
