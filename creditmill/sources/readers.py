"""Readers for the contract table and its reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditmill.operators.align import clean_headers


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet, or CSV with a header when the path says so."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True).option("encoding", "UTF-8")
        return clean_headers((reader.schema(schema) if schema else reader).csv(path))
    reader = spark.read.schema(schema) if schema else spark.read
    return clean_headers(reader.parquet(path))


def read_first_existing(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """The first of `paths` that exists, in order of preference."""
    for path in paths:
        try:
            return read_table(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 200,
    zero_dates: bool = True,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a full table scan, split into key ranges.

    `bounds` only place the cuts: rows outside them go to the outer ranges. With
    `zero_dates`, a MySQL server hands ``0000-00-00`` over as null.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    if zero_dates and url.startswith("jdbc:mysql:"):
        options["zeroDateTimeBehavior"] = "CONVERT_TO_NULL"
    return options | (properties or {})


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """All rows of a database table; Spark finds the schema and prunes the columns."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """Discovered columns with their types."""
    return df.dtypes
