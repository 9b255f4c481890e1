"""Daily totals kept up to date from a stream of dated amounts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.functions import measures as ms
from creditmill.schema import MONEY

# The share of one batch in the totals of a day.
PARTIAL = "dia date, C bigint, soma decimal(38,6), lote bigint"


def partial_totals(events: DataFrame, ts: str, value: str) -> DataFrame:
    """Rows and unrounded amount per day of the wall clock."""
    dated = events.select(F.to_date(ts).alias("dia"), F.col(value).cast(MONEY).alias("value"))
    return dated.groupBy("dia").agg(F.count(F.lit(1)).alias("C"), F.sum("value").cast("decimal(38,6)").alias("soma"))


def merged_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("dia").agg(F.sum("C").alias("C"), ms.total(F.col("soma")).alias("B"))


def daily_totals(events: DataFrame, ts: str, value: str) -> DataFrame:
    """Rows and amount per day of a whole table."""
    return merged_totals(partial_totals(events, ts, value))


def add_batch(path: str, ts: str, value: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that stores a batch's share of its days under the batch's number; a
    repeated batch replaces its own share and is harmless."""

    def write(batch: DataFrame, number: int) -> None:
        partial_totals(batch, ts, value).write.mode("overwrite").parquet(f"{path}/lote={number}")

    return write


def run_daily_totals(events: DataFrame, ts: str, value: str, output: str, checkpoint: str) -> None:
    """Take in what has arrived since the last run, then stop. There is no watermark: a row
    counts however late it comes."""
    query = (
        events.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(add_batch(output, ts, value))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_daily_totals(spark: SparkSession, output: str) -> DataFrame:
    """Totals of all batches; none yet is an empty table."""
    try:
        parts = spark.read.schema(PARTIAL).parquet(output)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        parts = spark.createDataFrame([], PARTIAL)
    return merged_totals(parts)
