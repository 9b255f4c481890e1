"""Event-time window totals from a stream, with a watermark, and no late row lost.

Spark keeps the windows in its state store: `withWatermark` + `F.window`, update mode, so
each batch writes the windows it changed with their totals so far, and a window's state
is dropped once the watermark passes its end. Rows that come after that are dropped by
Spark. A second stream over the same source, cut into the same batches (one file per
batch), follows the same watermark (the largest event time of earlier batches less the
delay) and writes those late rows' totals by window to a side table, under its batch
number. A reader takes each window's newest total and adds the late ones, so every row
counts once whatever its lateness.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.functions import measures as ms
from creditmill.schema import MONEY

# Tumbling windows of one day; rows may come an hour behind the newest before they are late.
SIZE = "1 day"
DELAY = "1 hour"
DELAY_SECONDS = 3600

WINDOWS = "inicio timestamp, fim timestamp, C bigint, soma decimal(38,6), lote bigint"
LATE = WINDOWS
MARKS = "maior timestamp, lote bigint"


def event_time(events: DataFrame, ts: str) -> DataFrame:
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def window_sums(rows: DataFrame, ts: str, value: str, size: str = SIZE) -> DataFrame:
    """inicio, fim, C, soma per window of `rows`."""
    grouped = rows.groupBy(F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("C"), F.sum(F.col(value).cast(MONEY)).cast("decimal(38,6)").alias("soma"))
    return grouped.select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), "C", "soma")


def write_windows(path: str) -> Callable[[DataFrame, int], None]:
    """Windows a batch changed, with their totals so far, under the batch's number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), "C", "soma").write.mode(
            "overwrite").parquet(f"{path}/lote={number}")

    return write


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_late(path: str, ts: str, value: str, size: str = SIZE, delay_seconds: int = DELAY_SECONDS) -> Callable[[DataFrame, int], None]:
    """Rows of a batch whose window ended at or before the watermark of the batches
    before it: Spark's stream drops them; here their totals are kept by window."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = read_or_empty(spark, f"{path}/marks", MARKS).where(F.col("lote") < number)
        newest = marks.agg(F.max("maior").alias("m")).first()["m"]
        timed = batch.select(F.col(ts), F.col(value)).cache()
        try:
            biggest = timed.agg(F.max(ts).alias("m")).first()["m"]
            spark.createDataFrame([(biggest, number)], MARKS).write.mode("overwrite").parquet(f"{path}/marks/lote={number}")
            if newest is None:
                late = timed.limit(0)
            else:
                mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay_seconds} SECONDS")
                late = timed.where(F.window(ts, size).end <= mark)
            window_sums(late, ts, value, size).write.mode("overwrite").parquet(f"{path}/late/lote={number}")
        finally:
            timed.unpersist()

    return write


def run_window_totals(source: Callable[[], DataFrame], ts: str, value: str, output: str, checkpoint: str,
                      size: str = SIZE, delay: str = DELAY, delay_seconds: int = DELAY_SECONDS) -> None:
    """Takes in what has arrived since the last run, then stops. `source` gives the
    stream; it must cut batches the same way each time it is called (one file each)."""
    timed = event_time(source(), ts)
    windows = timed.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("C"), F.sum(F.col(value).cast(MONEY)).cast("decimal(38,6)").alias("soma"))
    on_time = (windows.writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/windows")
               .foreachBatch(write_windows(f"{output}/windows")).trigger(availableNow=True).start())
    on_time.awaitTermination()
    late = (event_time(source(), ts).writeStream.option("checkpointLocation", f"{checkpoint}/late")
            .foreachBatch(write_late(output, ts, value, size, delay_seconds)).trigger(availableNow=True).start())
    late.awaitTermination()


def read_window_totals(spark: SparkSession, output: str) -> DataFrame:
    """inicio, fim, C, B (amount rounded as all totals), atrasadas (rows that came late),
    one row per window: its newest total from the stream plus all late rows."""
    stream = read_or_empty(spark, f"{output}/windows", WINDOWS)
    newest = stream.groupBy("inicio", "fim").agg(F.max_by(F.struct("C", "soma"), "lote").alias("n")).select(
        "inicio", "fim", F.col("n.C").alias("C"), F.col("n.soma").alias("soma"), F.lit(0).cast("long").alias("atrasadas"))
    late = read_or_empty(spark, f"{output}/late", LATE).select(
        "inicio", "fim", "C", "soma", F.col("C").alias("atrasadas"))
    both = newest.unionByName(late)
    return both.groupBy("inicio", "fim").agg(
        F.sum("C").alias("C"), ms.total(F.col("soma")).alias("B"), F.sum("atrasadas").alias("atrasadas"))


def batch_window_totals(events: DataFrame, ts: str, value: str, size: str = SIZE) -> DataFrame:
    """The same totals over a whole table at once."""
    sums = window_sums(event_time(events, ts), ts, value, size)
    return sums.groupBy("inicio", "fim").agg(F.sum("C").alias("C"), ms.total(F.col("soma")).alias("B"))
