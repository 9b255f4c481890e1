import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmill.streaming import windows

SCHEMA = "event_id bigint, ts timestamp_ntz, value double"


def at(day, hour=12, year=2024):
    return dt.datetime(year, 1, day, hour)


def totals(df):
    return sorted((r.inicio, r.C, float(r.B)) for r in df.collect())


def feed(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_late_rows_are_kept_beside_the_watermark(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")

    first = [(1, at(1), 1.5), (2, at(2), 2.0), (3, at(5), 3.25)]
    second = [(4, at(5, 18), 1.0), (5, at(3), 7.0), (6, at(9, 1, 2023), 0.5), (7, at(6), 2.0)]
    third = [(8, at(1, 13), 4.0), (9, at(7), 1.0)]
    feed(spark, source, first, "a")
    windows.run_window_totals(stream, "ts", "value", out, state)
    feed(spark, source, second, "b")
    feed(spark, source, third, "c")
    windows.run_window_totals(stream, "ts", "value", out, state)
    everything = spark.createDataFrame(first + second + third, SCHEMA)
    found = windows.read_window_totals(spark, out)
    assert totals(found) == totals(windows.batch_window_totals(everything, "ts", "value"))
    late = {r.inicio.date(): r.atrasadas for r in found.collect() if r.atrasadas}
    # Behind the watermark of day 5, 11:00: days 3, 2023-01-09 and, after day 6, day 1.
    assert late == {dt.date(2024, 1, 3): 1, dt.date(2023, 1, 9): 1, dt.date(2024, 1, 1): 1}
    stream_only = windows.read_or_empty(spark, f"{out}/windows", windows.WINDOWS)
    assert stream_only.where(F.col("inicio") == F.lit("2023-01-09").cast("timestamp")).count() == 0


def test_nothing_yet_is_an_empty_table(spark, tmp_path):
    assert windows.read_window_totals(spark, str(tmp_path)).count() == 0
