import datetime as dt

from pyspark.sql import types as T

from creditmill.streaming import snapshots

SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
ORDER = ["ts", "event_id", "event_type", "value"]


def at(day):
    return dt.datetime(2024, 1, day, 12)


def test_latest_per_key_over_batches(spark, tmp_path):
    source, table, state = f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/state"

    def feed(rows, name):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{name}")

    def run():
        updates = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
        snapshots.run_latest(updates, "user_id", ORDER, table, state)

    assert snapshots.read_latest(spark, table, SCHEMA, "user_id", ORDER).count() == 0
    feed([(1, at(5), 10, "a", 1.0), (2, at(3), 11, "b", 2.0), (None, at(1), 12, "c", None)]
         + [(3, at(2), 100 + i, "x", float(i)) for i in range(500)], "a")
    run()
    # An older row for 1 comes later and does not win; 2 gets a newer row; equal times go by event_id.
    feed([(1, at(4), 13, "d", 5.0), (2, at(6), 14, "e", 3.0), (None, at(1), 15, "f", 1.0)], "b")
    run()
    found = {r.user_id: (r.ts.day, r.event_id) for r in snapshots.read_latest(spark, table, SCHEMA, "user_id", ORDER).collect()}
    assert found == {1: (5, 10), 2: (6, 14), None: (1, 15), 3: (2, 599)}
    second = spark.read.parquet(f"{table}/lote=1")
    assert sorted((r.user_id or 0) for r in second.collect()) == [0, 1, 2]
