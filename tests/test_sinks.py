import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.plans import access, production
from creditmill.plans.panel import panel_metrics, write_panel
from creditmill.sources import readers, sinks
from creditmill.streaming import daily, snapshots
from fixtures import AS_OF, enriched


def at(hour):
    return dt.datetime(2026, 3, 10, hour)


def snaps(spark, *rows):
    return spark.createDataFrame(rows, "escopo string, html string, atualizado_em timestamp")


def stored(spark, path):
    df = sinks.read_snapshots(spark, path)
    return {r.escopo: (r.html, r.atualizado_em) for r in df.collect()}


def test_a_run_is_read_back_and_leaves_other_runs_alone(spark, tmp_path):
    root = str(tmp_path)
    df = enriched(spark)
    assert sinks.write_run(df, root, "1", (s.MONTH,)) == 10
    again = sinks.read_run(spark, root, "1")
    assert sinks.write_run(again.where(F.col(s.MONTH) == "2026-03"), root, "2") == 3
    assert sinks.read_run(spark, root, "1").count() == 10
    assert production.grand_totals(again).first() == production.grand_totals(df).first()
    assert sinks.write_run(df.limit(0), root, "3") == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_run(df, root, "1")


def test_month_partitions_are_pruned(spark, tmp_path):
    sinks.write_run(enriched(spark), str(tmp_path), "1", (s.MONTH,))
    one = sinks.read_run(spark, str(tmp_path), "1").where(F.col(s.MONTH) == "2026-03")
    assert len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(Mes" in one._jdf.queryExecution().executedPlan().toString()


def test_panel_rows_have_labels_and_no_nulls(spark):
    df = spark.createDataFrame(
        [(None, "2026-01", None, 2.0), ("P", None, 1, None)],
        "Parceiro string, Mes string, C bigint, x double",
    )
    shown = sinks.panel_rows(df)
    assert shown.columns == ["Nome parceiro", "Mes", "C", "x"]
    assert [tuple(r) for r in shown.collect()] == [("", "Jan/26", 0, 2.0), ("P", "", 1, 0.0)]


def test_json_records_keep_text_amounts_and_nulls(spark):
    df = spark.sql("SELECT 'averbação' AS s, CAST(12345678.9 AS DECIMAL(18,2)) AS b, CAST(NULL AS INT) AS n")
    record = sinks.json_records(df, "m").first()
    assert (record.metrica, record.registro) == ("m", '{"s":"averbação","b":12345678.90,"n":null}')


def test_the_panel_is_written_as_json(spark, tmp_path):
    metrics = {k: v for k, v in panel_metrics(enriched(spark), AS_OF).items() if k in ("run_rate", "level_rankings")}
    write_panel(metrics, str(tmp_path))
    lines = "".join(f.read_text() for f in (tmp_path / "level_rankings").glob("part-*")).splitlines()
    records = [json.loads(line) for line in lines]
    assert {r["nivel"] for r in records} == {"Superintendente", "Regional", "Comercial", "Parceiro"}
    assert all(r["Regional"] == "" for r in records if r["nivel"] == "Regional")


def test_snapshots_are_replaced_by_scope(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.add_snapshots(snaps(spark, ("a", "1", at(1)), ("b", "1", at(1))), path)
    sinks.add_snapshots(snaps(spark, ("b", "2", at(2)), ("c", "2", at(2))), path)
    assert stored(spark, path) == {"a": ("1", at(1)), "b": ("2", at(2)), "c": ("2", at(2))}
    assert [r.html for r in sinks.read_snapshot(spark, path, "b").collect()] == ["2"]
    assert sinks.snapshot_changed(spark, path, "b", at(1))
    assert not sinks.snapshot_changed(spark, path, "b", at(2))
    assert not sinks.snapshot_changed(spark, path, "zz", at(2))
    sinks.add_snapshots(snaps(spark, ("b", "late", at(1)), ("c", "3", at(3)), ("c", "4", at(4))), path)
    newest = {"a": ("1", at(1)), "b": ("2", at(2)), "c": ("4", at(4))}
    assert stored(spark, path) == newest
    sinks.compact_snapshots(spark, path, f"{path}-2")
    assert stored(spark, f"{path}-2") == newest and spark.read.parquet(f"{path}-2").count() == 3


def test_merge_keeps_the_newest_snapshot(spark):
    merged = sinks.merge_snapshots(
        snaps(spark, ("a", "old", at(1)), ("b", "kept", at(5))),
        snaps(spark, ("a", "new", at(2)), ("b", "late", at(4)), ("c", "x", at(1)), ("c", "y", at(1))),
        "escopo", "atualizado_em",
    )
    assert {r.escopo: r.html for r in merged.collect()} == {"a": "new", "b": "kept", "c": "y"}


def test_snapshot_stream_ignores_late_updates(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))

    def run(*rows):
        snaps(spark, *rows).write.mode("append").parquet(source)
        updates = spark.readStream.schema("escopo string, html string, atualizado_em timestamp").parquet(source)
        snapshots.run_snapshots(updates, table, state)

    run(("a", "1", at(3)), ("b", "1", at(3)))
    run(("a", "late", at(1)), ("b", "2", at(4)), ("b", "3", at(5)))
    assert stored(spark, table) == {"a": ("1", at(3)), "b": ("3", at(5))}


@pytest.fixture(params=["UTC", "America/Sao_Paulo"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_daily_stream_adds_to_its_days_and_equals_the_batch(spark, tmp_path, zone):
    source, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    schema = "ts timestamp_ntz, value double"

    def run(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        daily.run_daily_totals(events, "ts", "value", table, state)

    run((dt.datetime(2026, 3, 1, 23, 59), 1.5), (dt.datetime(2026, 3, 2), 2.25))
    run((dt.datetime(2026, 3, 2, 5), 4.0), (dt.datetime(2026, 3, 1, 1), 8.0), (dt.datetime(2026, 3, 9), 1.0))
    found = {(r.dia, r.C, float(r.B)) for r in daily.read_daily_totals(spark, table).collect()}
    assert found == {
        (dt.date(2026, 3, 1), 2, 9.5), (dt.date(2026, 3, 2), 2, 6.25), (dt.date(2026, 3, 9), 1, 1.0),
    }
    run((dt.datetime(2025, 3, 1, 12), 3.0))  # a year late
    found |= {(dt.date(2025, 3, 1), 1, 3.0)}
    assert {(r.dia, r.C, float(r.B)) for r in daily.read_daily_totals(spark, table).collect()} == found
    batch = daily.daily_totals(spark.read.parquet(source), "ts", "value")
    assert {(r.dia, r.C, float(r.B)) for r in batch.collect()} == found


def test_a_stream_that_brought_nothing_is_empty(spark, tmp_path):
    assert daily.read_daily_totals(spark, f"{tmp_path}/none").count() == 0


def test_the_stream_reads_a_file_and_a_folder(spark, tmp_path, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    from creditmill.queries import QUERIES

    def rows(name, folder):
        return sorted(map(tuple, QUERIES[name](spark, folder).collect()))

    wanted = rows("batch_daily_totals", small)
    assert rows("stream_daily_totals", small) == wanted == rows("stream_daily_totals", str(tmp_path))


# --- readers ----------------------------------------------------------------


def test_readers_fall_back_and_clean_headers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿ Cod Parceiro ,b\n1,x\n", encoding="utf-8")
    df = readers.read_first_existing(spark, [f"{tmp_path}/none.parquet", f"{tmp_path}/t.csv"])
    assert df.columns == ["Cod Parceiro", "b"] and df.first().b == "x"
    assert readers.describe(df) == [("Cod Parceiro", "string"), ("b", "string")]
    with pytest.raises(FileNotFoundError):
        readers.read_first_existing(spark, [f"{tmp_path}/none.parquet"])


def test_jdbc_options():
    options = readers.jdbc_options(
        "jdbc:mysql://h/db", "contrato", partition_column="id", bounds=(1, 9), partitions=4,
        properties={"user": "u"},
    )
    assert options == {
        "url": "jdbc:mysql://h/db", "dbtable": "contrato", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
        "zeroDateTimeBehavior": "CONVERT_TO_NULL", "user": "u",
    }
    assert "zeroDateTimeBehavior" not in readers.jdbc_options("jdbc:postgresql://h/db", "t")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")


# --- access -----------------------------------------------------------------


def test_entitled(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    readers_ = spark.createDataFrame([(1,), (1,), (None,)], "r int")
    assert [r.k for r in access.entitled(df, "k", readers_, "r").collect()] == [1]


def test_roster(spark):
    profiles = spark.createDataFrame(
        [("u@x", "U", "user"), ("a@x", "A", "admin"), ("o@x", "O", "owner"), ("b@x", "B", "user")],
        "login string, nome string, role string",
    )
    accounts = spark.createDataFrame(
        [("u@x", at(12)), ("a@x", at(1)), ("o@x", None)], "email string, banned_until timestamp"
    )
    found = [tuple(r) for r in access.roster(profiles, accounts, at(6)).collect()]
    assert found == [
        ("o@x", "O", "owner", False), ("a@x", "A", "admin", False),
        ("b@x", "B", "user", False), ("u@x", "U", "user", True),
    ]
    roles = profiles.select(access.is_admin(F.col("role")), access.is_owner(F.col("role"))).collect()
    assert [tuple(r) for r in roles] == [(False, False), (True, False), (True, True), (False, False)]
