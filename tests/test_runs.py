import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from creditmill import schema as s
from creditmill.sources import runs, sinks
from fixtures import enriched


def sample(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5, None), (2, None, None, None), (None, "a", 2.25, None), (3, "b", 0.0, None), (3, "b", 0.0, None)],
        "k int, name string, amount double, at timestamp",
    ).select("k", "name", F.col("amount").cast("decimal(28,6)").alias("amount"),
             F.when(F.col("k") == 1, F.lit("2026-03-10 12:34:56.789012").cast("timestamp")).alias("at"))


def test_digest_ignores_order_and_layout(spark, tmp_path):
    df = sample(spark)
    digest = runs.digest_of(df)
    assert digest.rows == 5
    assert runs.digest_of(df.repartition(3)) == digest
    assert runs.digest_of(df.orderBy(F.desc("k"))) == digest
    assert runs.store_parquet(df, f"{tmp_path}/flat") == digest
    assert runs.store_parquet(df, f"{tmp_path}/by_name", ("name",)) == digest
    assert runs.store_json(df, f"{tmp_path}/json") == digest
    assert runs.Digest.parse(str(digest)) == digest


def test_digest_sees_each_change(spark):
    a = spark.createDataFrame([("x", None), (None, "x")], "p string, q string")
    b = spark.createDataFrame([("x", None), ("x", None)], "p string, q string")
    c = spark.createDataFrame([("x", None)], "p string, q string")
    digests = {runs.digest_of(a), runs.digest_of(b), runs.digest_of(c), runs.digest_of(c.limit(0))}
    assert len(digests) == 4
    assert runs.digest_of(c.limit(0)) == runs.Digest(0, 0, 0)


def without_checksum(name):
    """A store without checksum files: the local one keeps a sidecar that would refuse
    the changed file before any digest is taken."""
    sidecar = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
    if os.path.exists(sidecar):
        os.remove(sidecar)


def flip_one_value(path):
    """Rewrites one stored file with one value of its first integer column changed."""
    name = next(f for f in sorted(glob.glob(f"{path}/**/*.parquet", recursive=True)) if pq.read_metadata(f).num_rows)
    without_checksum(name)
    table = pq.read_table(name)
    column = next(i for i, f in enumerate(table.schema) if str(f.type).startswith("int"))
    values = table.column(column).to_pylist()
    values[0] = (values[0] or 0) + 1
    pq.write_table(table.set_column(column, table.schema[column], pa.array(values, table.schema[column].type)), name)


@pytest.mark.parametrize("partition_by", [(), (s.MONTH,)])
def test_write_run_raises_on_a_changed_file(spark, tmp_path, monkeypatch, partition_by):
    original = DataFrameWriter.parquet

    def tampered(self, path, *args, **kwargs):
        original(self, path, *args, **kwargs)
        flip_one_value(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", tampered)
    df = enriched(spark).select(F.lit(7).alias("n"), *enriched(spark).columns)
    with pytest.raises(RuntimeError, match="wrote"):
        sinks.write_run(df, str(tmp_path), "1", partition_by)


def test_write_json_raises_on_a_changed_file(spark, tmp_path, monkeypatch):
    original = DataFrameWriter.json

    def tampered(self, path, *args, **kwargs):
        original(self, path, *args, **kwargs)
        name = sorted(glob.glob(f"{path}/*.json"))[-1]
        without_checksum(name)
        text = open(name).read()
        open(name, "w").write(text.replace('"k":3', '"k":4', 1))

    monkeypatch.setattr(DataFrameWriter, "json", tampered)
    with pytest.raises(RuntimeError, match="wrote"):
        sinks.write_json(sample(spark).coalesce(1), f"{tmp_path}/j")


def test_readers_see_the_published_run_only(spark, tmp_path):
    root = str(tmp_path)
    assert runs.current(spark, root) is None
    assert runs.changed_since(spark, root, None) is False
    with pytest.raises(FileNotFoundError):
        runs.read_current(spark, root)
    df = sample(spark)
    first = sinks.publish_run(df, root, "1")
    assert runs.read_current(spark, root).count() == 5
    # A refresh in progress: stored and checked, not yet published.
    second = sinks.store_run(df.where("k = 3"), root, "2")
    assert runs.current(spark, root)["run"] == "1"
    assert runs.read_current(spark, root).count() == 5
    assert not runs.changed_since(spark, root, str(first))
    runs.publish(spark, root, "2", second)
    assert runs.current(spark, root)["run"] == "2"
    assert runs.read_current(spark, root).count() == 2
    assert runs.changed_since(spark, root, str(first))
    assert runs.digest_of(runs.read_current(spark, root).select(*df.columns)) == second


def test_a_run_that_fails_its_check_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    df = sample(spark).drop("at")
    sinks.publish_run(df, root, "1")
    original = DataFrameWriter.parquet

    def tampered(self, path, *args, **kwargs):
        original(self, path, *args, **kwargs)
        if "run=2" in path:
            flip_one_value(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", tampered)
    with pytest.raises(RuntimeError):
        sinks.publish_run(df, root, "2")
    assert runs.current(spark, root)["run"] == "1"
    assert runs.manifest(spark, root).count() == 1


def test_a_bucketed_run_is_read_without_an_exchange(spark):
    from creditmill.operators.keys import first_per_key

    df = enriched(spark)
    name = "bucketed_contracts_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        digest = sinks.write_bucketed(df, name, s.CCB, 4)
        stored = spark.table(name)
        assert runs.digest_of(stored.select(*df.columns)) == digest
        order = [F.desc(s.GROSS)]
        kept = first_per_key(stored, s.CCB, order)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" in plan
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, first_per_key(df, s.CCB, order).select(*stored.columns).collect()))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_source_without_known_columns_is_refused(spark, tmp_path):
    from creditmill.jobs import refresh_contracts

    raw = spark.createDataFrame([(1, "x")], "coluna_a int, coluna_b string")
    with pytest.raises(ValueError, match="no column"):
        refresh_contracts(raw, str(tmp_path), "1")
