from types import SimpleNamespace

import pytest

from creditmill.operators.materialize import checkpoint_root, computed_once, tables_dropped
from creditmill.session import shuffle_partitions, sized_shuffles


def test_shuffle_partitions():
    assert shuffle_partitions(0) == "200"
    assert shuffle_partitions(20 * 10**12) == "149012"
    assert shuffle_partitions(1000, 2) == "500"


def test_shared_results_go_to_the_named_folder(spark):
    df = computed_once(spark.range(5).selectExpr("id AS `Valor Bruto`", "id * 2 AS b"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or checkpoint_root(spark) == named.rstrip("/")
    assert all(checkpoint_root(spark) in f for f in df.inputFiles())
    assert df.columns == ["Valor Bruto", "b"] and df.count() == 5


def test_a_cluster_without_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(session)


def test_owned_tables_are_dropped(spark):
    with tables_dropped(spark):
        df = computed_once(spark.range(3).toDF("a"))
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_shuffles_are_sized_inside_only(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with sized_shuffles(spark, 40 * 2**30):
        assert spark.conf.get(name) == "320"
    with sized_shuffles(spark, None):
        assert spark.conf.get(name) == before
    assert spark.conf.get(name) == before
