"""What the plans must and must not hold, and that results do not hang on layout."""

import pytest

from pyspark.sql import functions as F

from check import canonical
from creditmill.operators.enrich import attach_sales
from creditmill.queries import QUERIES
from fixtures import enriched
from creditmill import schema as s
from creditmill.sources import sinks, star
from creditmill.plans import funnel, hierarchy, production, tables

SF = "/root/testdata/sf0.001"
PLAIN = sorted(set(QUERIES) - {"stream_daily_totals"})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                      "MapInPandas", "FlatMapGroups"):
        assert forbidden not in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["status_mix"](spark, SF))
    assert "p_name" not in text and "s_name" not in text and "l_tax" not in text
    assert "o_orderdate" not in text


def test_dimensions_nobody_reads_are_not_joined(spark):
    df = star.enriched(spark, SF, products=True, sales=True)
    text = plan(production.monthly_production(df))
    assert "part.parquet" not in text and "supplier.parquet" not in text


def test_large_dimensions_nobody_reads_are_not_joined_either(spark):
    assert "Join" not in plan(production.monthly_production(enriched(spark, limit=0)))
    assert "Join" in plan(production.product_month(enriched(spark, limit=0)))


def test_large_tables_meet_by_sort_merge_with_one_row_per_id(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["monthly_production"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("SortMergeJoin") < text.index("WindowGroupLimit")
    assert "row_number(), 1, Partial" in text


def test_a_broker_with_most_contracts_is_split_when_its_table_is_large(spark):
    codes = F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id"))
    contracts = spark.range(0, 60_000, numPartitions=16).select(
        F.col("id").alias("CCB"), codes.cast("bigint").alias("codigo_nova"), F.md5(F.col("id").cast("string")).alias("x")
    )
    names = spark.range(60_000).select(
        F.col("id").alias("Código Corretor"), F.concat(F.lit("Nome "), "id").alias("Nome Corretor")
    )
    levels = spark.range(60_000).select(
        F.col("id").alias("Cod Parceiro"), F.concat(F.lit("Super "), "id").alias("Superintendente")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = attach_sales(contracts, names, levels, limit=0)
        rows = joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 60_000
    assert all(r["Superintendente"] == f"Super {r['codigo_nova']}" for r in rows)


@pytest.mark.parametrize("name", ["dense_month_product", "partner_month"])
def test_shared_cells_start_no_job_and_are_computed_once(spark, name):
    df = star.enriched(spark, SF, products=True, sales=True)
    metric = {"dense_month_product": funnel.dense_month_product, "partner_month": hierarchy.partner_month}[name]
    group = f"planning {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = metric(df)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final or "Reused" in final


def test_table_mix_reads_one_month_folder_for_the_disbursed(spark, tmp_path):
    df = star.enriched(spark, SF, products=True, table_names=True)
    sinks.write_run(df, str(tmp_path), "1", (s.MONTH,))
    mix = tables.table_cells(sinks.read_run(spark, str(tmp_path), "1"), star.AS_OF, stored=True)
    text = mix._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2
    assert "PartitionFilters: [isnotnull(Mes" in text and f"= {star.AS_OF:%Y-%m})" in text
    derived = tables.table_cells(df, star.AS_OF)
    assert sorted(map(repr, derived.collect())) == sorted(map(repr, mix.collect()))


def test_table_mix_over_a_derived_plan_reads_the_contracts_once(spark):
    df = star.enriched(spark, SF, products=True, table_names=True)
    one = tables.table_cells(df, star.AS_OF)
    text = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in text
    both = tables.table_cells(df, star.AS_OF, stored=True)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, both.collect()))


@pytest.mark.parametrize(
    "name", ["monthly_production", "level_rankings_product", "partner_month", "table_mix_month",
             "product_kpis", "dedupe_contracts", "latest_snapshot", "spread_by_fund"],
)
def test_results_do_not_depend_on_partitions_or_row_order(spark, tmp_path, name):
    wanted = canonical(QUERIES[name](spark, SF).toPandas())
    for table in "region nation supplier part orders lineitem events".split():
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        df.repartition(5, *df.columns[:1]).sortWithinPartitions(df.columns[-1]).write.parquet(
            f"{tmp_path}/{table}.parquet"
        )
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert canonical(QUERIES[name](spark, str(tmp_path)).toPandas()) == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
