"""Contract table and dimensions mapped from an order / line-item star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions.cleaning import translate_status
from creditmill.operators.dims import broadcast_if_small
from creditmill.operators.enrich import enrich_contracts
from creditmill.operators.keys import first_per_key

AS_OF = dt.date(2001, 7, 17)
# Together with the contract id these leave no two rows alike.
DEDUPE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


# Schemas of the tables, given so that no read has to look for them.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def contracts(
    spark: SparkSession, folder: str, table_names: bool = False, unique: bool = False
) -> DataFrame:
    """One contract row per line item, ids repeated on purpose.

    With `unique`, only the first row of an id stays. It is picked among the line
    items, before the join and on their own narrow columns: less is shuffled, and no
    order is left with more rows than it has line numbers.
    """
    line = table(spark, folder, "lineitem").withColumn(
        "_id", F.col("l_orderkey") * 10 + F.col("l_linenumber")
    )
    if unique:
        line = first_per_key(line, "_id", DEDUPE_ORDER)
    order = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    joined = line.join(order, line.l_orderkey == order.o_orderkey)
    if table_names:
        part = table(spark, folder, "part").select(F.col("p_partkey").alias("_named"), "p_name")
        joined = joined.join(broadcast_if_small(part), joined.l_partkey == part["_named"], "left")
    else:
        joined = joined.withColumn("p_name", F.lit(None).cast("string"))
    flag = F.col("l_returnflag")
    code = (
        F.when(flag == "R", "CANCELED")
        .when(F.col("o_orderstatus").isin("F", "O"), "DISBURSED")
        .when(F.col("l_linenumber") == 1, "FOO_STATUS")
        .when(flag == "A", "AWAITING_SIGNATURE")
        .otherwise("RISK_ANALYSIS")
    )
    dated = (code == "DISBURSED") & (F.col("l_partkey") % 50 != 0)
    gross = F.when(F.col("l_quantity") != 13, F.col("l_extendedprice").cast(s.MONEY))
    kept = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    return joined.select(
        F.col("_id").cast("string").alias(s.CCB),
        F.when(dated, F.col("l_shipdate")).alias(s.DISBURSED_ON),
        F.col("o_orderdate").alias(s.TYPED_ON),
        translate_status(code).alias(s.STATUS),
        F.col("l_partkey").cast("string").alias(s.TABLE_ID),
        F.col("p_name").alias(s.TABLE_NAME),
        gross.alias(s.GROSS),
        F.round(gross * kept, 2).cast(s.MONEY).alias(s.NET),
        F.col("l_suppkey").alias(s.BROKER_CODE),
        F.lit(None).cast("string").alias(s.FUND_RAW),
        *DEDUPE_ORDER,
    )


def product_tables(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .where(F.col("p_partkey") % 40 != 0)
        .select(
            F.col("p_partkey").cast("string").alias(s.PRODUCT_KEY),
            F.when(F.col("p_size") % 10 != 0, F.col("p_brand")).alias(s.FUND),
            F.col("p_type").alias(s.PRODUCT),
            F.col("p_name").alias(s.BANK),
        )
    )


def brokers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "supplier")
        .where(F.col("s_suppkey") % 7 != 0)
        .select(F.col("s_suppkey").alias(s.BROKER_KEY), F.col("s_name").alias(s.BROKER))
    )


def hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").where(F.col("s_suppkey") % 7 != 0)
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    superintendent = F.when(F.col("r_name") == "ASIA", F.col("r_name")).otherwise(
        F.concat_ws(" - ", F.col("r_regionkey").cast("string"), F.col("r_name"))
    )
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias(s.HIERARCHY_KEY),
            F.col("s_name").alias(s.PARTNER),
            F.concat_ws("-", "n_name", (F.col("s_suppkey") % 3).cast("string")).alias(s.COMMERCIAL),
            F.col("n_name").alias(s.REGIONAL),
            superintendent.alias(s.SUPERINTENDENT),
        )
    )


def enriched(
    spark: SparkSession,
    folder: str,
    *,
    products: bool = False,
    sales: bool = False,
    table_names: bool = False,
) -> DataFrame:
    """Enriched contracts with the attributes asked for."""
    return enrich_contracts(
        contracts(spark, folder, table_names, unique=True).drop(*DEDUPE_ORDER),
        product_tables(spark, folder) if products else None,
        brokers(spark, folder) if sales else None,
        hierarchy(spark, folder) if sales else None,
        order=None,
    )
