import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions.cleaning import INTERNAL_LABEL
from creditmill.operators import align
from creditmill.operators.dims import broadcast_if_small, measured_bytes
from creditmill.operators.enrich import enrich_contracts
from creditmill.operators.keys import first_per_key, top_rows, top_rows_per_group
from fixtures import CONTRACTS, SCHEMA, contract, dims, enriched, rows_of


def by_ccb(df, *columns):
    return {r[s.CCB]: tuple(r[c] for c in columns) for r in df.collect()}


def test_product_keys_ignore_case_blanks_and_float_suffix(spark):
    found = by_ccb(enriched(spark), s.PRODUCT, s.FUND)
    assert found["a"] == found["b"] == ("FGTS", "F1")
    assert found["c"] == ("CLT", "F2")
    assert found["i"] == ("OUTRO", None)
    assert found["j"] == (None, None)


def test_orphans_get_the_internal_label_everywhere(spark):
    columns = (s.BROKER, *s.LEVELS)
    found = by_ccb(enriched(spark), *columns)
    assert found["e"] == (INTERNAL_LABEL,) * 5
    assert found["a"] == ("Corretor 1", "10 - Super - X", "Norte Um", "Com Um", "Parceiro A")


@pytest.mark.parametrize("match, wanted", [(False, INTERNAL_LABEL), (True, "Parceiro N")])
def test_null_broker_codes(spark, match, wanted):
    rows = [contract("n", None, None, "X", "t1", "1.00", broker=None)]
    assert by_ccb(enriched(spark, rows, null_keys_match=match), s.PARTNER)["n"] == (wanted,)


def test_first_row_per_contract_and_one_for_all_without_id(spark):
    rows = [
        contract("a", "2026-01-02", None, "X", "t1", "2.00"),
        contract("a", "2026-01-01", None, "X", "t1", "1.00"),
        contract(None, "2026-01-02", None, "X", "t1", "4.00"),
        contract(None, "2026-01-01", None, "X", "t1", "3.00"),
    ]
    assert {k: float(v[0]) for k, v in by_ccb(enriched(spark, rows), s.GROSS).items()} == {
        "a": 1.0, None: 3.0,
    }


def test_dimensions_with_repeated_keys_do_not_multiply_contracts(spark):
    many = {name: df.union(df) for name, df in dims(spark).items()}
    df = enrich_contracts(
        spark.createDataFrame(CONTRACTS, SCHEMA), **many, order=[s.DISBURSED_ON, s.GROSS]
    )
    assert sorted(rows_of(df), key=str) == sorted(rows_of(enriched(spark)), key=str)


def test_dimensions_beyond_the_limit_give_the_same_rows(spark):
    large = enriched(spark, limit=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
        found = rows_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(found, key=str) == sorted(rows_of(enriched(spark)), key=str)


def test_size_is_measured_before_a_broadcast(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "t string, n bigint")
    assert measured_bytes(df) == 2 * 16 + 4
    assert measured_bytes(df.where("n > 5")) == 0
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString()


def test_months_and_category(spark):
    found = by_ccb(enriched(spark), s.MONTH, s.COHORT, s.CATEGORY)
    assert found["b"] == ("2026-01", "2026-02", "Desembolsado")
    assert found["i"] == (None, None, "Em Averbacao")


def test_top_rows_break_ties_by_name(spark):
    df = spark.createDataFrame([("g", n, 5) for n in "zxy"] + [("h", "w", 1)], "g string, n string, B int")
    assert [r.n for r in top_rows(df, 2, "B", "n").collect()] == ["x", "y"]
    kept = top_rows_per_group(df, ["g"], {"g": 2, "h": 1}, "B", "n")
    assert sorted((r.g, r.n) for r in kept.collect()) == [("g", "x"), ("g", "y"), ("h", "w")]


def test_a_key_with_most_rows_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    first = first_per_key(df, "k", ["v"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert first.where("k = 0").collect()[0].v == 0
    assert first.count() == 2001


# --- schema -----------------------------------------------------------------


def test_resolve_renames_translates_parses_and_carries_extras(spark):
    raw = spark.createDataFrame(
        [("1", None, "2026-01-05", "disbursed", "10,5", "x", "7", "3"),
         ("2", "31/12/2025", "2026-01-05", None, " 10.5 ", None, "nan", None)],
        "`﻿ccb_numero` string, data_digitado string, created_at string, status_proposta string, "
        "valor_bruto string, fundo string, codigo_nova string, Produto string",
    )
    df = align.resolve_contracts(raw)
    assert df.columns == [*s.CONTRACT.names, "Produto_original"]
    assert [f.dataType for f in df.schema.fields[:8]] == [f.dataType for f in s.CONTRACT.fields[:8]]
    a, b = df.orderBy(s.CCB).collect()
    assert (a[s.TYPED_ON], b[s.TYPED_ON]) == (dt.datetime(2026, 1, 5), dt.datetime(2025, 12, 31))
    assert (a[s.STATUS], b[s.STATUS]) == ("Desembolsado", None)
    assert (a[s.GROSS], float(b[s.GROSS])) == (None, 10.5)
    assert (a[s.FUND_RAW], b[s.FUND_RAW]) == ("x", None)
    assert (a[s.BROKER_CODE], b[s.BROKER_CODE]) == (7.0, None)
    assert a["Produto_original"] == "3"


def test_resolve_keeps_a_canonical_column_over_its_aliases(spark):
    raw = spark.createDataFrame([("a", "b")], "CCB string, ccb_numero string")
    df = align.resolve_contracts(raw)
    assert (df.first()[s.CCB], df.columns[-1]) == ("a", "ccb_numero")


def test_align_orders_columns_and_adds_missing_ones(spark):
    df = spark.createDataFrame([(1, 2)], "extra int, a int")
    reference = T.StructType.fromDDL("z string, a int")
    aligned = align.align_to(df, reference)
    assert aligned.columns == ["z", "a", "extra"]
    assert tuple(aligned.first()) == (None, 2, 1)


def test_regional_column():
    assert align.regional_column(["Cod Regional", "Nome Regional", "Região"]) == "Nome Regional"
    assert align.regional_column(["a"]) == "Regional"
