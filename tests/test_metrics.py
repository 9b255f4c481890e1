"""Metrics over the hand-made contracts; expected values added up by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions.cleaning import INTERNAL_LABEL
from creditmill.operators.cells import CUBES, cube, cubes
from creditmill.sources import star
from creditmill.plans import funnel, hierarchy, production, quality, tables
from creditmill.plans.panel import panel_metrics
from fixtures import AS_OF, CONTRACTS, C, D, contract, enriched, rows_of


@pytest.fixture(scope="module")
def df(spark):
    return enriched(spark).cache()


def rows(df, *columns):
    return sorted(rows_of(df.select(*columns) if columns else df), key=str)


def test_monthly(df):
    assert rows_of(production.monthly_production(df)) == [
        ("2026-01", 2, 300.5, 250.25, 150, 125),  # 150.25 and 125.125
        ("2026-02", 1, 400.0, 400.0, 400, 400),
        ("2026-03", 2, 120.0, 120.0, 60, 60),
        ("2026-04", 1, 30.0, 30.0, 30, 30),
    ]


def test_tickets_round_half_to_even(spark):
    many = [contract(str(i), "2026-01-05", None, D, "t1", v) for i, v in enumerate(["2.00", "3.00"])]
    assert production.monthly_production(enriched(spark, many)).first()["ticketB"] == 2


def test_products_and_funds(df):
    assert rows(production.product_month(df)) == [
        ("2026-01", "FGTS", 2, 300.5, 250.25), ("2026-02", "CLT", 1, 400.0, 400.0),
        ("2026-03", "CLT", 1, 50.0, 50.0), ("2026-03", "FGTS", 1, 70.0, 70.0),
        ("2026-04", "FGTS", 1, 30.0, 30.0),
    ]
    assert rows_of(production.fund_totals(df)) == [("F2", 2, 450.0, 450.0), ("F1", 4, 400.5, 350.25)]
    assert rows_of(production.distinct_products(df)) == [("CLT",), ("FGTS",)]


def test_grand_totals(df):
    assert rows_of(production.grand_totals(df)) == [(10, 6, 850.5, 800.25, 60.0)]


def test_rankings(df):
    assert rows_of(production.rank_superintendent(df)) == [
        ("Super Y", "Super Y", 2, 450.0, 450.0), ("10 - Super - X", "Super - X", 3, 330.5, 280.25),
        (INTERNAL_LABEL, INTERNAL_LABEL, 1, 70.0, 70.0),
    ]
    wide = production.top4_wide(df).first()
    assert (wide.sup1_n, wide.sup2_n, wide.sup3_c, wide.sup4_n, wide.sup4_c) == (
        "Super Y", "Super - X", 1, "-", 0,
    )


def test_month_to_date_has_no_upper_bound(df):
    assert rows_of(production.mtd_totals(df, AS_OF)) == [(3, 150.0, 150.0)]
    assert rows(production.mtd_product(df, AS_OF)) == [("CLT", 1, 50.0, 50.0), ("FGTS", 2, 100.0, 100.0)]


def test_today(df):
    assert rows_of(production.today_totals(df, AS_OF)) == [(1, 70.0, 70.0)]
    assert rows_of(production.today_partner(df, AS_OF)) == [(INTERNAL_LABEL, 1, 70.0, 70.0)]
    assert rows_of(production.today_totals(df, dt.date(2020, 1, 1))) == [(0, 0.0, 0.0)]


def test_day_by_day_fills_the_month_and_keeps_to_it(df):
    found = rows_of(production.day_by_day(df, AS_OF).orderBy("dia"))
    assert [r[0] for r in found] == list(range(1, 11))
    assert {r[0]: r[1:] for r in found if r[1]} == {2: (1, 50.0, 50.0), 10: (1, 70.0, 70.0)}
    assert rows_of(production.day_by_day(df, dt.date(2025, 1, 9))) == []


def test_run_rate(df):
    r = production.run_rate(df, AS_OF).first()
    assert (r.mes, r.C, float(r.B), r.pdu, r.tdu, r.pct) == ("Mar/26", 3, 150.0, 7, 22, 31.8)
    assert (r.proj_b, r.proj_c) == (471.43, 9)
    # The second-last month with a disbursement is March: April has one too.
    assert (float(r.ant_b), r.ant_c, r.var_b) == (120.0, 2, 292.9)


def test_run_rate_before_the_first_business_day_and_without_history(spark, df):
    r = production.run_rate(df, dt.date(2026, 8, 1)).first()
    assert (r.pdu, r.tdu, r.proj_b, r.proj_c, r.C, float(r.B)) == (0, 21, 0.0, 0, 0, 0.0)
    one = enriched(spark, CONTRACTS[:1])
    r = production.run_rate(one, dt.date(2026, 1, 30)).first()
    assert (float(r.ant_b), r.ant_c, r.var_b) == (0.0, 0, 0.0)
    empty = production.run_rate(df.limit(0), AS_OF).first()
    assert (empty.C, float(empty.B), empty.ant_c) == (0, 0.0, 0)


def test_product_kpis(df):
    found = rows_of(production.product_kpis(df, AS_OF))
    assert found == [
        ("lead", "FGTS", 5, 4, 1, 400.5, 350.25, 70.0, 70.0, 80.0, 100),
        ("runner_up", "CLT", 3, 2, 0, 450.0, 450.0, 0.0, 0.0, 66.7, 225),
    ]
    none = rows_of(production.product_kpis(df.limit(0), AS_OF))
    assert [r[:4] for r in none] == [("lead", "FGTS", 0, 0), ("runner_up", "E-CONSIGNADO", 0, 0)]


# --- hierarchy --------------------------------------------------------------


def test_level_rankings(df):
    found = rows_of(hierarchy.level_rankings(df).where("nome != '" + INTERNAL_LABEL + "'"))
    assert sorted(found, key=str) == sorted(
        [
            ("Superintendente", "Super Y", 2, 450.0, 450.0, None, None, None),
            ("Superintendente", "10 - Super - X", 3, 330.5, 280.25, None, None, None),
            ("Regional", "Sul Dois", 2, 450.0, 450.0, None, None, None),
            ("Regional", "Norte Um", 3, 330.5, 280.25, None, None, None),
            ("Comercial", "Com Dois", 2, 450.0, 450.0, None, None, None),
            ("Comercial", "Com Um", 3, 330.5, 280.25, None, None, None),
            ("Parceiro", "Parceiro B", 2, 450.0, 450.0, "Super Y", "Sul Dois", "Com Dois"),
            ("Parceiro", "Parceiro A", 3, 330.5, 280.25, "10 - Super - X", "Norte Um", "Com Um"),
        ],
        key=str,
    )


def test_level_rankings_keep_the_limit_of_each_level(spark, df):
    wide = df.limit(1).select(
        *[c for c in df.columns if c not in s.LEVELS], F.explode(F.sequence(F.lit(100), F.lit(199))).alias("i")
    ).withColumns({c: F.concat(F.lit(c), F.col("i").cast("string")) for c in s.LEVELS})
    counts = {r.nivel: r["count"] for r in hierarchy.level_rankings(wide).groupBy("nivel").count().collect()}
    assert counts == hierarchy.LEVEL_LIMITS
    per_product = hierarchy.level_rankings_product(wide).where("nivel = 'Regional'").orderBy("nome")
    assert [r.nome for r in per_product.collect()] == [f"Regional{i}" for i in range(100, 120)]


def test_a_partner_keeps_the_hierarchy_first_seen(spark, df):
    base = df.where("CCB = 'a'")
    moved = base.withColumns(
        {s.DISBURSED_ON: F.lit("2025-12-01").cast("timestamp_ntz"), s.REGIONAL: F.lit("Antes Dele")}
    )
    found = hierarchy.rank_partner_enriched(base.union(moved)).first()
    assert (found[s.PARTNER], found.C, found[s.REGIONAL]) == ("Parceiro A", 2, "Antes Dele")


def test_partner_month_keeps_leaders_of_any_month(df):
    found = rows_of(hierarchy.partner_month(df, 1))
    # B leads overall and in February, A in January and April, the house in March.
    assert sorted(found) == sorted([
        ("Parceiro A", "2026-01", 2, 300, 250), ("Parceiro A", "2026-04", 1, 30, 30),
        ("Parceiro B", "2026-02", 1, 400, 400), ("Parceiro B", "2026-03", 1, 50, 50),
        (INTERNAL_LABEL, "2026-03", 1, 70, 70),
    ])


def test_level_counts_leave_out_contracts_without_amount(spark):
    only = [contract("x", "2026-01-05", None, D, "t1", None)]
    assert hierarchy.sup_month(enriched(spark, only)).first()["C"] == 0
    assert production.monthly_production(enriched(spark, only)).first()["C"] == 1


# --- funnel -----------------------------------------------------------------


def test_status(df):
    assert rows_of(funnel.status_mix(df)) == [
        ("Desembolsado", 7), ("Ag. Desembolso", 1), ("Cancelado", 1), ("Em Averbacao", 1),
    ]
    assert rows_of(funnel.status_rollup(df)) == [(7, 1, 2)]


def test_conversion(df):
    assert rows(funnel.conversion_product(df)) == [("CLT", 3, 2), ("FGTS", 5, 4), ("OUTRO", 1, 0)]
    assert rows(funnel.funnel_fund(df)) == [
        ("F1", 5, 4, 1, 0, 400.5, 350.25, 80.0), ("F2", 3, 2, 1, 0, 450.0, 450.0, 66.7),
    ]


def test_percentages_round_half_to_even(spark):
    many = [
        contract(str(i), "2026-01-05", None, D if i == 0 else C, "t1", "1.00") for i in range(16)
    ]
    assert funnel.conversion_fund(enriched(spark, many)).first()["conv"] == 6.2  # 6.25


def test_cohorts(df):
    assert rows_of(funnel.cohort_conversion(df)) == [
        ("2026-01", 2, 1, 0, 50.0), ("2026-02", 2, 2, 0, 100.0), ("2026-03", 5, 4, 1, 80.0),
    ]
    assert rows_of(funnel.cohort_conversion(df, dense=True))[-1] == ("2026-04", 0, 0, 0, 0.0)


def test_dense_series(df):
    found = {(r[0], r[1]): r[2] for r in rows_of(funnel.dense_month_product(df))}
    assert len(found) == 8 and found["FGTS", "2026-02"] == 0 and found["FGTS", "2026-01"] == 2
    assert rows_of(funnel.product_series(df)) == [
        ("2026-01", 2, 0), ("2026-02", 0, 1), ("2026-03", 1, 1), ("2026-04", 1, 0),
    ]
    assert {r[2] for r in rows_of(funnel.product_series(df, seconds=("X", "Y")))} == {0}


def test_product_fund_pairs(df):
    assert rows(funnel.product_fund_pairs(df)) == [("CLT", "F2"), ("FGTS", "F1")]


def test_periods(df):
    found = {r[0]: r[1:] for r in rows_of(funnel.period_slices(df, AS_OF))}
    assert found == {
        "todos": (10, 7, 1, 2, 1849.5, 1799.25), "mes": (5, 4, 1, 0, 1149.0, 1149.0),
        "7d": (4, 3, 1, 0, 1099.0, 1099.0), "hoje": (2, 1, 1, 0, 70.0, 70.0),
    }
    assert all(r[1] == r[2] + r[3] + r[4] for r in rows_of(funnel.period_slices(df, AS_OF)))
    empty = rows_of(funnel.period_slices(df.limit(0), AS_OF))
    assert [r[1:] for r in empty] == [(0, 0, 0, 0, 0.0, 0.0)] * 4
    assert ("hoje", "CLT", 1, 0, 1, 0, 0.0, 0.0) in rows(funnel.period_slices_product(df, AS_OF))


def test_slice_filter(df):
    def ids(**kwargs):
        return sorted(r[s.CCB] for r in funnel.slice_filter(df, AS_OF, **kwargs).collect())

    assert len(ids()) == 10
    assert ids(periodo="hoje") == ["e", "h"]
    assert ids(periodo="mes", produto="FGTS", status="Desembolsado") == ["e", "f", "g"]
    assert ids(fundo="F2", status="Cancelado") == ["h"]


# --- tables and quality ------------------------------------------------------


def test_table_mix(spark):
    march = "2026-03-03"
    data = [
        contract("1", march, None, D, "t1", "10.00"),
        contract("2", None, march, C, "t1", "99.00"),
        contract("3", march, None, D, "3", "7.00", fund="fidc x"),
        contract("4", march, None, D, "3", "5.00"),
        contract("5", march, None, D, "3", "1.00", name=" nan "),
        contract("6", "2026-02-03", "2026-02-01", D, "t1", "50.00"),
        contract("7", march, None, D, "zz", "3.00"),
    ]
    df = enriched(spark, data)
    assert rows_of(tables.table_mix_month(df, AS_OF)) == [
        ("Tab - F1", 2, 1, 10.0, 10.0), ("Tab", 2, 2, 8.0, 8.0), ("Tab - FIDC X", 1, 1, 7.0, 7.0),
    ]
    assert rows_of(tables.table_mix_month_product(df, AS_OF)) == [
        ("FGTS", "Tab - F1", 2, 1, 10.0, 10.0), ("OUTRO", "Tab - FIDC X", 1, 1, 7.0, 7.0),
        ("OUTRO", "Tab", 1, 1, 5.0, 5.0),
    ]


def test_quality(df):
    assert rows_of(quality.value_counts_top(df, s.STATUS, 2)) == [(D, 7), ("Aguardando desembolso", 1)]
    assert rows_of(quality.date_coverage(df)) == [
        (10, 7, 3, 6, 1, dt.date(2026, 1, 5), dt.date(2026, 4, 2)),
    ]


def test_product_rows_sum_to_no_more_than_the_month(spark):
    rows_ = [*CONTRACTS, contract("k", "2026-01-07", None, D, "zz", "1.00")]
    df = enriched(spark, rows_)
    monthly = {r.Mes: r.C for r in production.monthly_production(df).collect()}
    by_product = production.product_month(df).groupBy("Mes").agg(F.sum("C").alias("C"))
    found = {r.Mes: r.C for r in by_product.collect()}
    assert all(found[m] <= monthly[m] for m in found) and found["2026-01"] == monthly["2026-01"] - 1


def test_metrics_over_cubes_equal_those_over_contracts(spark):
    contracts = [
        *CONTRACTS,
        contract("k", "2026-03-10 15:00", "2026-03-10", D, "t1", "1.00", broker="9"),
        contract("l", "2026-03-10 16:00", "2026-03-10", D, "t1", None, broker="9"),
        contract(None, "2026-03-10 17:00", "2026-03-10 18:00", D, "t1", "2.00", broker="9"),
    ]
    df = enriched(spark, contracts)
    found = panel_metrics(df, AS_OF)
    over = {
        **{f.__name__: f(df) for f in (
            production.monthly_production, production.product_month, production.fund_month, production.fund_totals,
            production.grand_totals, production.distinct_products, production.rank_superintendent,
            production.rank_partner, production.top4_wide, hierarchy.level_rankings, hierarchy.level_rankings_product,
            hierarchy.rank_partner_enriched, hierarchy.sup_month, hierarchy.reg_month, hierarchy.sup_month_product,
            hierarchy.partner_month, hierarchy.reg_month_product, funnel.status_mix, funnel.status_rollup,
            funnel.conversion_product, funnel.conversion_fund, funnel.funnel_product, funnel.funnel_fund,
            funnel.dense_month_product, funnel.product_series, funnel.product_fund_pairs,
        )},
        **{f.__name__: f(df, AS_OF) for f in (
            production.mtd_totals, production.mtd_product, production.mtd_fund, production.today_totals,
            production.today_partner, production.today_product, production.today_fund, production.day_by_day,
            production.run_rate, production.product_kpis, funnel.period_slices, funnel.period_slices_product,
            funnel.period_slices_fund, funnel.period_slices_status,
        )},
        "cohort_conversion": funnel.cohort_conversion(df, dense=True),
    }
    for name, metric in over.items():
        assert rows(found[name]) == rows(metric), name


def test_cubes_do_not_grow_with_the_contracts(spark):
    def sizes(folder):
        df = star.enriched(spark, folder, products=True, sales=True)
        return {r[0]: r[1] for r in cubes(df, star.AS_OF).groupBy("_cubo").count().collect()}, df.count()

    (small, few), (large, many) = sizes("/root/testdata/sf0.001"), sizes("/root/testdata/sf0.01")
    assert set(large) == set(CUBES) and many > 9 * few
    growth = many / few
    assert large["cohorts"] < 0.4 * growth * small["cohorts"] and large["partners"] < many / 3
    assert "lineitem" in cubes(star.enriched(spark, "/root/testdata/sf0.001"), star.AS_OF)._jdf.queryExecution().executedPlan().toString()


def test_every_panel_metric_runs(df):
    metrics = panel_metrics(df, AS_OF)
    assert len(metrics) == 44
    assert metrics["panel_texts"].first().asDict() == {
        "data_ref": "10/03/2026", "registros": "10", "desembolsados": "6", "conversao": "60.0%",
        "bruto": "R$ 1K", "liquido": "R$ 1K",
    }
    for name, metric in metrics.items():
        assert metric.columns, name
