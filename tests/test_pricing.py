"""The pricing formulas against the worked table and against each other."""

import pytest
from pyspark.sql import functions as F

from creditmill.plans import pricing as p

WORKED = {
    # gross: net, gross spread, contract spread, payout, final, share %, fee %, payout %
    120.0: (78.90, 44.40, 36.76, 33.138, 3.622, 3.0183, 27.8744, None),
    17800.0: (11880.30, 6586.00, 6578.36, 4989.726, 1588.634, 8.9249, 23.7149, None),
    50.0: (32.175, 18.50, 10.86, 13.5135, -2.6535, -5.307, 33.7373, 33.7529),
}


def approx(value, digits=4):
    return None if value is None else pytest.approx(value, abs=10 ** -digits)


def test_worked_examples(spark):
    df = spark.createDataFrame([(g,) for g in WORKED], "b double")
    priced = {r.b: r for r in p.spread_advice(df, "b").collect()}
    for gross, (net, top, contract, payout, final, share, fee, rep) in WORKED.items():
        r = priced[gross]
        assert r.liquido_rs == approx(net) and r.spread_bruto == approx(top)
        assert r.spread_contrato == approx(contract) and r.repasse == approx(payout)
        assert r.spread_final == approx(final) and r.spread_final_pct * 100 == approx(share)
        assert r.ticket_minimo == approx(79.598438, 5)
        assert r.tac_minima * 100 == approx(fee)
        assert (r.repasse_maximo and r.repasse_maximo * 100) == approx(rep)
    assert (priced[120.0].negativo, priced[120.0].aumento_ticket) == (False, None)
    low = priced[50.0]
    assert low.negativo and low.aumento_ticket == approx(29.598438) and not low.sem_ticket
    assert low.aumento_tac_pp == approx(3.7373) and low.reducao_repasse_pp == approx(8.2471)


def test_each_breakeven_brings_the_final_spread_to_zero(spark):
    base = p.Pricing()
    df = spark.createDataFrame([(50.0,), (75.0,)], "b double")
    solved = p.with_breakevens(df, "b")
    ticket = p.spread_waterfall(solved, "ticket_minimo")
    lits = base.literals()
    fee = p.spread_waterfall(solved, "b", {**lits, "tac": F.col("tac_minima")})
    rep = p.spread_waterfall(solved, "b", {**lits, "rep": F.col("repasse_maximo")})
    for priced in (ticket, fee, rep):
        assert all(r.spread_final == approx(0.0, 9) for r in priced.collect())


def test_no_solution(spark):
    df = spark.createDataFrame([(0.0,), (-5.0,), (None,), (1.0,)], "b double")
    rows = p.with_breakevens(df, "b").collect()
    assert [(r.tac_minima, r.repasse_maximo) for r in rows[:3]] == [(None, None)] * 3
    assert rows[3].repasse_maximo is None  # net is below zero
    hopeless = p.Pricing(agio=0.0, tac=0.01).literals()
    assert p.spread_advice(df, "b", hopeless).where("sem_ticket").count() == 3
    assert p.with_breakevens(df, "b", hopeless).first().ticket_minimo is None


def test_share_of_nothing_is_zero(spark):
    r = p.spread_waterfall(spark.createDataFrame([(0.0,)], "b double"), "b").first()
    assert (r.base_repasse, r.repasse, r.spread_final_pct) == (0.0, 0.0, 0.0)
    assert r.spread_final == approx(-7.64)


def test_portfolio_spread_is_the_sum_of_its_contracts(spark):
    df = spark.range(1, 2001).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("Fundo"),
        (F.col("id") * 37 % 5000 / 100).cast("decimal(18,2)").alias("Valor Bruto"),
        F.lit("Desembolsado").alias("Status"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("Data do Desembolso"),
    )
    single = p.spread_waterfall(df).groupBy("Fundo").agg(F.sum("spread_final").alias("x"))
    wanted = {r.Fundo: r.x for r in single.collect()}
    found = {r.Fundo: r.spread_final for r in p.spread_by(df).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[k] == approx(wanted[k], 2) for k in found)


def test_scenarios_price_every_row_under_every_set(spark):
    df = spark.createDataFrame([(120.0,), (17800.0,)], "b double")
    found = p.spread_scenarios(df, {"x": p.Pricing(), "y": p.Pricing(rep=0.0)}, "b").collect()
    assert {(r.b, r.cenario): round(r.spread_final, 3) for r in found} == {
        (120.0, "x"): 3.622, (120.0, "y"): 36.76, (17800.0, "x"): 1588.634, (17800.0, "y"): 6578.36,
    }
