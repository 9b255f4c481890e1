"""Spread waterfall and breakeven solvers per contract, in double."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.operators.enrich import disbursed


@dataclass(frozen=True)
class Pricing:
    """Rates as shares, costs as amounts per contract. Defaults are fixed values."""

    agio: float = 0.07
    tac: float = 0.30
    iof: float = 0.0325
    desp: float = 1.20
    form: float = 5.80
    cef: float = 1.84
    rep: float = 0.42

    def literals(self) -> dict[str, Column]:
        return {k: F.lit(float(v)) for k, v in asdict(self).items()}


def _share(amount: Column, gross: Column) -> Column:
    return F.when(gross > 0, amount / gross).otherwise(F.lit(0.0))


def _solution(value: Column, valid: Column) -> Column:
    """`value` where `valid` holds; null, infinite and not-a-number count as no solution."""
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite & valid, value)


def _gross(column: str) -> Column:
    return F.col(column).cast("double")


def spread_waterfall(df: DataFrame, gross: str = s.GROSS, p: Mapping[str, Column] | None = None) -> DataFrame:
    """Fee, premium, tax, net, spreads and payout, each spread also as share of gross."""
    p = p or Pricing().literals()
    b = _gross(gross)
    return (
        df.withColumns({"tac_rs": b * p["tac"], "agio_rs": b * p["agio"], "iof_rs": b * p["iof"]})
        .withColumns(
            {
                "liquido_rs": b - F.col("tac_rs") - F.col("iof_rs") - p["desp"],
                "spread_bruto": F.col("tac_rs") + F.col("agio_rs"),
                "custo": p["form"] + p["cef"],
            }
        )
        .withColumns(
            {
                "spread_contrato": F.col("spread_bruto") - F.col("custo"),
                "base_repasse": F.greatest(F.lit(0.0), F.col("liquido_rs")),
            }
        )
        .withColumn("repasse", F.col("base_repasse") * p["rep"])
        .withColumn("spread_final", F.col("spread_contrato") - F.col("repasse"))
        .withColumns(
            {
                f"{c}_pct": _share(F.col(c), b)
                for c in ("spread_bruto", "spread_contrato", "spread_final")
            }
        )
    )


def breakeven_ticket(p: Mapping[str, Column]) -> Column:
    """Gross at which the final spread is zero; null if there is none."""
    denominator = (p["tac"] + p["agio"]) - (F.lit(1.0) - p["tac"] - p["iof"]) * p["rep"]
    value = F.try_divide((p["form"] + p["cef"]) - p["desp"] * p["rep"], denominator)
    return _solution(value, (denominator > 0) & (value > 0))


def breakeven_fee(b: Column, p: Mapping[str, Column]) -> Column:
    """Smallest fee rate that brings the final spread to zero."""
    cost = (
        (p["form"] + p["cef"]) + b * p["rep"] - b * p["agio"] - b * p["iof"] * p["rep"]
        - p["desp"] * p["rep"]
    )
    value = F.try_divide(cost, b * (F.lit(1.0) + p["rep"]))
    return _solution(value, (b > 0) & (value >= 0))


def breakeven_payout(b: Column, p: Mapping[str, Column]) -> Column:
    """Largest payout share that keeps the spread, where it is below today's."""
    contract = b * (p["tac"] + p["agio"]) - (p["form"] + p["cef"])
    base = F.greatest(F.lit(0.0), b - b * p["tac"] - b * p["iof"] - p["desp"])
    value = F.try_divide(contract, base)
    return _solution(value, (b > 0) & (base > 0) & (value >= 0) & (value < p["rep"]))


def with_breakevens(df: DataFrame, gross: str = s.GROSS, p: Mapping[str, Column] | None = None) -> DataFrame:
    p = p or Pricing().literals()
    b = _gross(gross)
    return df.withColumns(
        {
            "ticket_minimo": breakeven_ticket(p),
            "tac_minima": breakeven_fee(b, p),
            "repasse_maximo": breakeven_payout(b, p),
        }
    )


def spread_advice(df: DataFrame, gross: str = s.GROSS, p: Mapping[str, Column] | None = None) -> DataFrame:
    """For contracts with a negative final spread, what would bring it to zero."""
    p = p or Pricing().literals()
    b = _gross(gross)
    priced = with_breakevens(spread_waterfall(df, gross, p), gross, p)
    negative = F.col("spread_final") < 0
    return priced.withColumns(
        {
            "negativo": negative,
            "aumento_ticket": F.when(negative, F.col("ticket_minimo") - b),
            "sem_ticket": negative & F.col("ticket_minimo").isNull(),
            "aumento_tac_pp": F.when(
                negative & (F.col("tac_minima") > p["tac"]), (F.col("tac_minima") - p["tac"]) * 100
            ),
            "reducao_repasse_pp": F.when(negative, (p["rep"] - F.col("repasse_maximo")) * 100),
        }
    )


def spread_scenarios(df: DataFrame, scenarios: Mapping[str, Pricing], gross: str = s.GROSS) -> DataFrame:
    """Advice for every row under every named parameter set."""
    sets = F.array(
        *[
            F.struct(F.lit(name).alias("cenario"), *[c.alias(k) for k, c in p.literals().items()])
            for name, p in scenarios.items()
        ]
    )
    expanded = df.select("*", F.inline(sets))
    columns = {k: F.col(k) for k in Pricing().literals()}
    return spread_advice(expanded, gross, columns)


def ticket_range(df: DataFrame, key: str = s.FUND) -> DataFrame:
    """Smallest and largest disbursed ticket per key, one row each; a missing key is one."""
    ends = (
        disbursed(df)
        .where(F.col(s.GROSS).isNotNull())
        .groupBy(key)
        .agg(F.min(s.GROSS).alias("lo"), F.max(s.GROSS).alias("hi"))
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("ticket"), F.col(c).alias(s.GROSS))
            for name, c in (("minimo", "lo"), ("maximo", "hi"))
        ]
    )
    return ends.select(key, F.inline(rows))


def spread_by(df: DataFrame, key: str = s.FUND, p: Pricing = Pricing()) -> DataFrame:
    """Spread of the disbursed portfolio per key, the missing key among them.

    Gross and payout base are summed as exact decimals and priced afterwards, so
    the result does not depend on the order of the rows.
    """
    gross = F.col(s.GROSS)

    def rate(value: float) -> Column:
        return F.lit(f"{value:.6f}").cast("decimal(9,6)")

    net = gross - gross * rate(p.tac) - gross * rate(p.iof) - F.lit(f"{p.desp:.2f}").cast("decimal(9,2)")
    base = F.greatest(net, F.lit(0)).cast("decimal(27,8)")
    sums = (
        disbursed(df)
        .where(gross.isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("C"), F.sum(gross).alias("B"), F.sum(base).alias("base"))
    )
    b, n = F.col("B").cast("double"), F.col("C").cast("double")
    spread = b * (p.tac + p.agio) - n * (p.form + p.cef)
    final = spread - F.col("base").cast("double") * p.rep
    return sums.select(
        key, "C", "B",
        F.bround(spread, 2).alias("spread_contrato"),
        F.bround(final, 2).alias("spread_final"),
        F.bround(F.when(b > 0, final / b).otherwise(F.lit(0.0)) * 100, 4).alias("spread_final_pct"),
    )
