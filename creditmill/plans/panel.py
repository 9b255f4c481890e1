"""All metrics of the panel over one enriched contract table."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import display
from creditmill.functions.calendar import day_literal
from creditmill.operators.cells import cube, cubes
from creditmill.operators.materialize import computed_once
from creditmill.plans import funnel, hierarchy, production, tables
from creditmill.sources.sinks import panel_rows, write_json

# Metrics written at a time.
WRITERS = 8


def panel_metrics(
    contracts: DataFrame,
    as_of: dt.date,
    lead: str = production.LEAD_PRODUCT,
    seconds: tuple[str, ...] = production.SECOND_PRODUCTS,
) -> dict[str, DataFrame]:
    """Every metric by name, not yet run.

    Store the enriched contracts first (`write_run`, by month) and pass what `read_run`
    gives. They are then read once, into cubes that the metrics share; only the table mix
    goes back to the contracts, with its month pushed to the scan.
    """
    stored = computed_once(cubes(contracts, as_of))
    months, sales, cohorts, recent, partners, periods = (
        cube(stored, name) for name in ("months", "sales", "cohorts", "recent", "partners", "periods")
    )
    mix = computed_once(tables.table_cells(contracts, as_of, stored=True))
    of_months = (
        production.monthly_production, production.product_month, production.fund_month,
        production.fund_totals, production.grand_totals, production.distinct_products,
        funnel.status_mix, funnel.status_rollup, funnel.conversion_product, funnel.conversion_fund,
        funnel.funnel_product, funnel.funnel_fund, funnel.dense_month_product, funnel.product_fund_pairs,
    )
    of_sales = (
        production.rank_superintendent, production.rank_partner, production.top4_wide,
        hierarchy.level_rankings, hierarchy.level_rankings_product, hierarchy.rank_partner_enriched,
        hierarchy.sup_month, hierarchy.reg_month, hierarchy.sup_month_product,
        hierarchy.reg_month_product, hierarchy.partner_month,
    )
    of_recent = (
        production.mtd_totals, production.mtd_product, production.mtd_fund, production.today_totals,
        production.today_product, production.today_fund, production.day_by_day, production.run_rate,
    )
    of_periods = (
        funnel.period_slices, funnel.period_slices_product, funnel.period_slices_fund, funnel.period_slices_status,
    )
    return {
        **{f.__name__: f(months) for f in of_months},
        **{f.__name__: f(sales) for f in of_sales},
        **{f.__name__: f(recent, as_of) for f in of_recent},
        **{f.__name__: f(periods, as_of) for f in of_periods},
        "today_partner": production.today_partner(partners, as_of),
        "table_mix_month": tables.mix_of(mix),
        "table_mix_month_product": tables.mix_of(mix, s.PRODUCT),
        "cohort_conversion": funnel.cohort_conversion(cohorts, dense=True),
        "product_series": funnel.product_series(months, lead, seconds),
        "product_kpis": production.product_kpis(recent, as_of, lead, seconds[0]),
        "panel_texts": panel_texts(months, as_of),
    }


def panel_texts(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Headline figures as the texts the panel shows."""
    return production.grand_totals(df).select(
        display.day(day_literal(as_of)).alias("data_ref"),
        display.thousands(F.col("total_reg")).alias("registros"),
        display.thousands(F.col("total_des")).alias("desembolsados"),
        F.concat(F.col("conv_geral").cast("string"), F.lit("%")).alias("conversao"),
        display.currency_short(F.col("total_bruto")).alias("bruto"),
        display.currency_short(F.col("total_liq")).alias("liquido"),
    )


def write_panel(metrics: dict[str, DataFrame], root: str) -> None:
    """One new folder of JSON records per metric, each read back and counted. The small
    writes run side by side."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(write_json, panel_rows(df), f"{root}/{name}") for name, df in metrics.items()]:
            done.result()
