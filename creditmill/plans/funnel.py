"""Status mix, conversion, cohorts, product series and typing-date periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import calendar as cal
from creditmill.functions import cleaning as cl
from creditmill.functions import measures as ms
from creditmill.operators.cells import day_of, folded
from creditmill.operators.enrich import by_status, disbursed, is_disbursed
from creditmill.plans.production import LEAD_PRODUCT, SECOND_PRODUCTS

ALL = "todos"


def status_mix(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(s.CATEGORY).agg(ms.counted(s.N_IDS).alias("v")).orderBy(F.desc("v"), s.CATEGORY)
    )


def status_rollup(df: DataFrame) -> DataFrame:
    """Disbursed, cancelled and everything else, by category."""
    category = F.col(s.CATEGORY)
    return df.agg(
        ms.count_where(category == cl.DISBURSED, s.N_IDS).alias("st_des"),
        ms.count_where(category == cl.CANCELLED, s.N_IDS).alias("st_canc"),
        ms.count_where(~category.isin(cl.DISBURSED, cl.CANCELLED), s.N_IDS).alias("st_ag"),
    )


# --- conversion ------------------------------------------------------------


def _conversion(df: DataFrame, key: str) -> DataFrame:
    """Total against disbursed in one conditional aggregate, no self-join."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            ms.counted(s.N_IDS).alias("Total"),
            ms.count_where(is_disbursed(), s.N_IDS).alias("Desemb"),
        )
    )


def conversion_product(df: DataFrame) -> DataFrame:
    return _conversion(df, s.PRODUCT)


def conversion_fund(df: DataFrame) -> DataFrame:
    return _conversion(df, s.FUND).withColumn(
        "conv", ms.percent(F.col("Desemb"), F.col("Total"))
    )


def _funnel(df: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """Funnel record per key; `canc` is all that is not disbursed, and nothing is
    in flight at this grain."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return (
        df.groupBy(*keys)
        .agg(
            ms.counted(s.N_IDS).alias("total"),
            ms.count_where(condition, s.N_IDS).alias("desemb"),
            ms.total_where(condition, F.col(s.GROSS)).alias("bruta"),
            ms.total_where(condition, F.col(s.NET)).alias("liq"),
        )
        .select(
            *keys, "total", "desemb",
            (F.col("total") - F.col("desemb")).alias("canc"),
            F.lit(0).cast("bigint").alias("andamento"),
            "bruta", "liq",
        )
    )


def _with_conversion(df: DataFrame) -> DataFrame:
    return df.withColumn("conv", ms.percent(F.col("desemb"), F.col("total")))


def funnel_product(df: DataFrame) -> DataFrame:
    return _funnel(df, is_disbursed(), s.PRODUCT)


def funnel_fund(df: DataFrame) -> DataFrame:
    return _with_conversion(_funnel(df, is_disbursed(), s.FUND))


def cohort_conversion(df: DataFrame, dense: bool = False) -> DataFrame:
    """Conversion per typing month, for the months that have a disbursement.

    The contracts are folded to (typing month, disbursement month) cells. Each cell
    then counts once for either month, so the month axis needs no join. `dense` also
    shows months in which nothing was typed.
    """
    status = F.col(s.STATUS)
    cells = df.groupBy(s.COHORT, s.MONTH).agg(
        ms.counted().alias("rows"),
        ms.counted(s.N_IDS).alias("total"),
        ms.count_where(status == cl.DISBURSED, s.N_IDS).alias("desemb"),
        ms.count_where(status == cl.CANCELLED, s.N_IDS).alias("canc"),
        ms.count_where(status == cl.DISBURSED).alias("dated"),
    )
    zero = F.lit(0).cast("bigint")
    typed = F.struct(F.col(s.COHORT).alias("Mes"), "rows", "total", "desemb", "canc", zero.alias("dated"))
    paid = F.struct(
        F.col(s.MONTH).alias("Mes"), zero.alias("rows"), zero.alias("total"), zero.alias("desemb"),
        zero.alias("canc"), "dated",
    )
    months = (
        cells.select(F.inline(F.array(typed, paid)))
        .where(F.col("Mes").isNotNull())
        .groupBy("Mes")
        .agg(
            F.sum("total").alias("Total"), F.sum("desemb").alias("Desemb"),
            F.sum("canc").alias("Canc"), F.sum("rows").alias("_rows"), F.sum("dated").alias("_dated"),
        )
        .where(F.col("_dated") > 0)
    )
    if not dense:
        months = months.where(F.col("_rows") > 0)
    return months.select(
        "Mes", "Total", "Desemb", "Canc", ms.percent(F.col("Desemb"), F.col("Total")).alias("Conv")
    ).orderBy("Mes")


# --- product series --------------------------------------------------------


def dense_month_product(df: DataFrame) -> DataFrame:
    """Contracts of every product in every month with a disbursement, 0 where none.

    Month list and cells come from one aggregate, whose exchange is reused. The list holds
    one entry per calendar month and reaches the products as a scalar subquery.
    """
    cells = disbursed(df).groupBy(s.MONTH, s.PRODUCT).agg(ms.counted(s.N_IDS).alias("C"))
    months = cells.agg(F.sort_array(F.collect_set(s.MONTH))).scalar()
    known = cells.where(cl.known_name(F.col(s.PRODUCT)).isNotNull())
    found = known.groupBy(s.PRODUCT).agg(
        F.map_from_entries(F.collect_list(F.struct(s.MONTH, "C"))).alias("found")
    )
    return found.select(s.PRODUCT, "found", F.explode(months).alias(s.MONTH)).select(
        s.PRODUCT, s.MONTH,
        F.coalesce(F.try_element_at("found", F.col(s.MONTH)), F.lit(0)).alias("C"),
    )


def product_series(
    df: DataFrame, lead: str = LEAD_PRODUCT, seconds: Sequence[str] = SECOND_PRODUCTS
) -> DataFrame:
    """Monthly contracts of the lead product and of the first of `seconds` that ever
    had a disbursement, 0 where none."""
    product = F.col(s.PRODUCT)
    months = disbursed(df).groupBy(s.MONTH).agg(
        ms.count_where(product == lead, s.N_IDS).alias("lead"),
        *[ms.count_where(product == name, s.N_IDS).alias(f"c{i}") for i, name in enumerate(seconds)],
        *[ms.count_where(product == name).alias(f"n{i}") for i, name in enumerate(seconds)],
    )
    # One entry per calendar month.
    listed = months.agg(
        F.collect_list(F.struct(s.MONTH, "lead", *[f"c{i}" for i in range(len(seconds))])).alias("m"),
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(seconds))],
    ).select("*", F.explode("m").alias("month"))
    second = F.coalesce(
        *[F.when(F.col(f"n{i}") > 0, F.col(f"month.c{i}")) for i in range(len(seconds))], F.lit(0)
    )
    return listed.select(
        F.col(f"month.{s.MONTH}").alias(s.MONTH), F.col("month.lead").alias("lead"),
        second.cast("bigint").alias("second"),
    ).orderBy(s.MONTH)


def product_fund_pairs(df: DataFrame) -> DataFrame:
    """Funds that each product was disbursed with."""
    return (
        disbursed(df)
        .where(cl.known_name(F.col(s.PRODUCT)).isNotNull() & cl.known_name(F.col(s.FUND)).isNotNull())
        .select(s.PRODUCT, s.FUND)
        .distinct()
    )


# --- periods by typing date -------------------------------------------------


def period_conditions(as_of: dt.date, column: str = s.TYPED_ON) -> dict[str, Column]:
    """All, month to date, last seven days and the day itself.

    Plain ranges on the column, so a scan can skip what lies outside.
    """
    c = F.col(column)

    return {
        ALL: F.lit(True),
        "mes": c >= cal.midnight(as_of.replace(day=1)),
        "7d": c >= cal.midnight(as_of - dt.timedelta(days=6)),
        "hoje": cal.within_day(c, as_of),
    }


def _in_periods(df: DataFrame, as_of: dt.date, *keys: str) -> DataFrame:
    """Counts and amounts per key, once for every period they fall in.

    The contracts are folded by typing day before the days are repeated.
    """
    days = folded(df, day_of(s.TYPED_ON), *keys)
    names = [F.when(hit, F.lit(name)) for name, hit in period_conditions(as_of).items()]
    return days.withColumn("periodo", F.explode(F.array_compact(F.array(*names))))


def period_slices(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals per period; empty periods show zeros. The contracts are folded by typing
    day, status and category first, and the periods' conditions applied to the folded
    rows, a few per day."""
    df = folded(df, day_of(s.TYPED_ON), s.STATUS, s.CATEGORY)
    done, cancelled = by_status(), F.col(s.CATEGORY) == cl.CANCELLED
    periods = period_conditions(as_of)
    measures = []
    for i, hit in enumerate(periods.values()):
        measures += [
            ms.count_where(hit).alias(f"total{i}"),
            ms.count_where(hit & done).alias(f"desemb{i}"),
            ms.count_where(hit & cancelled).alias(f"canc{i}"),
            ms.total_where(hit & done, F.col(s.GROSS)).alias(f"bruta{i}"),
            ms.total_where(hit & done, F.col(s.NET)).alias(f"liq{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("periodo"),
            *[F.col(f"{m}{i}").alias(m) for m in ("total", "desemb", "canc")],
            (F.col(f"total{i}") - F.col(f"desemb{i}") - F.col(f"canc{i}")).alias("andamento"),
            *[F.col(f"{m}{i}").alias(m) for m in ("bruta", "liq")],
        )
        for i, name in enumerate(periods)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def period_slices_product(df: DataFrame, as_of: dt.date) -> DataFrame:
    periods = _in_periods(df, as_of, s.STATUS, s.PRODUCT)
    return _funnel(periods, by_status(), "periodo", s.PRODUCT)


def period_slices_fund(df: DataFrame, as_of: dt.date) -> DataFrame:
    periods = _in_periods(df, as_of, s.STATUS, s.FUND)
    return _with_conversion(_funnel(periods, by_status(), "periodo", s.FUND))


def period_slices_status(df: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _in_periods(df, as_of, s.CATEGORY)
        .groupBy("periodo", s.CATEGORY)
        .agg(ms.counted(s.N_IDS).alias("v"))
        .orderBy("periodo", F.desc("v"), s.CATEGORY)
    )


def slice_filter(
    df: DataFrame, as_of: dt.date, periodo: str = ALL, produto: str = ALL, fundo: str = ALL,
    status: str = ALL,
) -> DataFrame:
    """Contracts behind one setting of the panel's filters."""
    if periodo != ALL:
        df = df.where(period_conditions(as_of)[periodo])
    for column, wanted in ((s.PRODUCT, produto), (s.FUND, fundo), (s.CATEGORY, status)):
        if wanted != ALL:
            df = df.where(F.col(column) == wanted)
    return df
