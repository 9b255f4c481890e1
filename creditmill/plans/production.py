"""Production metrics: series, mixes, rankings, month to date, today, run rate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import calendar as cal
from creditmill.functions import cleaning as cl
from creditmill.functions import measures as ms
from creditmill.operators.enrich import disbursed, is_disbursed
from creditmill.operators.keys import top_rows

# The product followed on its own, and the names its counterpart
# may have, in order of preference.
LEAD_PRODUCT = "FGTS"
SECOND_PRODUCTS = ("E-CONSIGNADO", "CLT")


def _by(df: DataFrame, *keys: str) -> DataFrame:
    """Production per key; rows that lack a key are left out."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(*ms.production())


# --- whole period ---------------------------------------------------------


def monthly_production(df: DataFrame) -> DataFrame:
    """Contracts, amounts and average tickets per disbursement month."""
    return (
        _by(disbursed(df), s.MONTH)
        .select(
            s.MONTH, "C", "B", "L",
            ms.whole_ratio(F.col("B"), F.col("C")).alias("ticketB"),
            ms.whole_ratio(F.col("L"), F.col("C")).alias("ticketL"),
        )
        .orderBy(s.MONTH)
    )


def product_month(df: DataFrame) -> DataFrame:
    return _by(disbursed(df), s.MONTH, s.PRODUCT)


def fund_month(df: DataFrame) -> DataFrame:
    return _by(disbursed(df), s.MONTH, s.FUND)


def fund_totals(df: DataFrame) -> DataFrame:
    return _by(disbursed(df), s.FUND).orderBy(F.desc("B"), s.FUND)


def grand_totals(df: DataFrame) -> DataFrame:
    done = is_disbursed()
    return df.agg(
        ms.counted().alias("total_reg"),
        ms.count_where(done).alias("total_des"),
        ms.total_where(done, F.col(s.GROSS)).alias("total_bruto"),
        ms.total_where(done, F.col(s.NET)).alias("total_liq"),
    ).withColumn("conv_geral", ms.percent(F.col("total_des"), F.col("total_reg")))


def rank_superintendent(df: DataFrame, n: int = 8) -> DataFrame:
    """Top superintendents, shown without their number prefix."""
    valid = disbursed(df).where(cl.valid_name(F.col(s.SUPERINTENDENT)))
    top = top_rows(_by(valid, s.SUPERINTENDENT), n, "B", s.SUPERINTENDENT)
    return top.select(
        s.SUPERINTENDENT, cl.after_prefix(F.col(s.SUPERINTENDENT)).alias("nome"), "C", "B", "L"
    )


def rank_partner(df: DataFrame, n: int = 15) -> DataFrame:
    valid = disbursed(df).where(cl.valid_name(F.col(s.PARTNER)))
    return top_rows(_by(valid, s.PARTNER), n, "B", s.PARTNER)


def distinct_products(df: DataFrame) -> DataFrame:
    """Products with a disbursement, in order."""
    return (
        disbursed(df)
        .where(cl.known_name(F.col(s.PRODUCT)).isNotNull())
        .select(s.PRODUCT).distinct().orderBy(s.PRODUCT)
    )


def top4_wide(df: DataFrame) -> DataFrame:
    """The four leading superintendents spread over one row."""
    fields = {"n": F.col("nome"), "c": F.col("C"), "b": F.col("B"), "l": F.col("L")}
    ranked = rank_superintendent(df, 4).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    (-F.col("B")).alias("_order"), F.col(s.SUPERINTENDENT).alias("_name"),
                    *[c.alias(k) for k, c in fields.items()],
                )
            )
        ).alias("sups")
    )
    empty = {"n": F.lit("-"), "c": F.lit(0).cast("bigint"), "b": F.lit(0).cast(s.TOTAL),
             "l": F.lit(0).cast(s.TOTAL)}
    return ranked.select(
        *[
            F.coalesce(F.get("sups", F.lit(i))[k], empty[k]).alias(f"sup{i + 1}_{k}")
            for i in range(4) for k in fields
        ]
    )


# --- month to date and today ----------------------------------------------
# Each filter names the date range, which skips row groups, and the month, which
# skips folders of a table stored by month.


def month_to_date(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Disbursed from the first of the month on; there is no upper bound."""
    start = cal.midnight(as_of.replace(day=1))
    return disbursed(df).where(F.col(s.DISBURSED_ON) >= start).where(
        F.col(s.MONTH) >= cal.month_of(as_of)
    )


def on_day(df: DataFrame, as_of: dt.date) -> DataFrame:
    day = disbursed(df).where(cal.within_day(F.col(s.DISBURSED_ON), as_of))
    return day.where(F.col(s.MONTH) == cal.month_of(as_of))


def _totals(df: DataFrame) -> DataFrame:
    """Here every row counts, with an id or without."""
    return df.agg(*ms.production(s.N_ROWS))


def mtd_totals(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _totals(month_to_date(df, as_of))


def mtd_product(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _by(month_to_date(df, as_of), s.PRODUCT)


def mtd_fund(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _by(month_to_date(df, as_of), s.FUND)


def today_totals(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _totals(on_day(df, as_of))


def today_partner(df: DataFrame, as_of: dt.date, n: int = 15) -> DataFrame:
    """Top partners of the day; here short names count too."""
    return top_rows(_by(on_day(df, as_of), s.PARTNER), n, "B", s.PARTNER)


def today_product(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _by(on_day(df, as_of), s.PRODUCT)


def today_fund(df: DataFrame, as_of: dt.date) -> DataFrame:
    return _by(on_day(df, as_of), s.FUND)


def day_by_day(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Every day of the `as_of` month up to `as_of`, 0 where nothing was disbursed.

    No row at all when the month is empty. The days are at most 31, so they fit
    one map that the day axis looks into, and no join is needed.
    """
    month = disbursed(df).where(cal.within_month(F.col(s.DISBURSED_ON), as_of))
    month = month.where(F.col(s.MONTH) == cal.month_of(as_of))
    days = month.groupBy(F.dayofmonth(s.DISBURSED_ON).alias("dia")).agg(*ms.production())
    found = days.agg(
        F.map_from_entries(F.collect_list(F.struct("dia", F.struct("C", "B", "L")))).alias("found")
    ).where(F.size("found") > 0)
    axis = found.select(
        "found", F.explode(F.sequence(F.lit(1), F.lit(as_of.day))).alias("dia")
    )
    day = F.try_element_at("found", F.col("dia"))
    return axis.select(
        "dia",
        F.coalesce(day["C"], F.lit(0)).cast("bigint").alias("C"),
        F.coalesce(day["B"], F.lit(0).cast(s.TOTAL)).alias("B"),
        F.coalesce(day["L"], F.lit(0).cast(s.TOTAL)).alias("L"),
    )


def run_rate(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Month to date projected over the business days, against the month before.

    The month before is the second-last month that has a disbursement. All of it
    comes from the monthly totals, whose number the calendar bounds.
    """
    months = disbursed(df).groupBy(s.MONTH).agg(ms.counted().alias("N"), *ms.production_parts())
    current = F.col(s.MONTH) >= cal.month_of(as_of)
    listed = F.sort_array(F.collect_list(F.struct(s.MONTH, "B", "C")), asc=False)
    sums = months.agg(
        F.coalesce(F.sum(F.when(current, F.col("N"))), F.lit(0)).alias("C"),
        ms.total_where(current, F.col("B")).alias("B"),
        ms.total_where(current, F.col("L")).alias("L"),
        F.get(listed, F.lit(1)).alias("_previous"),
    )
    today = cal.day_literal(as_of)
    elapsed, days = F.col("pdu"), F.col("tdu")

    def projected(name: str, places: int):
        return F.bround(ms.ratio(F.col(name), elapsed) * days, places)

    return (
        sums.withColumns(
            {
                "mes": cal.month_label(F.lit(cal.month_of(as_of))),
                "pdu": cal.business_days_elapsed(today),
                "tdu": cal.business_days_total(today),
                "ant_b": F.bround(F.coalesce(F.col("_previous.B"), F.lit(0)), 2).cast(s.TOTAL),
                "ant_c": F.coalesce(F.col("_previous.C"), F.lit(0)),
            }
        )
        .withColumns(
            {
                "pct": ms.percent(elapsed, days),
                "proj_b": projected("B", 2),
                "proj_l": projected("L", 2),
                "proj_c": projected("C", 0).cast("bigint"),
            }
        )
        .withColumn(
            "var_b",
            F.when(
                F.col("ant_b") != 0,
                F.bround((F.try_divide(F.col("proj_b"), F.col("ant_b").cast("double")) - 1) * 100, 1),
            ).otherwise(F.lit(0.0)),
        )
        .select("mes", "C", "B", "L", "pdu", "tdu", "pct", "proj_b", "proj_l", "proj_c",
                "ant_b", "ant_c", "var_b")
    )


# --- lead product ----------------------------------------------------------


def product_kpis(df: DataFrame, as_of: dt.date, lead: str = LEAD_PRODUCT,
                 fallback: str = SECOND_PRODUCTS[0]) -> DataFrame:
    """The lead product and the largest other one by contracts, always two rows.

    One pass over the contracts; the runner-up is picked among product totals.
    """
    done = is_disbursed()
    today = done & cal.within_day(F.col(s.DISBURSED_ON), as_of)
    gross, net = F.col(s.GROSS), F.col(s.NET)
    products = (
        df.where(F.col(s.PRODUCT).isNotNull())
        .groupBy(s.PRODUCT)
        .agg(
            ms.counted(s.N_IDS).alias("total"),
            ms.count_where(done, s.N_IDS).alias("desemb"),
            ms.total_where(done, gross).alias("bruta"),
            ms.total_where(done, net).alias("liq"),
            ms.count_where(today, s.N_IDS).alias("hoje_c"),
            ms.total_where(today, gross).alias("hoje_b"),
            ms.total_where(today, net).alias("hoje_l"),
        )
    )
    counts, amounts = ("total", "desemb", "hoje_c"), ("bruta", "liq", "hoje_b", "hoje_l")
    record = F.struct(s.PRODUCT, *counts, *amounts)
    is_lead = F.col(s.PRODUCT) == lead
    other = ~is_lead & (F.col(s.PRODUCT) != "")
    picked = products.agg(
        F.max(F.when(is_lead, record)).alias("lead"),
        F.min_by(record, F.when(other, F.struct((-F.col("total")).alias("t"), s.PRODUCT))).alias("other"),
    )

    def row(role: str, source: str, name: str):
        zero_count = F.lit(0).cast("bigint")
        zero_amount = F.lit(0).cast(s.TOTAL)
        return F.struct(
            F.lit(role).alias("papel"),
            F.coalesce(F.col(source)[s.PRODUCT], F.lit(name)).alias(s.PRODUCT),
            *[F.coalesce(F.col(source)[c], zero_count).alias(c) for c in counts],
            *[F.coalesce(F.col(source)[c], zero_amount).alias(c) for c in amounts],
        )

    rows = picked.select(
        F.explode(F.array(row("lead", "lead", lead), row("runner_up", "other", fallback))).alias("r")
    ).select("r.*")
    return rows.withColumns(
        {
            "conv": ms.percent(F.col("desemb"), F.col("total")),
            "ticket": ms.whole_ratio(F.col("bruta"), F.col("desemb")),
        }
    )
