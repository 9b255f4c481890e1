"""Product-table mix of a month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import calendar as cal
from creditmill.functions import cleaning as cl
from creditmill.functions import measures as ms
from creditmill.operators.enrich import by_status


def active_in_month(df: DataFrame, as_of: dt.date, stored: bool = False) -> DataFrame:
    """Contracts typed or disbursed in the month of `as_of`.

    Over a `stored` run (partitioned by month) two halves: the disbursed one reads a
    single month folder, the other filters by a range of typing dates, which skips row
    groups. Over any other plan one filter with OR, so what lies beneath is computed
    once. The halves are disjoint, so both ways give the same rows.
    """
    paid = cal.within_month(F.col(s.DISBURSED_ON), as_of) & (F.col(s.MONTH) == cal.month_of(as_of))
    typed = cal.within_month(F.col(s.TYPED_ON), as_of) & ~F.coalesce(cal.within_month(F.col(s.DISBURSED_ON), as_of), F.lit(False))
    if stored:
        return df.where(paid).union(df.where(typed))
    return df.where(F.coalesce(paid, F.lit(False)) | F.coalesce(typed, F.lit(False)))


def effective_fund() -> Column:
    """Fund of the product table, else the contract's own in upper case."""
    return F.coalesce(
        cl.known_name(F.col(s.FUND)), F.upper(cl.known_name(F.col(s.FUND_RAW)))
    )


def table_cells(df: DataFrame, as_of: dt.date, stored: bool = False) -> DataFrame:
    """Activity and disbursed amounts of the month per product, table and fund: what both
    mixes are made of. A missing product or fund is a group too. `stored`: `df` is a run
    read back, partitioned by month."""
    done = by_status()
    named = active_in_month(df, as_of, stored).where(cl.known_name(F.col(s.TABLE_NAME)).isNotNull())
    return named.groupBy(s.PRODUCT, s.TABLE_NAME, effective_fund().alias("_fund")).agg(
        ms.counted(s.N_IDS).alias("C"),
        ms.count_where(done, s.N_IDS).alias("Cdes"),
        F.sum(F.when(done, F.col(s.GROSS))).alias("B"),
        F.sum(F.when(done, F.col(s.NET))).alias("L"),
    )


def mix_of(cells: DataFrame, *keys: str) -> DataFrame:
    """Production per table and fund out of `table_cells`."""
    for key in keys:
        cells = cells.where(cl.known_name(F.col(key)).isNotNull())
    return (
        cells.groupBy(*keys, s.TABLE_NAME, "_fund")
        .agg(
            F.sum("C").alias("C"), F.sum("Cdes").alias("Cdes"),
            ms.total(F.col("B")).alias("B"), ms.total(F.col("L")).alias("L"),
        )
        .select(
            *keys, cl.table_label(F.col(s.TABLE_NAME), F.col("_fund")).alias("Tabela"),
            "C", "Cdes", "B", "L",
        )
        .orderBy(*keys, F.desc("B"), "Tabela")
    )


def table_mix_month(df: DataFrame, as_of: dt.date) -> DataFrame:
    return mix_of(table_cells(df, as_of))


def table_mix_month_product(df: DataFrame, as_of: dt.date) -> DataFrame:
    return mix_of(table_cells(df, as_of), s.PRODUCT)
