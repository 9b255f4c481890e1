"""Contracts folded to a few narrow cubes, which most metrics can read in their place."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import calendar as cal
from creditmill.functions import measures as ms
from creditmill.operators.enrich import with_periods

CUBE = "_cubo"
PAID, TYPED = "_pago", "_digitado"

# Keys of each cube besides the buckets of its dates. How many rows one has is bound by
# months, days of one month and dimension values, and not by the number of contracts.
CUBES: dict[str, tuple[str, ...]] = {
    "months": (s.MONTH, s.STATUS, s.PRODUCT, s.FUND),
    "sales": (s.MONTH, s.STATUS, s.PRODUCT, *s.LEVELS),
    "cohorts": (s.MONTH, s.COHORT, s.STATUS),
    "recent": (PAID, s.STATUS, s.PRODUCT, s.FUND),
    "partners": (PAID, s.STATUS, s.PARTNER),
    "periods": (TYPED, s.STATUS, s.PRODUCT, s.FUND),
}


def folded(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Counts and amounts per key, under the names they have in the contracts. Partly
    aggregated before its only shuffle, so the size of a group does not matter."""
    return df.groupBy(*keys).agg(*summed())


def summed() -> list[Column]:
    return [
        *[ms.counted(c).alias(c) for c in (s.N_ROWS, s.N_IDS, s.N_GROSS)],
        *[F.sum(c).alias(c) for c in (s.GROSS, s.NET)],
    ]


def day_of(column: str) -> Column:
    """The column cut to its day, under its own name."""
    return F.to_date(column).cast("timestamp_ntz").alias(column)


def buckets(as_of: dt.date) -> dict[str, Column]:
    """Days of the month of `as_of` and months elsewhere for disbursement; the days that
    periods ask for, and before and after them, for typing."""
    paid, typed = F.col(s.DISBURSED_ON), F.col(s.TYPED_ON)
    first, last = min(as_of.replace(day=1), as_of - dt.timedelta(days=6)), as_of + dt.timedelta(days=1)
    return {
        PAID: F.when(cal.within_month(paid, as_of), F.date_format(paid, "yyyy-MM-dd")).otherwise(F.col(s.MONTH)),
        TYPED: F.when(typed < cal.midnight(first), F.lit("antes"))
        .when(typed >= cal.midnight(last), F.lit("depois"))
        .otherwise(F.date_format(typed, "yyyy-MM-dd")),
    }


def cubes(df: DataFrame, as_of: dt.date, *names: str) -> DataFrame:
    """The cubes `names` (all without) in one table: one scan, one shuffle, one aggregate.

    `_cubo` tells them apart; `cube` takes one out. Rows have the columns of the enriched
    contracts. Their dates are the earliest of their group, which lies in the same bucket,
    so the metrics of a cube give the same over it and over the contracts.
    """
    chosen = names or tuple(CUBES)
    bucketed = df.withColumns(buckets(as_of))
    sets = [[k for k in CUBES[name] if k in bucketed.columns] for name in chosen]
    keys = list(dict.fromkeys(k for own in sets for k in own))
    # A number of its own for each cube, as two could have the same keys.
    marked = bucketed.withColumn(CUBE, F.explode(F.array(*[F.lit(name) for name in chosen])))
    own_key = [
        F.when(F.col(CUBE).isin(*[n for n, own in zip(chosen, sets) if k in own]), F.col(k)).alias(k) for k in keys
    ]
    dates = [F.min(c).alias(c) for c in (s.DISBURSED_ON, s.TYPED_ON)]
    table = marked.groupBy(CUBE, *own_key).agg(*dates, *summed())
    renamed = table.drop(*[c for c in (s.MONTH, s.COHORT, PAID, TYPED) if c in table.columns])
    return with_periods(renamed)


def cube(table: DataFrame, name: str) -> DataFrame:
    """One cube with its own keys."""
    keys = [k for k in CUBES[name] if k in table.columns and k not in (s.MONTH, s.COHORT)]
    columns = [*keys, s.DISBURSED_ON, s.TYPED_ON, s.N_ROWS, s.N_IDS, s.N_GROSS, s.GROSS, s.NET]
    return table.where(F.col(CUBE) == name).select(*columns, s.MONTH, s.COHORT, s.CATEGORY)
