"""Aggregates and ratios the metrics share.

Counts are sums of the counts each row carries, so a metric gives the same result
over enriched contracts and over the cubes they were folded to. Amounts are
summed as decimals, so a result does not depend on the order in which partitions
arrive. Ratios are taken in double and rounded half-even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditmill.schema import GROSS, N_IDS, N_ROWS, NET, TOTAL


def total(c: Column) -> Column:
    """Sum of amounts, rounded half-even after it, 0 when there is nothing to add."""
    return F.bround(F.coalesce(F.sum(c), F.lit(0)), 2).cast(TOTAL)


def total_where(condition: Column, c: Column) -> Column:
    return total(F.when(condition, c))


def counted(counter: str = N_ROWS) -> Column:
    return F.coalesce(F.sum(counter), F.lit(0))


def count_where(condition: Column, counter: str = N_ROWS) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(counter))), F.lit(0))


def production(counter: str = N_IDS) -> list[Column]:
    """Contracts `C`, gross `B` and net `L`."""
    return [counted(counter).alias("C"), total(F.col(GROSS)).alias("B"), total(F.col(NET)).alias("L")]


def production_parts(counter: str = N_IDS) -> list[Column]:
    """`C`, `B`, `L` of groups that are merged further, so amounts are not rounded yet."""
    return [counted(counter).alias("C"), F.sum(GROSS).alias("B"), F.sum(NET).alias("L")]


def merged_production() -> list[Column]:
    """`C`, `B`, `L` of groups that already hold them."""
    return [F.sum("C").alias("C"), total(F.col("B")).alias("B"), total(F.col("L")).alias("L")]


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double, 0 unless the denominator is positive."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def percent(numerator: Column, denominator: Column, places: int = 1) -> Column:
    return F.bround(ratio(numerator, denominator) * 100, places)


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    return F.bround(ratio(numerator, denominator), 0).cast("bigint")
