"""First row per key, top rows and top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in `order`; rows without a key count as one key.

    The rank filter lets Spark keep one row per key in each task before the
    shuffle, so a key that holds a large part of the table stays harmless.
    """
    by_key = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by_key)).where("_rank = 1").drop("_rank")


def top_rows(df: DataFrame, n: int, measure: str, name: str) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(name)).limit(n)


def top_rows_per_group(
    df: DataFrame, groups: Sequence[str], limits: int | dict[str, int], measure: str, name: str
) -> DataFrame:
    """Top rows of every group by `measure`, ties by `name`.

    `limits` is one number, or a number for each value of the last group column.
    """
    ranked = df.withColumn(
        "_rank",
        F.row_number().over(W.partitionBy(*groups).orderBy(F.desc(measure), F.asc(name))),
    )
    if isinstance(limits, int):
        return ranked.where(F.col("_rank") <= limits).drop("_rank")
    per_value = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    return ranked.where(
        (F.col("_rank") <= max(limits.values()))
        & (F.col("_rank") <= F.try_element_at(per_value, F.col(groups[-1])))
    ).drop("_rank")
