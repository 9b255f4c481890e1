"""Small-table joins: one row per key, and a broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest measured dimension that is sent to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def measured_each(*groups: Sequence[DataFrame]) -> list[int]:
    """Payload size of the tables of each group together, all counted by one distributed
    aggregate with one result row."""
    widths = None
    for i, parts in enumerate(groups):
        for df in parts:
            width = F.lit(8 * len(df.columns))
            for field in df.schema.fields:
                if isinstance(field.dataType, T.StringType):
                    width = width + F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0))
            one = df.select(F.lit(i).alias("g"), width.cast("bigint").alias("n"))
            widths = one if widths is None else widths.union(one)
    sums = [F.coalesce(F.sum(F.when(F.col("g") == i, F.col("n"))), F.lit(0)) for i in range(len(groups))]
    return list(widths.agg(*[c.alias(f"n{i}") for i, c in enumerate(sums)]).first())


def measured_bytes(*parts: DataFrame) -> int:
    """Payload size of `parts` together."""
    return measured_each(parts)[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint when the measured size is within `limit`, `df` itself otherwise."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    key: Column,
    right_key: str,
    how: str,
    limit: int = BROADCAST_LIMIT_BYTES,
    parts: Sequence[DataFrame] = (),
    null_keys_match: bool = False,
    size: int | None = None,
) -> DataFrame:
    """Join to a table with one row per key, which is broadcast within `limit`.

    `parts` are measured in place of `right` where they are known to hold no less,
    which saves deriving it for that; `size` is what was measured already. Beyond the limit both sides are shuffled, and
    adaptive execution splits a key that has too many rows on the left.
    """
    def match(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_keys_match else a == b

    found = right[right_key]
    condition = match(key, found)
    if size is None:
        size = measured_bytes(*(parts or (right,)))
    if size <= limit:
        return left.join(F.broadcast(right), condition, how)
    # Adaptive execution splits only between two shuffles, and the table, grouped by
    # its key, would need none. The second key says nothing new but asks for one.
    return left.join(right, condition & match(F.xxhash64(key), F.xxhash64(found)), how)


def one_per_key(
    df: DataFrame, key: Column, attributes: Sequence[str], key_name: str, keep_null_key: bool = False
) -> DataFrame:
    """One row per key with the smallest attribute tuple.

    An aggregate, so Catalyst knows that the key is unique and drops a left join
    to this table from every plan that reads none of its attributes.
    """
    keyed = df.select(key.alias(key_name), *attributes)
    if not keep_null_key:
        keyed = keyed.where(F.col(key_name).isNotNull())
    packed = keyed.groupBy(key_name).agg(F.min(F.struct(*attributes)).alias("_attributes"))
    return packed.select(key_name, "_attributes.*")
