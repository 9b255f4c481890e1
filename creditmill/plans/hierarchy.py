"""Rankings and series over superintendent, regional, commercial and partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as s
from creditmill.functions import cleaning as cl
from creditmill.functions import measures as ms
from creditmill.operators.enrich import disbursed
from creditmill.operators.keys import top_rows, top_rows_per_group

# Rows kept per level.
LEVEL_LIMITS = {s.SUPERINTENDENT: 10, s.REGIONAL: 20, s.COMMERCIAL: 40, s.PARTNER: 30}


def _chains(df: DataFrame, *keys: str) -> DataFrame:
    """Production per full hierarchy path: the contracts are read and shuffled once,
    and the four levels are folded out of this much smaller table."""
    return (
        disbursed(df)
        .groupBy(*keys, *s.LEVELS)
        .agg(*ms.production_parts(s.N_GROSS), F.min(s.DISBURSED_ON).alias("_first"))
    )


def _levels(chains: DataFrame, *keys: str) -> DataFrame:
    """Production per level and name, with the attributes a partner was first seen with.

    The earliest disbursement decides, equal dates by name.
    """
    ids = [*keys, *[F.col(c).alias(f"_{c}") for c in s.LEVELS], "C", "B", "L", "_first"]
    long = (
        chains.select(*ids, F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("nivel"), F.col(c).alias("nome")) for c in s.LEVELS
            ])
        ).alias("_level"))
        .select("*", "_level.nivel", "_level.nome")
        .where(cl.valid_name(F.col("nome")))
    )
    seen = F.struct(
        "_first", *[F.col(f"_{c}").alias(c) for c in s.LEVELS if c != s.PARTNER]
    )
    return long.groupBy(*keys, "nivel", "nome").agg(
        *ms.merged_production(), F.min(F.when(F.col("nivel") == s.PARTNER, seen)).alias("_seen")
    )


def _ranked(df: DataFrame, *keys: str) -> DataFrame:
    levels = _levels(_chains(df, *keys), *keys)
    top = top_rows_per_group(levels, [*keys, "nivel"], LEVEL_LIMITS, "B", "nome")
    parents = [F.col(f"_seen.{c}").alias(c) for c in s.LEVELS if c != s.PARTNER]
    return top.select(*keys, "nivel", "nome", "C", "B", "L", *parents)


def level_rankings(df: DataFrame) -> DataFrame:
    """Top names of all four levels; partner rows carry their hierarchy."""
    return _ranked(df)


def level_rankings_product(df: DataFrame) -> DataFrame:
    return _ranked(df.where(cl.known_name(F.col(s.PRODUCT)).isNotNull()), s.PRODUCT)


def rank_partner_enriched(df: DataFrame, n: int = LEVEL_LIMITS[s.PARTNER]) -> DataFrame:
    """Top partners with the superintendent, regional and commercial first seen."""
    partners = _levels(_chains(df)).where(F.col("nivel") == s.PARTNER)
    top = top_rows(partners, n, "B", "nome")
    parents = [F.col(f"_seen.{c}").alias(c) for c in (s.SUPERINTENDENT, s.REGIONAL, s.COMMERCIAL)]
    return top.select(F.col("nome").alias(s.PARTNER), "C", "B", "L", *parents)


def _level_month(df: DataFrame, level: str, *keys: str) -> DataFrame:
    valid = disbursed(df).where(cl.valid_name(F.col(level)))
    return valid.groupBy(*keys, level, s.MONTH).agg(*ms.production(s.N_GROSS))


def sup_month(df: DataFrame) -> DataFrame:
    return _level_month(df, s.SUPERINTENDENT)


def reg_month(df: DataFrame) -> DataFrame:
    return _level_month(df, s.REGIONAL)


def sup_month_product(df: DataFrame) -> DataFrame:
    known = df.where(cl.known_name(F.col(s.PRODUCT)).isNotNull())
    return _level_month(known, s.SUPERINTENDENT, s.PRODUCT)


def reg_month_product(df: DataFrame) -> DataFrame:
    known = df.where(cl.known_name(F.col(s.PRODUCT)).isNotNull())
    return _level_month(known, s.REGIONAL, s.PRODUCT)


def partner_month(df: DataFrame, n: int = LEVEL_LIMITS[s.PARTNER]) -> DataFrame:
    """Monthly production of every partner that is in the overall top `n` or in the
    top `n` of any month, amounts rounded to whole units.

    Three branches read the partner-month totals; their exchange is reused, so these are
    computed once. The kept names are at most `n` per month plus `n`, which bounds the
    broadcast.
    """
    cells = _level_month(df, s.PARTNER)
    monthly = top_rows_per_group(cells, [s.MONTH], n, "B", s.PARTNER).select(s.PARTNER)
    overall = top_rows(
        cells.groupBy(s.PARTNER).agg(F.sum("B").alias("B")), n, "B", s.PARTNER
    ).select(s.PARTNER)
    kept = F.broadcast(monthly.union(overall).distinct())
    return cells.join(kept, s.PARTNER, "left_semi").select(
        s.PARTNER, s.MONTH, "C",
        F.bround("B", 0).cast("bigint").alias("B"), F.bround("L", 0).cast("bigint").alias("L"),
    )
