"""From a discovered source schema to the canonical contract table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions import cleaning as cl


def clean_headers(df: DataFrame) -> DataFrame:
    """Column names without byte-order mark and outer blanks."""
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])


def regional_column(columns: list[str]) -> str:
    """First column whose name speaks of a region and is no code."""
    for name in columns:
        lowered = name.lower()
        if "reg" in lowered and "cod" not in lowered and name != s.HIERARCHY_KEY:
            return name
    return s.REGIONAL


def _typed(df: DataFrame, source: str, target: T.StructField) -> Column:
    c = df[f"`{source}`"]
    found = df.schema[source].dataType
    if isinstance(target.dataType, T.TimestampNTZType):
        return c
    if isinstance(target.dataType, T.DecimalType):
        return cl.money(c, found)
    if target.name == s.STATUS:
        return cl.translate_status(c.cast("string"))
    if target.name == s.BROKER_CODE and not isinstance(found, T.IntegralType):
        return cl.number(c)
    if isinstance(target.dataType, T.IntegerType):
        return cl.number(c).try_cast("int")
    return c if target.name == s.BROKER_CODE else c.cast(target.dataType)


def contract_sources(columns: list[str]) -> dict[str, list[str]]:
    """Canonical column -> the columns of the source that it is read from. One that is not
    in it has no source; if only canonical names are, no column was renamed."""
    sources = {name: [name] for name in s.CONTRACT.names if name in columns}
    for source, target in {**s.SOURCE_ALIASES, "fundo": s.FUND_RAW}.items():
        if source in columns and target not in columns:
            sources.setdefault(target, []).append(source)
    return sources


def resolve_contracts(df: DataFrame) -> DataFrame:
    """Canonical contract table out of a raw one, by projections alone.

    Renames database columns, translates statuses, parses dates and amounts,
    adds what is missing as typed nulls and carries unknown columns through last.
    A source without any typing date counts a contract as typed when it was disbursed,
    so cohorts and periods go by that date.
    A raw ``fundo`` becomes ``fundo_raw``: Spark does not tell it from ``Fundo``.
    """
    df = clean_headers(df)
    present = list(df.columns)
    sources = contract_sources(present)
    if s.TYPED_ON not in sources and s.DISBURSED_ON in sources:
        sources[s.TYPED_ON] = sources[s.DISBURSED_ON]
    dates = [f.name for f in s.CONTRACT.fields if isinstance(f.dataType, T.TimestampNTZType)]
    df = cl.parse_timestamps(df, *[source for name in dates for source in sources.get(name, [])])
    canonical = []
    for field in s.CONTRACT.fields:
        parts = [_typed(df, source, field) for source in sources.get(field.name, [])]
        value = F.coalesce(*parts) if parts else F.lit(None).cast(field.dataType)
        canonical.append(value.alias(field.name))
    used = {source for names in sources.values() for source in names}
    extras = [
        df[f"`{name}`"].alias(s.COLLISIONS.get(name, name)) for name in present if name not in used
    ]
    return df.select(*canonical, *extras)


def align_to(df: DataFrame, reference: T.StructType) -> DataFrame:
    """Reference columns first and in their order, missing ones null, extras last."""
    ordered = [
        F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in reference.fields
    ]
    extras = [F.col(f"`{c}`") for c in df.columns if c not in reference.names]
    return df.select(*ordered, *extras)
