"""Contracts with product and sales-hierarchy attributes, one row per contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions import cleaning as cl
from creditmill.functions.calendar import month_key
from creditmill.operators.align import clean_headers, regional_column
from creditmill.operators.dims import (
    BROADCAST_LIMIT_BYTES,
    keyed_join,
    measured_each,
    one_per_key,
)
from creditmill.operators.keys import first_per_key

BROKER_ATTRIBUTES = (
    s.BROKER, "Código Comercial", "Nome Comercial", "Código Regional", "Nome Regional",
)


def _integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def product_columns(tables: DataFrame) -> DataFrame:
    return tables.select(
        s.PRODUCT_KEY, *[c for c in (s.FUND, s.PRODUCT, s.BANK) if c in tables.columns]
    )


def product_dim(tables: DataFrame) -> DataFrame:
    _, *attributes = product_columns(tables).columns
    return one_per_key(tables, cl.text_key(F.col(s.PRODUCT_KEY)), attributes, "_table")


def broker_columns(broker: DataFrame) -> DataFrame:
    return broker.select(s.BROKER_KEY, *[c for c in BROKER_ATTRIBUTES if c in broker.columns])


def hierarchy_columns(hierarchy: DataFrame) -> DataFrame:
    named = clean_headers(hierarchy)
    found = regional_column(named.columns)
    if found in named.columns:
        named = named.withColumnRenamed(found, s.REGIONAL)
    return named.select(s.HIERARCHY_KEY, *[c for c in reversed(s.LEVELS) if c in named.columns])


def sales_dim(
    broker: DataFrame, hierarchy: DataFrame, integral: bool, null_keys_match: bool = False
) -> DataFrame:
    """Broker attributes and their hierarchy by broker code.

    The two are joined here, where both are small, so the contract table is
    joined once and not twice.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        key, *attributes = df.columns
        return one_per_key(df, cl.numeric_key(F.col(key), integral), attributes, name, null_keys_match)

    brokers = keyed(broker_columns(broker), "_broker")
    levels = keyed(hierarchy_columns(hierarchy), "_partner")
    code, partner = brokers["_broker"], levels["_partner"]
    condition = code.eqNullSafe(partner) if null_keys_match else code == partner
    return brokers.join(levels, condition, "left").drop(partner)


def attach_products(
    contracts: DataFrame, tables: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, size: int | None = None
) -> DataFrame:
    key = cl.text_key(F.col(s.TABLE_ID))
    return keyed_join(
        contracts, product_dim(tables), key, "_table", "left", limit, [product_columns(tables)], size=size
    ).drop("_table")


def attach_sales(
    contracts: DataFrame,
    broker: DataFrame,
    hierarchy: DataFrame,
    null_keys_match: bool = False,
    limit: int = BROADCAST_LIMIT_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Sales attributes; a contract without superintendent is the house's own."""
    integral = (
        _integral(contracts, s.BROKER_CODE)
        and _integral(broker, s.BROKER_KEY)
        and _integral(clean_headers(hierarchy), s.HIERARCHY_KEY)
    )
    key = cl.numeric_key(F.col(s.BROKER_CODE), integral)
    dim = sales_dim(broker, hierarchy, integral, null_keys_match)
    # Each row of either table appears in the joined one at most once.
    parts = [broker_columns(broker), hierarchy_columns(hierarchy)]
    joined = keyed_join(
        contracts, dim, key, "_broker", "left", limit, parts, null_keys_match, size
    ).drop("_broker")
    orphan = F.col(s.SUPERINTENDENT).isNull()
    names = [c for c in (s.BROKER, *reversed(s.LEVELS)) if c in joined.columns]
    return joined.withColumns(
        {c: F.when(orphan, F.lit(cl.INTERNAL_LABEL)).otherwise(F.col(c)) for c in names}
    )


def enrich_contracts(
    contracts: DataFrame,
    tables: DataFrame | None = None,
    broker: DataFrame | None = None,
    hierarchy: DataFrame | None = None,
    *,
    order: Sequence[str | Column] | None,
    null_keys_match: bool = False,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """The table every metric reads.

    `order` decides which row of a repeated contract id stays; make it total for
    repeatable results, or None where ids are unique. The duplicates go first: dimensions hold one row per key,
    so joining them afterwards gives the same rows and moves fewer. Dimensions
    that are left out leave out their attributes.
    """
    df = contracts if order is None else first_per_key(contracts, s.CCB, order)
    # The reference tables are measured together, by one job before the plan is made.
    products = [] if tables is None else [product_columns(tables)]
    sales = [] if broker is None or hierarchy is None else [broker_columns(broker), hierarchy_columns(hierarchy)]
    sizes = measured_each(products, sales) if products or sales else None
    if products:
        df = attach_products(df, tables, limit, sizes[0])
    if sales:
        df = attach_sales(df, broker, hierarchy, null_keys_match, limit, sizes[1])
    one = F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    counted = df.withColumns(
        {
            s.N_ROWS: one,
            s.N_IDS: F.when(F.col(s.CCB).isNotNull(), one).otherwise(none),
            s.N_GROSS: F.when(F.col(s.GROSS).isNotNull(), one).otherwise(none),
        }
    )
    return with_periods(counted)


def with_periods(df: DataFrame) -> DataFrame:
    """Month of disbursement, month of typing and status category."""
    return df.withColumns(
        {
            s.MONTH: month_key(F.col(s.DISBURSED_ON)),
            s.COHORT: month_key(F.col(s.TYPED_ON)),
            s.CATEGORY: cl.status_category(F.col(s.STATUS)),
        }
    )


def by_status() -> Column:
    """Disbursed by status alone."""
    return F.col(s.STATUS) == cl.DISBURSED


def is_disbursed() -> Column:
    """Disbursed by status and with a valid disbursement date."""
    return by_status() & F.col(s.DISBURSED_ON).isNotNull()


def disbursed(df: DataFrame) -> DataFrame:
    return df.where(is_disbursed())
