"""Who may read what: entitlement test and user roster."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill.operators.dims import keyed_join

# Roles that administer, and their order in the roster.
ADMIN_ROLES = ("owner", "admin")
OWNER_ROLE = "owner"


def entitled(df: DataFrame, key: str, readers: DataFrame, reader_key: str) -> DataFrame:
    """Rows whose key has an entry among `readers`."""
    keys = readers.select(F.col(reader_key).alias("_reader")).where("_reader is not null").distinct()
    return keyed_join(df, keys, df[key], "_reader", "left_semi", parts=[readers.select(reader_key)])


def is_admin(role: Column) -> Column:
    return F.coalesce(role.isin(*ADMIN_ROLES), F.lit(False))


def is_owner(role: Column) -> Column:
    return F.coalesce(role == OWNER_ROLE, F.lit(False))


def priority(c: Column, *first: str) -> Column:
    """Position among `first`, everything else after them."""
    place = F.when(F.lit(False), F.lit(0))
    for i, value in enumerate(first):
        place = place.when(c == value, F.lit(i))
    return place.otherwise(F.lit(len(first)))


def roster(
    profiles: DataFrame, accounts: DataFrame, now: dt.datetime, login: str = "login",
    role: str = "role", email: str = "email", until: str = "banned_until",
    order: tuple[str, ...] = ADMIN_ROLES, keep: tuple[str, ...] = ("nome",),
) -> DataFrame:
    """Every profile with its blocked flag, false when the account is unknown.

    Both sides have one row per login. A large account table is shuffled.
    """
    zone_free = isinstance(accounts.schema[until].dataType, T.TimestampNTZType)
    moment = F.lit(now.isoformat()).cast("timestamp_ntz") if zone_free else F.lit(now)
    blocked = accounts.select(
        F.col(email).alias("_email"), (F.col(until) > moment).alias("_blocked")
    )
    joined = profiles.join(blocked, profiles[login] == blocked["_email"], "left")
    return joined.select(
        login, *keep, role, F.coalesce("_blocked", F.lit(False)).alias("bloqueado")
    ).orderBy(priority(F.col(role), *order), login)
