"""Database reads beyond the plain scan: date columns as text for any driver, and key
ranges balanced by the key's quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditmill.functions.cleaning import parse_timestamps
from creditmill.sources.readers import jdbc_options

# URL prefixes of the drivers, and the Spark types that come from date columns.
DIALECTS = {"jdbc:mysql:": "mysql", "jdbc:mariadb:": "mysql", "jdbc:postgresql:": "postgresql", "jdbc:sqlserver:": "sqlserver"}
DATE_TYPES = ("date", "timestamp", "timestamp_ntz")


def dialect(url: str) -> str:
    for prefix, name in DIALECTS.items():
        if url.startswith(prefix):
            return name
    raise ValueError(f"no dialect known for {url.split('//')[0]}")


def quoted(name: str, dialect_name: str) -> str:
    """An identifier as the dialect quotes it, its quote characters doubled."""
    if dialect_name == "mysql":
        return "`" + name.replace("`", "``") + "`"
    if dialect_name == "sqlserver":
        return "[" + name.replace("]", "]]") + "]"
    return '"' + name.replace('"', '""') + '"'


def as_text(name: str, dialect_name: str) -> str:
    """A date or time column as the server writes it, so that no driver has to make a
    date of it: zero dates of MySQL come through as their text. SQL Server writes ISO 8601."""
    column = quoted(name, dialect_name)
    if dialect_name == "sqlserver":
        return f"CONVERT(VARCHAR(33), {column}, 126) AS {column}"
    kind = "CHAR" if dialect_name == "mysql" else "TEXT"
    return f"CAST({column} AS {kind}) AS {column}"


def dates_as_text_query(table: str, columns: Sequence[tuple[str, str]], dialect_name: str) -> str:
    """SELECT of all `columns` (name, Spark type as `dtypes` gives it), the date-like ones as text."""
    parts = [as_text(name, dialect_name) if kind in DATE_TYPES else quoted(name, dialect_name) for name, kind in columns]
    return f"SELECT {', '.join(parts)} FROM {table}"


def read_jdbc_dates_as_text(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """All rows of a table with date columns read as text by the server and parsed here
    (`parse_timestamps`): a date that the server holds but no calendar has, such as
    0000-00-00, becomes null, with any driver. The column types come from Spark's own
    discovery, which asks the server for none of the rows."""
    discovered = spark.read.format("jdbc").options(**jdbc_options(url, table, zero_dates=False)).load().dtypes
    query = dates_as_text_query(table, discovered, dialect(url))
    df = spark.read.format("jdbc").options(**jdbc_options(url, f"({query}) AS t", zero_dates=False, **options)).load()
    return parse_timestamps(df, *[name for name, kind in discovered if kind in DATE_TYPES])


def literal(value) -> str:
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return repr(value)


def key_predicates(keys: DataFrame, column: str, parts: int, dialect_name: str, relative_error: float = 0.001) -> list[str]:
    """WHERE clauses that split a numeric key into about `parts` ranges of equal rows.

    The cuts are Spark's quantile sketch over a listing of the key. Ranges are
    [cut i, cut i+1), open at both ends, and one more clause takes the nulls, so every
    row falls in exactly one. Equal cuts merge: a value that holds more than a part's
    share of the rows has a range to itself.
    """
    kind = keys.schema[column].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{column} is {kind.simpleString()}, not a number")
    probabilities = [i / parts for i in range(1, parts)]
    cuts = sorted(set(keys.approxQuantile(column, probabilities, relative_error))) if parts > 1 else []
    key = quoted(column, dialect_name)
    if not cuts:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    bounds = [literal(c) for c in cuts]
    ranges = [f"{key} < {bounds[0]}"]
    ranges += [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    ranges += [f"{key} >= {bounds[-1]}", f"{key} IS NULL"]
    return ranges


def listing_predicates(column: str, parts: int, dialect_name: str) -> list[str]:
    """Clauses that split a listing of an integer key by remainder, so that reading the
    key for its quantiles is itself spread over `parts` connections."""
    key = quoted(column, dialect_name)
    remainder = f"ABS({key} % {parts})" if dialect_name == "sqlserver" else f"ABS(MOD({key}, {parts}))"
    return [f"{remainder} = {i}" for i in range(parts)] + [f"{key} IS NULL"]


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, parts: int, properties: dict[str, str] | None = None) -> DataFrame:
    """All rows of a table in about `parts` reads of equal rows, cut at the quantiles of
    an integer key; rows whose key is null are one more read."""
    name = dialect(url)
    props = {"fetchsize": "10000", **(properties or {})}
    listing = spark.read.jdbc(url, f"(SELECT {quoted(column, name)} FROM {table}) AS k",
                              predicates=listing_predicates(column, parts, name), properties=props)
    return spark.read.jdbc(url, table, predicates=key_predicates(listing, column, parts, name), properties=props)
