"""Columns by exact name, and small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of all contracts: space and the ASCII controls tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, whatever else the table holds.

    A name is matched exactly first, so a second column that differs in case only
    does no harm; a column that is missing is an error.
    """
    found = []
    for name in names:
        places = [i for i, c in enumerate(df.columns) if c == name] or [
            i for i, c in enumerate(df.columns) if c.lower() == name.lower()
        ]
        if not places:
            raise ValueError(f"no column {name!r} among {df.columns}")
        found.append(places[0])
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in zip(found, names)])


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")
