import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmill.functions.cleaning import parse_timestamps
from creditmill.sources import jdbc

COLUMNS = [("id", "bigint"), ("data `pag`", "date"), ("criado", "timestamp"), ("valor", "decimal(18,2)")]


def test_dates_as_text_in_three_dialects():
    assert jdbc.dates_as_text_query("contrato", COLUMNS, "mysql") == (
        "SELECT `id`, CAST(`data ``pag``` AS CHAR) AS `data ``pag```, CAST(`criado` AS CHAR) AS `criado`, `valor` FROM contrato")
    assert jdbc.dates_as_text_query("contrato", COLUMNS, "postgresql") == (
        'SELECT "id", CAST("data `pag`" AS TEXT) AS "data `pag`", CAST("criado" AS TEXT) AS "criado", "valor" FROM contrato')
    assert jdbc.dates_as_text_query("contrato", COLUMNS, "sqlserver") == (
        "SELECT [id], CONVERT(VARCHAR(33), [data `pag`], 126) AS [data `pag`], CONVERT(VARCHAR(33), [criado], 126) AS [criado], [valor] FROM contrato")
    assert [jdbc.dialect(u) for u in ("jdbc:mariadb://h/db", "jdbc:postgresql://h/db", "jdbc:sqlserver://h")] == ["mysql", "postgresql", "sqlserver"]
    with pytest.raises(ValueError):
        jdbc.dialect("jdbc:oracle:thin:@h")


def test_server_texts_parse_and_zero_dates_are_null(spark):
    texts = ["0000-00-00", "0000-00-00 00:00:00", "2026-03-10", "2026-03-10 12:34:56", "2026-03-10T12:34:56.123", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    found = [r.d for r in parse_timestamps(df, "d").collect()]
    assert found == [None, None, dt.datetime(2026, 3, 10), dt.datetime(2026, 3, 10, 12, 34, 56),
                     dt.datetime(2026, 3, 10, 12, 34, 56, 123000), None]


def skewed(spark):
    rows = [(42,)] * 3000 + [(i,) for i in range(-2000, 4000)] + [(None,)] * 50
    return spark.createDataFrame(rows, "k bigint")


def matches(df, predicates):
    """Per row, how many predicates it meets (as Spark SQL reads the MySQL form)."""
    hits = sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates)
    return df.select(hits.alias("n"))


def test_key_ranges_are_complete_disjoint_and_balanced(spark):
    df = skewed(spark)
    predicates = jdbc.key_predicates(df, "k", 8, "mysql")
    assert predicates[-1] == "`k` IS NULL"
    assert {r.n for r in matches(df, predicates).collect()} == {1}
    sizes = [df.where(F.expr(p)).count() for p in predicates]
    assert sum(sizes) == df.count()
    hot = next(i for i, p in enumerate(predicates) if df.where(F.expr(p) & (F.col("k") == 42)).count())
    assert sizes[hot] >= 3000
    assert max(s for i, s in enumerate(sizes[:-1]) if i != hot) <= 2 * 9050 / 8


def test_key_listing_by_remainder_covers_negative_and_null_keys(spark):
    df = skewed(spark)
    assert {r.n for r in matches(df, jdbc.listing_predicates("k", 5, "mysql")).collect()} == {1}
    assert jdbc.listing_predicates("k", 2, "sqlserver") == ["ABS([k] % 2) = 0", "ABS([k] % 2) = 1", "[k] IS NULL"]


def test_one_part_and_text_keys(spark):
    df = skewed(spark)
    assert {r.n for r in matches(df, jdbc.key_predicates(df, "k", 1, "mysql")).collect()} == {1}
    with pytest.raises(TypeError):
        jdbc.key_predicates(spark.createDataFrame([("a",)], "k string"), "k", 4, "mysql")
