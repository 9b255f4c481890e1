import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill.functions import calendar as cal
from creditmill.functions import cleaning as cl
from creditmill.functions import display
from creditmill.functions import measures as ms

DATES = {
    "2026-01-02": dt.datetime(2026, 1, 2),
    " 2026-01-02 10:11:12.123456 ": dt.datetime(2026, 1, 2, 10, 11, 12, 123456),
    "2026-01-02T03:04:05Z": dt.datetime(2026, 1, 2, 3, 4, 5),
    "2026-01-02T03:04": dt.datetime(2026, 1, 2, 3, 4),
    "2026-01-02T03:04Z": dt.datetime(2026, 1, 2, 3, 4),
    "2026-01-02 23:30:00-03:00": dt.datetime(2026, 1, 3, 2, 30),
    "2026-01-02T03:04:05+0000": dt.datetime(2026, 1, 2, 3, 4, 5),
    "2026-01-02 03:04:05-03": dt.datetime(2026, 1, 2, 6, 4, 5),
    "31/12/2025": dt.datetime(2025, 12, 31),
    "5/6/2026": dt.datetime(2026, 6, 5),
    "31/12/2025 07:05": dt.datetime(2025, 12, 31, 7, 5),
    "31.12.2025": dt.datetime(2025, 12, 31),
    "2026/1/2": dt.datetime(2026, 1, 2),
    "20260102": dt.datetime(2026, 1, 2),
    "31/12/25": dt.datetime(2025, 12, 31),
    "1/2/70 07:05": dt.datetime(1970, 2, 1, 7, 5),
    "05 Jan 2026": dt.datetime(2026, 1, 5),
    "5 december 2025 10:20": dt.datetime(2025, 12, 5, 10, 20),
    "Jan 5, 2026": dt.datetime(2026, 1, 5),
    "September 30 2025 11:20 pm": dt.datetime(2025, 9, 30, 23, 20),
    "20260511103000": dt.datetime(2026, 5, 11, 10, 30),
    "2026-05-11 10:20:30 PM": dt.datetime(2026, 5, 11, 22, 20, 30),
    "11/05/2026 12:00 AM": dt.datetime(2026, 5, 11), "5 Foo 2026": None, "FM": None,
    "2018-11-04": dt.datetime(2018, 11, 4),  # midnight that São Paulo's clocks skip
    "0000-00-00": None, "0000-00-00 00:00:00": None, "": None, "lixo": None, None: None,
    "NaT": None, "10:20": None, "31/31/2025": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(v, v) for v in DATES], "v string, t string")
        found = {r.v: r.t for r in cl.parse_timestamps(df, "t").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == DATES


def test_dates_of_other_types(spark):
    df = spark.sql(
        "SELECT DATE'2026-01-02' AS a, TIMESTAMP_NTZ'2026-01-02 03:04:05' AS b, "
        "TIMESTAMP'2026-01-02 03:04:05+02:00' AS c"
    )
    assert tuple(cl.parse_timestamps(df, "a", "b", "c").first()) == (
        dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5), dt.datetime(2026, 1, 2, 1, 4, 5),
    )


def test_numbers(spark):
    df = spark.createDataFrame([(" 13 ",), ("1e3",), ("x",), ("nan",), (None,)], "v string")
    text = T.StringType()
    rows = df.select(cl.number(F.col("v")), cl.money(F.col("v"), text)).collect()
    assert [tuple(r) for r in rows] == [
        (13.0, Decimal("13.00")), (1000.0, Decimal("1000.00")), (None, None), (None, None), (None, None),
    ]


def test_amounts_keep_their_places_and_size(spark):
    df = spark.createDataFrame([("1.005",), ("1.005",), ("10000000000000000",)], "v string")
    found = df.select(cl.money(F.col("v"), T.StringType()).alias("v"))
    assert found.where("v < 2").agg(ms.total(F.col("v"))).first()[0] == Decimal("2.01")
    assert found.agg(F.max("v")).first()[0] == 10**16
    halves = spark.createDataFrame([("0.125",), ("0.375",)], "v string").select(cl.money(F.col("v"), T.StringType()).alias("v"))
    assert [r[0] for r in halves.groupBy("v").agg(ms.total(F.col("v")).alias("t")).orderBy("v").select("t").collect()] == [
        Decimal("0.12"), Decimal("0.38")]


def test_table_keys(spark):
    df = spark.createDataFrame([(" AB1 ",), ("123.0",), ("nan",), ("None",), (None,), ("v1.0",), ("v1",), ("tab.0",)], "v string")
    found = [r[0] for r in df.select(cl.text_key(F.col("v"))).collect()]
    assert found == ["ab1", "123", None, None, None, "v1.0", "v1", "tab.0"]


def test_status_labels(spark):
    df = spark.createDataFrame([("disbursed",), ("FOO",), (None,)], "v string")
    assert [r[0] for r in df.select(cl.translate_status(F.col("v"))).collect()] == [
        "Desembolsado", "FOO", None,
    ]


def test_status_categories_take_the_first_rule_that_fits(spark):
    wanted = {
        "Desembolsado": "Desembolsado",
        "Cancelado": "Cancelado",
        "Assinatura aprovada": "Ag. Assinatura",
        "Aguardando análise de assinatura": "Ag. Assinatura",
        "Integrada no banco": "Ag. Desembolso",
        "Aguardando desembolso": "Ag. Desembolso",
        "Rejeitada pela análise de risco": "Em Analise",
        "Em averbação": "Em Averbacao",
        "Expirado": "Outros",
        None: "Outros",
    }
    df = spark.createDataFrame([(k,) for k in wanted], "v string")
    found = {r.v: r.c for r in df.select("v", cl.status_category(F.col("v")).alias("c")).collect()}
    assert found == wanted


def test_names(spark):
    df = spark.createDataFrame([("10 - A - B",), ("Solo",), ("12345",), ("123456",), (None,)], "v string")
    rows = df.select(cl.after_prefix(F.col("v")), cl.valid_name(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [
        ("A - B", True), ("Solo", False), ("12345", False), ("123456", True), (None, None),
    ]


def test_table_label(spark):
    df = spark.createDataFrame([("T", None), ("T", "F"), ("T", " F "), ("T", "nan")], "t string, f string")
    found = [r[0] for r in df.select(cl.table_label(F.col("t"), F.col("f"))).collect()]
    assert found == ["T", "T - F", "T - F", "T"]


def test_month_labels(spark):
    df = spark.createDataFrame([("2026-01",), ("2026-13",), ("x",), (None,)], "v string")
    found = [r[0] for r in df.select(cal.month_label(F.col("v"))).collect()]
    assert found == ["Jan/26", "13/26", "x", None]


def test_business_days(spark):
    df = spark.sql("SELECT explode(sequence(DATE'1999-01-01', DATE'2028-12-31')) AS d").select(
        "d", cal.business_days_total(F.col("d")).alias("tot"), cal.business_days_elapsed(F.col("d")).alias("el")
    )
    found = {r.d: (r.tot, r.el) for r in df.collect()}
    assert found[dt.date(2026, 12, 1)] == (23, 1)
    assert found[dt.date(2026, 8, 1)] == (21, 0)
    assert found[dt.date(2024, 2, 29)] == (21, 21)
    assert found[dt.date(2001, 7, 17)] == (22, 12)
    for day, (total, elapsed) in found.items():
        month = [d for d in found if (d.year, d.month) == (day.year, day.month)] if day.day == 1 else None
        if month:
            weekdays = sorted(d for d in month if d.weekday() < 5)
            assert total == len(weekdays)
            assert all(found[d][1] == sum(w <= d for w in weekdays) for d in month)


def test_display(spark):
    df = spark.createDataFrame(
        [(Decimal("1234567.89"),), (Decimal("-1234.50"),), (Decimal("0.00"),)], "v decimal(18,2)"
    )
    v = F.col("v")
    rows = df.select(display.currency(v), display.currency_short(v), display.thousands(v)).collect()
    assert [tuple(r) for r in rows] == [
        ("R$ 1.234.567,89", "R$ 1.23M", "1.234.567"),
        ("-R$ 1.234,50", "R$ -1K", "-1.234"),
        ("R$ 0,00", "R$ 0K", "0"),
    ]
    one = spark.sql("SELECT 0.030183D AS p, DATE'2026-05-11' AS d")
    assert tuple(one.select(display.percentage(F.col("p")), display.day(F.col("d"))).first()) == (
        "3.02%", "11/05/2026",
    )
