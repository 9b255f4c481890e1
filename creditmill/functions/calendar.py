"""Month keys, labels and business days as column expressions, and a working calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Month number -> short name in the panel's language.
MONTH_NAMES = {
    "01": "Jan", "02": "Fev", "03": "Mar", "04": "Abr", "05": "Mai", "06": "Jun",
    "07": "Jul", "08": "Ago", "09": "Set", "10": "Out", "11": "Nov", "12": "Dez",
}


def day_literal(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def within_day(c: Column, day: dt.date) -> Column:
    """A plain range, so that a scan can skip what lies outside."""
    return (c >= midnight(day)) & (c < midnight(day + dt.timedelta(days=1)))


def within_month(c: Column, day: dt.date) -> Column:
    first = day.replace(day=1)
    after = (first + dt.timedelta(days=31)).replace(day=1)
    return (c >= midnight(first)) & (c < midnight(after))


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_of(day: dt.date) -> str:
    return f"{day:%Y-%m}"


def month_label(c: Column) -> Column:
    """``Jan/26`` out of ``2026-01``; text of another shape is unchanged."""
    parts = F.split(c, "-")
    names = F.create_map(*[F.lit(x) for pair in MONTH_NAMES.items() for x in pair])
    month = F.get(parts, F.lit(1))
    label = F.concat(
        F.coalesce(F.try_element_at(names, month), month),
        F.lit("/"),
        F.substring(F.get(parts, F.lit(0)), 3, 10),
    )
    return F.when(F.size(parts) == 2, label).otherwise(c)


def _weekdays_until(day: Column) -> Column:
    """Mondays to Fridays from Monday 1970-01-05 to `day`, inclusive."""
    since = F.date_diff(day, F.lit("1970-01-05").cast("date"))
    weeks = F.floor(since / F.lit(7))
    return weeks * 5 + F.least(F.pmod(since, F.lit(7)) + 1, F.lit(5))


def business_days_total(day: Column) -> Column:
    """Mondays to Fridays in the month of `day`."""
    before = F.date_sub(F.trunc(day, "MM"), 1)
    return (_weekdays_until(F.last_day(day)) - _weekdays_until(before)).cast("bigint")


def business_days_elapsed(day: Column) -> Column:
    """Mondays to Fridays from the first of the month to `day`, inclusive."""
    before = F.date_sub(F.trunc(day, "MM"), 1)
    return (_weekdays_until(day) - _weekdays_until(before)).cast("bigint")


# National holidays of fixed date (month-day), in calendar order.
FIXED_HOLIDAYS = ("01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25")


def working_calendar(spark: SparkSession, first: dt.date, last: dt.date, holidays: DataFrame | None = None,
                     fixed: Sequence[str] = FIXED_HOLIDAYS) -> DataFrame:
    """dia, util, acumulado: every day from `first` to `last`; a working day is Monday to
    Friday and neither a date of `holidays` (a table with a date column `dia`) nor one of
    the `fixed` month-days; `acumulado` counts working days up to the day, inclusive.

    One row per calendar day, so its size is bound by the span and not by any data; the
    running count is a window over that alone."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("dia"))
    off = F.date_format("dia", "MM-dd").isin(list(fixed)) | (F.dayofweek("dia").isin(1, 7))
    if holidays is not None:
        listed = holidays.select(F.col("dia").cast("date").alias("_feriado")).distinct()
        days = days.join(F.broadcast(listed), F.col("dia") == F.col("_feriado"), "left")
        off = off | F.col("_feriado").isNotNull()
    flagged = days.select("dia", (~off).alias("util"))
    running = F.sum(F.col("util").cast("long")).over(Window.orderBy("dia").rowsBetween(Window.unboundedPreceding, 0))
    return flagged.select("dia", "util", running.alias("acumulado"))


def with_working_days(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """`df` with tdu (working days of the month of `day`) and pdu (from the first of the
    month to `day`, inclusive): two look-ups of running counts per range, no day-by-day
    sum. The calendar must span the day before each month to its last day."""
    at = calendar.select(F.col("dia").alias("_d"), F.col("acumulado").alias("_a"))
    looked = (
        df.withColumn("_antes", F.date_sub(F.trunc(F.col(day), "MM"), 1)).withColumn("_fim", F.last_day(F.col(day)))
        .join(F.broadcast(at.toDF("_d1", "_upto")), F.col(day) == F.col("_d1"), "left")
        .join(F.broadcast(at.toDF("_d2", "_before")), F.col("_antes") == F.col("_d2"), "left")
        .join(F.broadcast(at.toDF("_d3", "_month")), F.col("_fim") == F.col("_d3"), "left")
    )
    return looked.withColumns({
        "tdu": (F.col("_month") - F.col("_before")).cast("bigint"),
        "pdu": (F.col("_upto") - F.col("_before")).cast("bigint"),
    }).drop("_antes", "_fim", "_d1", "_upto", "_d2", "_before", "_d3", "_month")
