"""Number and date texts in the panel's locale (dot thousands, comma decimals)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _swapped(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def currency(c: Column) -> Column:
    """``-R$ 1.234,56``"""
    sign = F.when(c < 0, "-").otherwise("")
    return F.concat(sign, F.lit("R$ "), _swapped(F.format_number(F.abs(c), 2)))


def currency_short(c: Column) -> Column:
    """``R$ 1.23M`` from a million on (either sign), else ``R$ 123K``."""
    value = c.cast("double")
    millions = F.format_string("R$ %.2fM", F.bround(value / 1_000_000, 2))
    thousands = F.format_string("R$ %.0fK", F.bround(value / 1_000, 0))
    return F.when(F.abs(value) >= 1_000_000, millions).otherwise(thousands)


def thousands(c: Column) -> Column:
    """Whole part with dot separators, cut and not rounded."""
    return _swapped(F.format_number(c.cast("bigint"), 0))


def percentage(c: Column) -> Column:
    """``3.02%`` out of a share."""
    return F.format_string("%.2f%%", c.cast("double") * 100)


def day(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")
