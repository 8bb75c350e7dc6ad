"""Number labels. ``format_number`` rounds half to even on the exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(c: Column) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(c, 0)


def one_decimal(c: Column) -> Column:
    """66.25 -> '66.2', without a thousands separator."""
    return F.replace(F.format_number(c, 1), F.lit(","), F.lit(""))


def currency(c: Column, symbol: str = "€") -> Column:
    """1234.6 -> '€1,235'."""
    return F.concat(F.lit(symbol), F.format_number(c, 0))
