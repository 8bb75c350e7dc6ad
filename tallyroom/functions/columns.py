"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and parentheses included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def known(df: DataFrame, name: str) -> Column:
    """True where the value is neither null nor NaN.

    Written as a conjunction with ``isNotNull`` first, because that part reaches
    the Parquet reader as a pushed filter; ``dropna`` does not.
    """
    c = col(name)
    return c.isNotNull() & ~F.isnan(c) if is_float(df, name) else c.isNotNull()


def nan_as_null(df: DataFrame, name: str) -> Column:
    """The column with NaN read as null, so that aggregates skip it."""
    c = col(name)
    if not is_float(df, name):
        return c
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType))


def nans_to_nulls(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The frame with NaN replaced by null in the named, or in all, float columns."""
    names = df.columns if names is None else names
    floats = {name: nan_as_null(df, name) for name in names if is_float(df, name)}
    return df.withColumns(floats) if floats else df
