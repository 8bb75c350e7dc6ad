"""Select, rename, conform and drop incomplete rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Column, Contract
from ..errors import MissingColumnsError
from ..functions.columns import col, known, nans_to_nulls
from .filters import all_of


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame itself, or one error that names every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns: {', '.join(missing)}")
    return df


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names."""
    require_columns(df, mapping)
    return df.select(*[col(old) for old in mapping]).withColumnsRenamed(dict(mapping))


def drop_incomplete(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Drop rows with null or NaN in any required column."""
    return df.where(all_of([known(df, name) for name in required]))


def conform(df: DataFrame, columns: Iterable[Column]) -> DataFrame:
    """Project to declared columns and types; a value that cannot be read is null."""
    columns = list(columns)
    require_columns(df, [c.name for c in columns])
    return df.select(*[typed(df, c).alias(c.name) for c in columns])


# The words a cast to a floating type accepts, in any case.
_NUMBER_WORDS = ("nan", "inf", "infinity")


def typed(df: DataFrame, target: Column) -> SparkColumn:
    """A column in its declared type; null where the value cannot be read as such."""
    c = col(target.name)
    source, kind = df.schema[target.name].dataType, target.spark_type
    if source == kind:
        return c
    # A cast that fails costs a Java exception per row, so text that cannot be a
    # number is told by its first byte: signs, digits and blanks sort before ':'.
    # Bytes are compared as bytes, whatever the collation of the text.
    numeric_text = isinstance(source, T.StringType) and isinstance(kind, T.NumericType)
    possible = c.cast("binary") < F.lit(b":")
    if isinstance(kind, T.IntegralType) and not isinstance(source, T.IntegralType):
        # Files written from a nullable integer column hold 70.0: round it to the
        # integer, half to even, as a database does on assignment. Decimals are rounded as
        # decimals: a double holds no integer beyond 2^53 exactly.
        if isinstance(source, T.DecimalType):
            return F.bround(c, 0).try_cast(target.type)
        rounded = F.rint(c.try_cast("double")).try_cast(target.type)
        if not numeric_text:
            return rounded
        exact = F.bround(c.try_cast("decimal(38,18)"), 0).try_cast(target.type)
        return F.when(possible, F.when(c.contains("."), F.coalesce(exact, rounded))
                      .otherwise(F.coalesce(c.try_cast(target.type), rounded)))
    if numeric_text:
        words = F.lower(F.trim(F.collate(c, "UTF8_BINARY")))
        return F.when(possible | words.isin(*_NUMBER_WORDS), c.try_cast(target.type))
    return c.try_cast(target.type)


def clean(df: DataFrame, contract: Contract) -> DataFrame:
    """Raw frame -> typed, renamed, complete rows. One narrow stage, no shuffle."""
    named = select_renamed(df, contract.headers)
    typed = conform(named, contract.columns)
    return nans_to_nulls(drop_incomplete(typed, contract.required))
