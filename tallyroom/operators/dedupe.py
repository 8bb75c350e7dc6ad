"""Exactly one row per key, and distinct rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, known, nans_to_nulls
from .filters import all_of

_RANK = "__rank"


def keep_best(df: DataFrame, keys: Sequence[str], highest: Sequence[str],
              tie_break: Iterable[str] | None = None) -> DataFrame:
    """Keep the row with the highest values per key, in one deterministic choice.

    Order: ``highest`` descending with unknowns last (a NaN there becomes null),
    then ``tie_break``, then every other column, ascending with unknowns last. Only
    rows that are equal in full can tie, so partitioning never changes the result.

    Numeric ratings run as one aggregate, the least (order, row) struct per key:
    each map task sorts by the key alone and ships one row per key, so a key that
    holds a third of all rows reaches its reducer as one row per map task. Other
    types take ``keep_ranked``, which sorts by key and order.
    """
    rest = _tie_columns(df, keys, highest, tie_break)
    numeric = all(isinstance(df.schema[c].dataType, T.NumericType) for c in highest)
    if not numeric or not all(_orderable(df.schema[c].dataType) for c in rest):
        return keep_ranked(df, keys, highest, tie_break)
    df = nans_to_nulls(df, highest)
    fields = []
    for c in [*highest, *rest]:
        fields += [col(c).isNull().alias(f"{c} unknown"),
                   (_reversed(df, c, col(c)) if c in highest else col(c)).alias(c)]
    best = df.groupBy(*[col(k) for k in keys]).agg(F.min(F.struct(*fields)).alias("__best"))
    taken = {c: F.col("__best").getField(c) for c in rest}
    taken |= {c: _reversed(df, c, F.col("__best").getField(c)) for c in highest}
    return best.select(*[taken[c].alias(c) if c in taken else col(c) for c in df.columns])


def keep_ranked(df: DataFrame, keys: Sequence[str], highest: Sequence[str],
                tie_break: Iterable[str] | None = None) -> DataFrame:
    """The rows of ``keep_best`` by ``row_number``, for ratings of any type.

    The plan ranks twice (WindowGroupLimit): every map task keeps one row per key
    before the shuffle, at the price of sorting its rows by key and order.
    """
    df = nans_to_nulls(df, highest)
    order = [col(c).desc_nulls_last() for c in highest]
    order += [col(c).asc_nulls_last() for c in _tie_columns(df, keys, highest, tie_break)
              if _orderable(df.schema[c].dataType)]
    spec = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return (df.withColumn(_RANK, F.row_number().over(spec))
            .where(F.col(_RANK) == 1).drop(_RANK))


def _tie_columns(df: DataFrame, keys: Sequence[str], highest: Sequence[str],
                 tie_break: Iterable[str] | None) -> list[str]:
    wanted = [*(tie_break or []), *df.columns]
    return [c for c in dict.fromkeys(wanted) if c not in keys and c not in highest]


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _reversed(df: DataFrame, name: str, c: Column) -> Column:
    """The value in reverse order; applied twice it is the value again.

    Whole numbers are complemented, because the smallest one has no negative.
    """
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    return F.bitwise_not(c) if whole else -c


def distinct_rows(df: DataFrame, columns: Sequence[str], known_only: bool = False) -> DataFrame:
    """Distinct combinations of some columns; optionally without null ones."""
    rows = df.select(*[col(c) for c in columns])
    if known_only:
        rows = rows.where(all_of([known(df, c) for c in columns]))
    return rows.distinct()
