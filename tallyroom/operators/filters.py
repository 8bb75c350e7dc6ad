"""Row filters: closed ranges and optional equality, as one conjunction."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col


def all_of(conditions: Iterable[Column]) -> Column:
    """All conditions hold; true when there is none."""
    conditions = list(conditions)
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def filter_rows(df: DataFrame, ranges: Mapping[str, tuple[Any, Any] | None] | None = None,
                equals: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows inside every closed range and equal on every given value.

    ``None`` as a range or value means that the column is not filtered. A range
    drops unknown values, also when it spans everything: null compares as unknown
    and NaN as larger than any upper end.
    """
    conditions = []
    for name, bounds in (ranges or {}).items():
        if bounds is not None:
            conditions.append(col(name).between(*bounds))
    for name, value in (equals or {}).items():
        if value is not None:
            conditions.append(col(name) == F.lit(value))
    return df.where(all_of(conditions))


def emptiness(df: DataFrame) -> DataFrame:
    """One row, ``is_empty``; each task stops at its first row."""
    return df.select(F.lit(1).alias("one")).limit(1).agg(
        (F.count("one") == 0).alias("is_empty"))


def page(df: DataFrame, order_by: list[str], size: int, after: tuple | None = None) -> DataFrame:
    """One page of rows in key order, starting behind the key ``after``.

    Pages continue from the last key seen, not from an offset, so a late page
    costs what the first one does. ``order_by`` must identify a row; unknown keys come last.
    """
    if after is not None:
        later, tied = F.lit(False), F.lit(True)
        for name, value in zip(order_by, after, strict=True):
            if value is not None:
                later = later | (tied & ((col(name) > F.lit(value)) | col(name).isNull()))
            tied = tied & col(name).eqNullSafe(F.lit(value))
        df = df.where(later)
    return df.orderBy(*[col(n).asc_nulls_last() for n in order_by]).limit(size)
