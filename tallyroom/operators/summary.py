"""Whole-table numbers: count, mean, bounds and the row with the largest value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, is_float, known, nan_as_null
from ..functions.labels import currency, one_decimal, thousands


def summarise(df: DataFrame, value: str) -> DataFrame:
    """One row: ``n``, ``mean``, ``lo``, ``hi``, from one pass; unknowns are skipped."""
    v = nan_as_null(df, value)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"),
                  F.min(v).alias("lo"), F.max(v).alias("hi"))


def bounds(df: DataFrame, value: str) -> DataFrame:
    """One row ``lo``, ``hi``, cut to whole numbers towards zero (slider ends).

    Infinite values are skipped; bounds beyond 64 bits are the least or largest bigint.
    """
    v = nan_as_null(df, value)
    if not is_float(df, value):
        return df.agg(F.min(v).cast("bigint").alias("lo"), F.max(v).cast("bigint").alias("hi"))
    v = F.when(F.abs(v) < float("inf"), v)
    return df.agg(_to_bigint(F.min(v)).alias("lo"), _to_bigint(F.max(v)).alias("hi"))


def _to_bigint(v: Column) -> Column:
    return (F.when(v >= 2.0**63, 2**63 - 1).when(v < -(2.0**63), -(2**63))
            .otherwise(v.try_cast("bigint")))


def top_row(df: DataFrame, value: str, tie_break: Sequence[str]) -> DataFrame:
    """The whole row with the largest value, smallest key on ties.

    No row where the input is empty or holds no known value. Each task keeps one
    row (TakeOrderedAndProject), so nothing is sorted or shuffled in full.
    """
    return (df.where(known(df, value))
            .orderBy(col(value).desc(), *[col(k).asc_nulls_last() for k in tie_break])
            .limit(1))


def metric_labels(df: DataFrame, rating: str, value: str) -> DataFrame:
    """One row of display text: row count, mean rating and largest value."""
    v = nan_as_null(df, value)
    return df.agg(thousands(F.count(F.lit(1))).alias("count_label"),
                  one_decimal(F.avg(nan_as_null(df, rating))).alias("mean_label"),
                  currency(F.max(v)).alias("top_label"))
