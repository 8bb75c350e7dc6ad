"""Lookup of counted names in a dimension, and the names it does not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from .filters import all_of

# Neither join carries a broadcast hint: Spark broadcasts the dimension while its
# measured size is under spark.sql.autoBroadcastJoinThreshold, and shuffles both
# sides beyond that. The counted side is already one row per key.


def place(counts: DataFrame, dimension: DataFrame, on: str | list[str]) -> DataFrame:
    """Counts with the columns of the dimension; a name without match keeps nulls.

    A known key that the dimension holds twice fails the query: it would multiply counts.
    """
    keys = [on] if isinstance(on, str) else list(on)
    others = [c for c in dimension.columns if c not in keys]
    known = dimension.where(all_of([col(k).isNotNull() for k in keys]))
    rows = known.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), *[F.any_value(col(c)).alias(c) for c in others])
    repeated = F.raise_error(F.lit(f"the dimension holds a key of {', '.join(keys)} twice"))
    unique = rows.where(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(True))
    return counts.join(unique.select(*[col(c) for c in dimension.columns]), keys, "left")


def unplaced(counts: DataFrame, dimension: DataFrame, on: str | list[str]) -> DataFrame:
    """Counted names that the dimension does not hold."""
    return counts.join(dimension, on, "left_anti")
