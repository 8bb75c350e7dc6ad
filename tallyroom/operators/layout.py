"""Rows laid out in files so that filters on several columns skip most of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, nan_as_null

#: Buckets of a column are numbered by so many bits.
BITS = 8
#: Accuracy of the quantiles that number columns are cut by.
_ACCURACY = 10_000


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number out of several: their bits in turn, the highest first (Z-order).

    Rows that are near in it are near in every one of the columns.
    """
    if len(numbers) * bits > 62:
        raise ValueError("too many bits for one number")
    out = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for n in numbers:
            out = F.shiftleft(out, 1) + F.shiftright(n, bit).bitwiseAND(F.lit(1)).cast("bigint")
    return out


def bucket_edges(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Upper edges of at most 2^bits buckets of about equal row counts per column, in one pass.

    Text is cut by its order, so a text column with few values has a bucket for each of
    the frequent ones. What comes to the driver has the size of the edges.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [c for c in columns if not isinstance(df.schema[c].dataType, T.StringType)]
    edges: dict[str, list] = {}
    if numbers:
        row = df.agg(*[F.percentile_approx(nan_as_null(df, c).cast("double"), shares, _ACCURACY)
                       .alias(f"e{i}") for i, c in enumerate(numbers)]).first()
        for i, c in enumerate(numbers):
            edges[c] = sorted(set(row[i] or []))
    for c in columns:
        if c not in numbers:
            # Counts are combined in the tasks; only the frequent values come to the driver.
            top = (df.where(col(c).isNotNull()).groupBy(col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.desc("n"), "v").limit((1 << bits) - 1))
            edges[c] = sorted(r.v for r in top.collect())
    return edges


def bucket_of(df: DataFrame, column: str, edges: list) -> Column:
    """The number of the bucket: how many edges the value is above. Unknown values come first."""
    number = isinstance(df.schema[column].dataType, T.NumericType)
    v = nan_as_null(df, column).cast("double") if number else col(column)
    above = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: v > e)) if edges else F.lit(0)
    return F.when(v.isNull(), 0).otherwise(above).cast("int")


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in ``files`` ranges of the interleaved buckets of the columns, sorted inside.

    Written out, every file spans a small box of the columns, so a filter on any of them
    skips the files (and row groups) whose least and largest values lie outside. A hash of the row
    breaks ties: a box that a third of all rows share is cut into several files.
    """
    edges = bucket_edges(df, columns, bits)
    code = interleaved([bucket_of(df, c, edges[c]) for c in columns], bits)
    hashed = F.xxhash64(*[col(f.name) for f in df.schema if not isinstance(f.dataType, T.MapType)])
    return (df.withColumns({"__code": code, "__hash": hashed})
            .repartitionByRange(files, "__code", "__hash")
            .sortWithinPartitions(*[col(c) for c in columns])
            .drop("__code", "__hash"))
