"""Bounds and row counts from the statistics in Parquet footers, where those can answer."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..operators.summary import bounds
from .parquet import read_parquet

#: Types whose least and largest value Spark takes from footers. Text is not among them, since
#: writers may cut it.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
#: The reader that hands aggregates down to the files.
_READER = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _reader(spark: SparkSession) -> SparkSession:
    """A session of its own with the caller's settings, so that the caller's stay as they are."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in _READER.items():
        session.conf.set(name, value)
    return session


def footer_bounds(spark: SparkSession, path: str, value: str) -> DataFrame:
    """One row ``lo``, ``hi`` of the raw column; the scan under it reads footers only.

    Running it fails where a row group has no statistics for the column.
    """
    return read_parquet(_reader(spark), path).agg(F.min(col(value)).alias("lo"),
                                                  F.max(col(value)).alias("hi"))


def stored_rows(spark: SparkSession, path: str) -> int:
    """The number of stored rows, summed from the footers."""
    return read_parquet(_reader(spark), path).agg(F.count(F.lit(1))).first()[0]


def stored_bounds(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``summary.bounds`` of a stored column without reading its values.

    Footers cannot answer for other types than plain numbers, for row groups that hold no known value or
    were written without statistics (Spark writes none where there is a NaN), and where a bound is
    infinite, which ``bounds`` skips. Then the column is scanned. Runs one job at once.
    """
    rows = read_parquet(spark, path)
    kind = rows.select(col(value)).schema[0].dataType
    if not isinstance(kind, _NUMBERS):
        return bounds(rows, value)
    try:
        ends = footer_bounds(spark, path, value).first()
    except (Py4JJavaError, PySparkException):
        # A file that cannot be read at all fails the scan, too.
        return bounds(rows, value)
    if any(end is None or abs(end) == float("inf") or end != end for end in ends):
        return bounds(rows, value)
    schema = T.StructType([T.StructField(value, kind)])
    return bounds(spark.createDataFrame([(end,) for end in ends], schema), value)
