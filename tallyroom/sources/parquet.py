"""Parquet folders, with an explicit choice for a folder that is not there."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 on_missing: str = "fail") -> DataFrame | None:
    """The folder as a frame.

    ``on_missing``: "fail" raises, "skip" warns and gives None, "empty" gives no
    rows in ``schema``.
    """
    if on_missing not in ("fail", "skip", "empty"):
        raise ValueError(f"on_missing: {on_missing}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if on_missing == "fail" or error.getCondition() != "PATH_NOT_FOUND":
            raise
    if on_missing == "skip":
        warnings.warn(f"no data at {path}, skipped", stacklevel=2)
        return None
    if schema is None:
        raise ValueError("on_missing='empty' needs a schema")
    return empty_frame(spark, schema)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, but the columns and types every later step expects."""
    return spark.createDataFrame([], schema)
