"""Parquet folders with a row count from the same pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.quality import Fingerprint, counted


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  max_records_per_file: int | None = None, replace: bool = True) -> int:
    """Write the folder and return the number of rows written; see ``write_proven``."""
    return write_proven(df, path, partition_by, max_records_per_file, replace).n


def write_proven(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 max_records_per_file: int | None = None, replace: bool = True) -> Fingerprint:
    """Write the folder and return the fingerprint of the rows written.

    A folder that is there is replaced, or refused with ``replace=False``.

    It is observed by the write itself; counting afterwards would run the
    whole lineage again.
    """
    observed, seen = counted(df)
    writer = observed.write.mode("overwrite" if replace else "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    found = seen.get
    return Fingerprint(found["n"], int(found["sum1"]), int(found["sum2"]))
