"""Database tables over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def range_options(column: str | None, lower: int | str | None, upper: int | str | None,
                  num_partitions: int | None) -> dict[str, str]:
    """Options that split a table read into ranges; all four values or none."""
    given = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper,
             "numPartitions": num_partitions}
    absent = [name for name, value in given.items() if value is None]
    if len(absent) == len(given):
        return {}
    if absent:
        raise ValueError(f"a split read also needs {', '.join(absent)}")
    return {name: str(value) for name, value in given.items()}


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               column: str | None = None, lower: int | str | None = None,
               upper: int | str | None = None, num_partitions: int | None = None,
               predicates: Sequence[str] | None = None) -> DataFrame:
    """A whole table, lazily: later filters and column choices run in the database.

    One connection reads everything unless the read is split, by ranges of a
    number, date or timestamp column, or by ``predicates`` (one task each, which
    must cover every row once), for tables whose key is text or uneven.
    """
    ranges = range_options(column, lower, upper, num_partitions)
    if predicates is not None:
        if ranges:
            raise ValueError("split by ranges or by predicates, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return (spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
            .options(**ranges).load())
