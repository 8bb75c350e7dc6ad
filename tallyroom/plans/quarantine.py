"""Route every row of a load to the good or to the rejected ones, with the reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..contracts import Table
from ..functions.columns import col
from ..operators.clean import conform, require_columns, typed
from ..operators.filters import all_of
from ..sources.parquet import read_parquet

REASONS = "__reasons"
_REPEATED, _BAD = "__repeated", "__bad"


@dataclass(frozen=True)
class Routed:
    """What ``quarantine`` wrote: the folder of each kind and the rows in it."""

    good: DataFrame
    rejected: DataFrame
    n_read: int
    n_good: int
    n_rejected: int


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """The whole keys that stand on more than one row: one shuffle, of a row per key and task."""
    known = all_of([col(k).isNotNull() for k in key])
    return (df.where(known).groupBy(*[col(k) for k in key]).agg(F.count(F.lit(1)).alias(_REPEATED))
            .where(F.col(_REPEATED) > 1).withColumn(_REPEATED, F.lit(True)))


def with_reasons(df: DataFrame, table: Table) -> DataFrame:
    """The rows as the table types them, each with the list of what is wrong with it.

    Reasons: a value that its type cannot hold ("<column> is no <type>: <value>"), an unknown part of the
    key ("<column> is null"), a text that is too long ("<column> is longer than <width>"), and "key is
    repeated". Of rows that share a key no one can tell which is right, so all are rejected;
    ``keep_best`` before the load chooses one instead.

    Keys are counted by one shuffle of combined counts. The few repeated ones meet the rows
    in a join that adaptive execution broadcasts while they are small and whose hot keys it splits
    beyond that; rows with an unknown key take no part in either.
    """
    require_columns(df, table.names)
    problems = []
    # A value that is lost by the cast is a reason, so it is told before the cast.
    lost = {c.name: F.when(typed(df, c).isNull(), col(c.name).cast("string"))
            for c in table.columns if df.schema[c.name].dataType != c.spark_type}
    rows = df.select(*[typed(df, c).alias(c.name) for c in table.columns],
                     *[value.alias(f"no {name}") for name, value in lost.items()])
    for c in table.columns:
        if c.name in lost:
            value = col(f"no {c.name}")
            problems.append((value.isNotNull(), F.concat(F.lit(f"{c.name} is no {c.type}: "), value)))
        if c.name in table.key:
            problems.append((col(c.name).isNull(), F.lit(f"{c.name} is null")))
        if c.width:
            problems.append((F.length(col(c.name)) > c.width,
                             F.lit(f"{c.name} is longer than {c.width}")))
    keys = list(table.key)
    found = rows.join(repeated_keys(conform(df, table.columns), keys), keys, "left")
    problems.append((F.col(_REPEATED), F.lit("key is repeated")))
    reasons = F.array_compact(F.array(*[F.when(c, text) for c, text in problems]))
    return found.select(*[col(c) for c in table.names], reasons.alias(REASONS))


def quarantine(df: DataFrame, table: Table, root: str) -> Routed:
    """Write the good rows and the rejected ones (with ``reasons``) under ``root``, in one pass.

    The write itself counts both; read is good plus rejected.
    """
    marked = with_reasons(df, table).withColumn(_BAD, F.size(REASONS) > 0)
    seen = Observation("routed")
    counted = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(_BAD)).alias("bad"))
    (counted.withColumnRenamed(REASONS, "reasons").write.partitionBy(_BAD).mode("errorifexists")
     .parquet(root))
    n, bad = seen.get["n"], seen.get["bad"]
    spark = df.sparkSession
    schema = marked.withColumnRenamed(REASONS, "reasons").drop(_BAD).schema
    part = lambda kind: read_parquet(
        spark, f"{root.rstrip('/')}/{_BAD}={kind}", schema, on_missing="empty")
    return Routed(part("false").drop("reasons"), part("true"), n, n - bad, bad)
