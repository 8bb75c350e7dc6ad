"""Checks a database would enforce: keys, lengths, row counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..contracts import Table
from ..errors import ContractError
from ..functions.columns import col
from .clean import require_columns


def key_violations(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Keys that occur more than once or hold a null, with their row counts."""
    k = [col(c) for c in keys]
    some_null = F.lit(False)
    for c in k:
        some_null = some_null | c.isNull()
    return (df.groupBy(*k).agg(F.count(F.lit(1)).alias(count_name))
            .where((col(count_name) > 1) | some_null))


def length_violations(df: DataFrame, widths: Mapping[str, int], keys: Sequence[str]) -> DataFrame:
    """Too long texts: the key, ``column_name``, ``value``, ``len`` and ``max_len``.

    One pass for all columns, without a shuffle.
    """
    checks = F.array(*[
        F.struct(F.lit(name).alias("column_name"), col(name).cast("string").alias("value"),
                 F.length(col(name)).alias("len"), F.lit(width).alias("max_len"))
        for name, width in widths.items()])
    too_long = F.filter(checks, lambda c: c["len"] > c["max_len"])
    # Good rows, nearly all, leave before the array of checks is built.
    some_long = F.lit(False)
    for name, width in widths.items():
        some_long = some_long | (F.length(col(name)) > width)
    return df.where(some_long).select(*[col(k) for k in keys], F.inline(too_long))


@dataclass(frozen=True)
class Fingerprint:
    """What identifies the rows of a table whatever their order and files: their number and two sums
    of 64-bit row hashes. A lost, doubled or changed row changes it."""

    n: int
    sum1: int
    sum2: int


def fingerprint_of(df: DataFrame) -> list[Column]:
    """The aggregates ``n``, ``sum1``, ``sum2`` of a fingerprint, for ``agg`` or ``observe``."""
    names = [col(c) for c in df.columns]
    # A sum of hashes goes beyond 64 bits; as decimals it holds for 10^19 rows.
    total = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
             for h in (F.xxhash64(*names), F.xxhash64(F.lit(1), *names))]
    return [F.count(F.lit(1)).alias("n"), total[0].alias("sum1"), total[1].alias("sum2")]


def fingerprint(df: DataFrame) -> Fingerprint:
    row = df.agg(*fingerprint_of(df)).first()
    return Fingerprint(row["n"], int(row["sum1"]), int(row["sum2"]))


def contract_report(df: DataFrame, table: Table, keys_proven: bool = False) -> DataFrame:
    """One row per check of a table contract: ``check``, ``n_bad``.

    ``keys_proven``: keys are known to be unique, so only unknown ones are looked for and nothing
    is shuffled by key.
    """
    require_columns(df, table.names)
    counted = {f"length of {name} over {width}": F.count_if(F.length(col(name)) > width)
               for name, width in table.widths.items()}
    if keys_proven:
        some_null = reduce(or_, [col(k).isNull() for k in table.key])
        counted["unknown key"] = F.count_if(some_null)
    # Column names stay plain numbers: the check texts are data.
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted.values())]) if counted else None
    if keys_proven:
        return _as_rows(row, counted)
    keys = key_violations(df.select(*[col(k) for k in table.key]), table.key, "__rows")
    report = keys.agg(F.lit("unique key").alias("check"), F.count(F.lit(1)).alias("n_bad"))
    if row is None:
        return report
    return report.union(_as_rows(row, counted))


def _as_rows(row: DataFrame, checks: Iterable[str]) -> DataFrame:
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(text).alias("check"), F.col(f"c{i}").alias("n_bad"))
        for i, text in enumerate(checks)])))


def require_contract(df: DataFrame, table: Table, written: Fingerprint | None = None) -> None:
    """Raise one error that lists every failed check; collects a row per check only.

    ``written``: the fingerprint that the table had when it was written with unique keys. If it is
    still the same, keys are not grouped again; if not, that is an error beside those of the checks.
    """
    changed = []
    if written is not None and (found := fingerprint(df)) != written:
        changed.append("the stored rows are not those that were written "
                       f"({found.n} rows, {written.n} written)")
    wrong = [f"{f.name} is {f.dataType.simpleString()}, not {want.simpleString()}"
             for f in require_columns(df, table.names).select(*table.names).schema
             if f.dataType != (want := table.schema[f.name].dataType)]
    if wrong:
        raise ContractError(f"{table.name}: {'; '.join(wrong + changed)}")
    proven = written is not None and not changed
    bad = contract_report(df, table, proven).where(F.col("n_bad") > 0).collect()
    if bad or changed:
        raise ContractError(f"{table.name}: " + "; ".join(
            [f"{r['check']} ({r['n_bad']} violations)" for r in bad] + changed))


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with its fingerprint, of which ``n`` is the row count, taken by whichever action
    runs it.

    Put it last before a write: result tasks report once per partition, so a task
    that is run again after a lost executor is not counted twice.
    """
    seen = Observation(name)
    return df.observe(seen, *fingerprint_of(df)), seen
