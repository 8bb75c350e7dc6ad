"""Raw rows -> cleaned stage -> served stages."""

from __future__ import annotations

from decimal import Decimal
from functools import partial

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Column, Contract, Table
from ..functions.columns import col, known, nans_to_nulls
from ..operators.clean import clean, conform, select_renamed
from ..operators.dedupe import distinct_rows, keep_best
from ..operators.filters import all_of
from ..operators.quality import Fingerprint
from ..session import run_together
from ..sinks.parquet import write_parquet, write_proven
from ..sources.delimited import RECORD, SOURCE
from ..sources.parquet import read_parquet


def folder_of(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.folder}"


def cleaned_rows(source: DataFrame, contract: Contract) -> DataFrame:
    """Complete, typed rows, one per key: a single shuffle, on the key."""
    return keep_best(clean(source, contract), contract.key, contract.highest,
                     contract.tie_break)


def served_rows(cleaned: DataFrame, contract: Contract, table: Table) -> DataFrame:
    """Rows of a served table out of the cleaned stage.

    A table with the key of the cleaned stage is a projection: its rows are
    already distinct. Any other key needs a distinct.
    """
    if set(contract.key) <= set(table.names):
        return cleaned.select(*table.names)
    return distinct_rows(cleaned, table.names)


def load_audit(source: DataFrame, contract: Contract) -> DataFrame:
    """One row on what the first stage keeps: ``n_read``, ``n_incomplete`` rows without a required
    value, ``n_duplicate`` complete rows that are not the best of their key, ``n_kept``.

    One shuffle, of a row per key and task.
    """
    typed = conform(select_renamed(source, contract.headers), contract.columns)
    complete = all_of([known(typed, name) for name in contract.required])
    # Incomplete rows share one group, which the tasks combine before the shuffle.
    keys = {f"k{i}": F.when(complete, col(name)) for i, name in enumerate(contract.key)}
    groups = (typed.select(complete.alias("complete"), *[c.alias(k) for k, c in keys.items()])
              .groupBy("complete", *keys).agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    return groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_read"),
        F.coalesce(F.sum(F.when(~F.col("complete"), n)), F.lit(0)).alias("n_incomplete"),
        F.coalesce(F.sum(F.when(F.col("complete"), n - 1)), F.lit(0)).alias("n_duplicate"),
        F.count_if("complete").alias("n_kept"))


#: Folders of the load's own records under the root of the stages.
PARSED, AUDIT, MALFORMED = "audit/parsed", "audit/load", "audit/malformed"
MANIFEST = "audit/manifest"
_MANIFEST_ROW = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("sum1", T.DecimalType(38, 0)), T.StructField("sum2", T.DecimalType(38, 0)),
    T.StructField("keys_proven", T.BooleanType())])
_COMPLETE = "__complete"


def parse_once(records: DataFrame, contract: Contract, path: str, replace: bool = False) -> DataFrame:
    """Store what one parse of ``read_with_records`` says of every row: the typed columns of the contract,
    the file, the record of a malformed row and whether the row is complete."""
    named = select_renamed(records, {**contract.headers, SOURCE: SOURCE, RECORD: RECORD})
    columns = (*contract.columns, Column(SOURCE, "string"), Column(RECORD, "string"))
    rows = conform(named, columns)
    complete = all_of([known(rows, name) for name in contract.required])
    write_parquet(rows.withColumn(_COMPLETE, complete), path, replace=replace)
    return read_parquet(records.sparkSession, path, rows.withColumn(_COMPLETE, complete).schema)


def audit_by_source(parsed: DataFrame, kept: DataFrame) -> DataFrame:
    """What became of the rows of ``parse_once``, one row a file: ``source``, ``n_read``, ``n_malformed``,
    ``n_incomplete``, ``n_duplicate``, ``n_kept``; ``kept``: the first stage with its ``SOURCE``.

    Every row read is incomplete, duplicate or kept; the malformed ones are counted besides,
    whichever they are. A key in several files is kept where its best row stands. One aggregate
    over both: nothing is parsed or reduced to its keys again.
    """
    def part(rows: DataFrame, **counts: SparkColumn) -> DataFrame:
        return rows.select(F.col(SOURCE).alias("source"),
                           *[counts.get(c, F.lit(0)).cast("bigint").alias(c) for c in
                             ("read", "malformed", "complete", "kept")])

    both = part(parsed, read=F.lit(1), malformed=F.col(RECORD).isNotNull(),
                complete=F.col(_COMPLETE)).unionByName(part(kept, kept=F.lit(1)))
    n = {c: F.sum(c) for c in ("read", "malformed", "complete", "kept")}
    return both.groupBy("source").agg(
        n["read"].alias("n_read"), n["malformed"].alias("n_malformed"),
        (n["read"] - n["complete"]).alias("n_incomplete"),
        (n["complete"] - n["kept"]).alias("n_duplicate"), n["kept"].alias("n_kept"))


def build_audited_stages(records: DataFrame, contract: Contract, root: str,
                         replace: bool = False) -> dict[str, int]:
    """``build_stages`` of the rows of ``read_with_records``, which are parsed once, with an audit.

    Beside the stages stand ``AUDIT`` (see ``audit_by_source``) and ``MALFORMED`` (source, record).
    The files of the first stage hold each row's ``SOURCE`` as a further column.
    """
    spark, root = records.sparkSession, root.rstrip("/")
    parsed = parse_once(records, contract, f"{root}/{PARSED}", replace)
    whole = nans_to_nulls(parsed.where(F.col(_COMPLETE)).drop(RECORD, _COMPLETE))
    first = contract.cleaned
    folder = folder_of(root, first)
    unique = write_parquet(keep_best(whole, contract.key, contract.highest, contract.tie_break),
                           folder, replace=replace)
    kept = read_parquet(spark, folder).select(SOURCE)
    malformed = (parsed.where(F.col(RECORD).isNotNull())
                 .select(F.col(SOURCE).alias("source"), F.col(RECORD).alias("record")))
    counts = {first.name: unique, **_served_stages(spark, contract, root, replace)}
    counts["malformed"] = run_together(spark, [
        partial(write_parquet, malformed, f"{root}/{MALFORMED}", replace=replace),
        partial(write_parquet, audit_by_source(parsed, kept), f"{root}/{AUDIT}", replace=replace)])[0]
    return counts


def build_stages(spark: SparkSession, source: DataFrame, contract: Contract,
                 root: str, replace: bool = False) -> dict[str, int]:
    """Write all stages under ``root``; rows written per stage, in order.

    A root that holds stages is refused: tables may serve them. ``replace`` overwrites them.

    The source is read once. The served tables start from the stored first stage,
    so all of them hold the same choice of rows, and each reads only its columns.
    """
    first = contract.cleaned
    unique = write_parquet(cleaned_rows(source, contract), folder_of(root, first),
                           replace=replace)
    return {first.name: unique, **_served_stages(spark, contract, root, replace)}


def _served_stages(spark: SparkSession, contract: Contract, root: str,
                   replace: bool) -> dict[str, int]:
    """Write the served tables out of the stored first stage, at the same time."""
    first = contract.cleaned
    cleaned = read_parquet(spark, folder_of(root, first), first.schema)

    def write(table: Table) -> Fingerprint:
        rows = served_rows(cleaned, contract, table)
        if table.sort:
            rows = rows.sortWithinPartitions(*table.sort)
        return write_proven(rows, folder_of(root, table), replace=replace)

    written = run_together(spark, [partial(write, t) for t in contract.tables])
    # The first stage holds one row per key; other keys are unique where they are all of the row.
    proven = [set(contract.key) == set(t.key) or set(t.names) == set(t.key) for t in contract.tables]
    rows = [(t.name, f.n, Decimal(f.sum1), Decimal(f.sum2), p)
            for t, f, p in zip(contract.tables, written, proven, strict=True)]
    (spark.createDataFrame(rows, _MANIFEST_ROW).coalesce(1).write
     .mode("overwrite" if replace else "errorifexists").parquet(f"{root.rstrip('/')}/{MANIFEST}"))
    return {t.name: f.n for t, f in zip(contract.tables, written, strict=True)}


def manifest(spark: SparkSession, root: str) -> dict[str, tuple[Fingerprint, bool]]:
    """What ``build_stages`` wrote: each table's fingerprint and whether its keys are known to be
    unique. Empty for stages without a manifest."""
    rows = read_parquet(spark, f"{root.rstrip('/')}/{MANIFEST}", _MANIFEST_ROW, "empty")
    return {r["name"]: (Fingerprint(r["n"], int(r["sum1"]), int(r["sum2"])), r["keys_proven"])
            for r in rows.collect()}
