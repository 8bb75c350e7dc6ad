"""Staged folders -> served tables, all or none."""

from __future__ import annotations

from functools import partial
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Contract, Table
from ..operators.quality import require_contract
from ..session import run_together
from ..sources.parquet import read_parquet
from .stages import folder_of, manifest


class Sink(Protocol):
    """Somewhere to publish: ``stage`` every table, then ``commit`` them together."""

    def stage(self, df: DataFrame, table: Table, folder: str) -> None:
        """Prepare the rows of a table, which are stored in ``folder``."""

    def commit(self) -> None:
        """Make everything staged visible."""


def publish(spark: SparkSession, contract: Contract, root: str, sink: Sink,
            on_missing: str = "fail") -> list[str]:
    """Check every staged table, then hand all of them to the sink; names published.

    No table is touched until every table has passed its types, key and widths. A table that the
    manifest of the stages knows must hold the very rows that were written; their keys, unique
    then, are not grouped again.
    """
    known = manifest(spark, root)
    found = [(read_parquet(spark, folder_of(root, t), on_missing=on_missing), t)
             for t in contract.tables]
    present = [(df, t) for df, t in found if df is not None]
    proofs = {name: proof for name, (proof, keys_proven) in known.items() if keys_proven}
    run_together(spark, [partial(require_contract, df, t, proofs.get(t.name)) for df, t in present])
    for df, table in present:
        sink.stage(df, table, folder_of(root, table))
    sink.commit()
    return [table.name for _, table in present]
