"""Served views over versioned tables, switched under a journal that a later run finishes or undoes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..contracts import Table
from ..errors import ContractError
from ..sources.parquet import read_parquet
from .parquet import write_parquet
from .tables import TableSink, create_table

_JOURNAL = T.StructType([T.StructField(name, T.StringType())
                         for name in ("name", "version", "previous")])


@dataclass(frozen=True)
class Switch:
    """A served view, the version it is to show and the one it showed before (None: none)."""

    name: str
    version: str
    previous: str | None


class VersionedSink(TableSink):
    """Publishes tables as new versions and points one view per table at them.

    ``commit`` writes the journal, creates every version as a table of its own, then points
    the views at them one by one, drops the entries of the versions before and empties the
    journal. A view that is there is altered in one step of the catalogue, so its readers find the old
    rows or the new ones, whole, at any moment; between the first and the last view, tables of
    one load differ. Readers that started on an old version finish: its folder stays.

    A driver may die after any step. ``recover``, with which every commit begins, reads
    the journal: where all new versions exist it finishes the switch, else it takes them away
    again (no view had been touched then). It can itself be cut short and run again.

    ``journal`` is a folder of this set of tables alone, which one load at a time may use.
    A served name that is a plain table is refused: a view cannot take its place in one step.
    """

    def __init__(self, spark: SparkSession, journal: str, root: str | None = None,
                 database: str = "default"):
        super().__init__(spark, root, database)
        self.journal = journal

    def commit(self) -> None:
        self.recover()
        run = uuid.uuid4().hex[:12]
        switches = [Switch(self.name_of(t), self.name_of(t, f"__v_{run}"), self._shown(self.name_of(t)))
                    for t, _ in self._staged]
        self.record(switches)
        try:
            for switch, (table, folder) in zip(switches, self._staged, strict=True):
                self.create(switch.version, table, folder)
            for switch in switches:
                self._point(switch.name, switch.version)
        except Exception:
            self._undo(switches)
            raise
        self._close(switches)
        self._staged.clear()

    def recover(self) -> str:
        """Settle a switch that was cut short; "nothing", "finished" or "undone"."""
        rows = read_parquet(self.spark, self.journal, _JOURNAL, on_missing="empty").collect()
        switches = [Switch(*row) for row in rows]
        if not switches:
            return "nothing"
        if all(self.spark.catalog.tableExists(s.version) for s in switches):
            for switch in switches:
                self._point(switch.name, switch.version)
            self._close(switches)
            return "finished"
        self._undo(switches)
        return "undone"

    def remove(self, table: Table) -> None:
        """Take the view and the entry of its version out of the catalogue; rows stay."""
        version = self._shown(self.name_of(table))
        if version is not None:
            self.spark.sql(f"DROP VIEW {self.name_of(table)}")
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")

    # Each of these is one step, after which a driver may die.

    def record(self, switches: list[Switch]) -> None:
        """The open switch as a single file, which is there as a whole or not at all."""
        rows = [(s.name, s.version, s.previous) for s in switches]
        write_parquet(self.spark.createDataFrame(rows, _JOURNAL).coalesce(1), self.journal)

    def create(self, name: str, table: Table, folder: str) -> None:
        create_table(self.spark, name, table, folder)

    def run(self, statement: str) -> None:
        self.spark.sql(statement)

    def _point(self, name: str, version: str) -> None:
        verb = "ALTER" if self.spark.catalog.tableExists(name) else "CREATE"
        self.run(f"{verb} VIEW {name} AS SELECT * FROM {version}")

    def _undo(self, switches: list[Switch]) -> None:
        for switch in switches:
            if switch.previous is not None:
                self._point(switch.name, switch.previous)
            else:
                self.run(f"DROP VIEW IF EXISTS {switch.name}")
        for switch in switches:
            self.run(f"DROP TABLE IF EXISTS {switch.version}")
        self.record([])

    def _close(self, switches: list[Switch]) -> None:
        for switch in switches:
            if switch.previous is not None:
                self.run(f"DROP TABLE IF EXISTS {switch.previous}")
        self.record([])

    def _shown(self, name: str) -> str | None:
        """The version that a served view shows, None where there is no such view."""
        if not self.spark.catalog.tableExists(name):
            return None
        if self.spark.catalog.getTable(name).tableType != "VIEW":
            raise ContractError(f"{name} is a table; versions are served by views")
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'")
        return text.first()["data_type"].removeprefix("SELECT * FROM ")
