"""Spark tables whose data is switched together."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Table
from ..operators.clean import conform
from .parquet import write_parquet


class TableSink:
    """Publishes Parquet tables into a database of the catalogue, all or none.

    ``stage`` prepares a folder per table. ``commit`` creates every table under a new
    name first, then renames each served table away and the new one into its place.
    When a step fails, the renames are undone, so all served tables are the old ones.
    Those are catalogue entries only: the time in which tables of one load differ does
    not grow with the data. Between its two renames a table has no entry.

    With ``root`` the rows are copied to a new folder under it. Without it the
    tables are created over the staged folders themselves: nothing is copied, and
    every run must stage under a root of its own. Old folders stay either way, and
    readers that started on them finish.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, database: str = "default"):
        self.spark, self.root, self.database = spark, root, database
        self._staged: list[tuple[Table, str]] = []

    def name_of(self, table: Table, suffix: str = "") -> str:
        return f"`{self.database}`.`{table.name}{suffix}`"

    def stage(self, df: DataFrame, table: Table, folder: str) -> None:
        if self.root is not None:
            folder = f"{self.root.rstrip('/')}/{table.name}/{uuid.uuid4().hex}"
            write_parquet(conform(df, table.columns), folder)
        self._staged.append((table, folder))

    def commit(self) -> None:
        run = uuid.uuid4().hex[:12]
        renamed: list[tuple[str, str]] = []
        try:
            for table, folder in self._staged:
                create_table(self.spark, self.name_of(table, f"_new_{run}"), table, folder)
            for table, _ in self._staged:
                served = self.name_of(table)
                steps = [(self.name_of(table, f"_new_{run}"), served)]
                if self.spark.catalog.tableExists(served):
                    steps.insert(0, (served, self.name_of(table, f"_old_{run}")))
                for step in steps:
                    self.rename(*step)
                    renamed.append(step)
        except Exception:
            for before, after in reversed(renamed):
                self.rename(after, before)
            self._drop(f"_new_{run}")
            raise
        self._drop(f"_old_{run}")
        self._staged.clear()

    def rename(self, name: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {name} RENAME TO {to}")

    def _drop(self, suffix: str) -> None:
        for table, _ in self._staged:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name_of(table, suffix)}")


def create_table(spark: SparkSession, name: str, table: Table, folder: str) -> None:
    """Create a table with its declared widths over a folder."""
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({table.ddl()}) USING parquet LOCATION '{location}'")
