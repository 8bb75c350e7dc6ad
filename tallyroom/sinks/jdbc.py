"""Database tables over JDBC."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import closing
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame

from ..contracts import Table
from ..operators.clean import conform


def append_rows(df: DataFrame, url: str, table: str, properties: dict[str, str],
                batch_size: int = 10_000, num_partitions: int | None = None,
                isolation: str = "READ_COMMITTED") -> None:
    """Append a frame. Each task commits by itself: check the rows first.

    ``num_partitions`` bounds the connections that are open at a time.
    """
    _writer(df, url, table, properties, batch_size, num_partitions, isolation).mode(
        "append").save()


def replace_rows(df: DataFrame, url: str, table: Table, properties: dict[str, str],
                 batch_size: int = 10_000, num_partitions: int | None = None,
                 isolation: str = "READ_COMMITTED") -> None:
    """Empty the table and fill it again, keeping its own definition and key.

    A table that is not there is created with the declared widths and the database's own
    number types, but without a key: use ``reset_statements`` where the key must be declared.
    """
    writer = _writer(df, url, table.name, properties, batch_size, num_partitions, isolation)
    # Spark parses these as its own types, so only the widths of text are named.
    widths = ", ".join(c.ddl("spark") for c in table.columns if c.type == "string" and c.width)
    if widths:
        writer = writer.option("createTableColumnTypes", widths)
    writer.option("truncate", True).mode("overwrite").save()


def _writer(df, url, table, properties, batch_size, num_partitions, isolation):
    writer = df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=batch_size, isolationLevel=isolation, **properties)
    return writer.option("numPartitions", num_partitions) if num_partitions else writer


def incoming(table: Table) -> Table:
    """The table a load fills before it takes the place of the served one."""
    return replace(table, name=f"{table.name}_incoming")


def reset_statements(tables: list[Table]) -> list[str]:
    """Drop and create statements, keys included, for one transaction."""
    drops = [f"DROP TABLE IF EXISTS {t.name}" for t in tables]
    return drops + [f"CREATE TABLE {t.name} ({t.ddl('jdbc')})" for t in tables]


def swap_statements(tables: list[Table]) -> list[str]:
    """Put the incoming tables in place of the served ones, for one transaction."""
    return [statement for t in tables
            for statement in (f"DROP TABLE IF EXISTS {t.name}",
                              f"ALTER TABLE {incoming(t).name} RENAME TO {t.name}")]


def in_one_transaction(connect: Callable[[], Any]) -> Callable[[list[str]], None]:
    """``run_statements`` for any Python database client: ``connect`` opens a connection.

    All statements are committed together; after an error none is, and it is raised.
    """
    def run(statements: list[str]) -> None:
        with closing(connect()) as connection:
            with closing(connection.cursor()) as cursor:
                for statement in statements:
                    cursor.execute(statement)
            connection.commit()
    return run


class JdbcSink:
    """Publishes to a database.

    ``run_statements`` runs a list of statements in one transaction, with any
    database client of the caller. With it, rows go to new tables, created with
    their keys, that replace the served ones together at the end: an append commits
    task by task, so a load that fails half-way must not touch what is served.

    Without it the rows of each table are replaced and its definition is kept;
    readers then see a load while it runs.
    """

    def __init__(self, url: str, properties: dict[str, str],
                 run_statements: Callable[[list[str]], None] | None = None, **options):
        self.url, self.properties, self.options = url, properties, options
        self.run_statements = run_statements
        self._staged: list[tuple[DataFrame, Table]] = []

    def stage(self, df: DataFrame, table: Table, folder: str) -> None:
        self._staged.append((conform(df, table.columns), table))

    def commit(self) -> None:
        tables = [table for _, table in self._staged]
        if self.run_statements is None:
            for df, table in self._staged:
                replace_rows(df, self.url, table, self.properties, **self.options)
        else:
            self.run_statements(reset_statements([incoming(t) for t in tables]))
            for df, table in self._staged:
                append_rows(df, self.url, incoming(table).name, self.properties, **self.options)
            self.run_statements(swap_statements(tables))
        self._staged.clear()
