from unittest.mock import MagicMock

import pytest

from conftest import rows_of
from tallyroom.contracts import PLAYERS, Column, Table
from tallyroom.sinks.jdbc import (JdbcSink, append_rows, in_one_transaction, replace_rows,
                                  reset_statements)
from tallyroom.sinks.parquet import write_parquet
from tallyroom.sinks.tables import TableSink
from tallyroom.sources.parquet import read_parquet

TABLE = Table("served", "", (Column("k", "string", 5), Column("v", "double")), ("k",))


def test_parquet_round_trip_counts_rows(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    path = str(tmp_path / "p")
    assert write_parquet(df, path, partition_by=["part"], max_records_per_file=10) == 100
    assert rows_of(read_parquet(spark, path).select("id", "part")) == rows_of(df)
    assert write_parquet(df.where("id < 7"), path) == 7
    assert read_parquet(spark, path).count() == 7


@pytest.mark.parametrize("shape", ["filtered", "literal", "aggregated"])
def test_an_empty_write_counts_zero(spark, tmp_path, shape):
    df = {"filtered": lambda: spark.range(10).where("id > 99"),
          "literal": lambda: spark.createDataFrame([], "id bigint"),
          "aggregated": lambda: spark.range(10).where("id > 99").groupBy("id").count()}[shape]()
    assert write_parquet(df, str(tmp_path / "e")) == 0
    assert read_parquet(spark, str(tmp_path / "e"), df.schema).count() == 0


def test_a_load_replaces_the_one_before(spark, tmp_path):
    sink = TableSink(spark, str(tmp_path))
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sink.stage(first, TABLE, "")
    sink.commit()
    before = spark.table(sink.name_of(TABLE))
    sink.stage(first.where("k = 'a'"), TABLE, "")
    assert rows_of(before) == [("a", 1.0), ("b", 2.0)]
    sink.commit()
    assert rows_of(spark.table(sink.name_of(TABLE))) == [("a", 1.0)]
    assert rows_of(before) == [("a", 1.0), ("b", 2.0)]
    widths = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE {sink.name_of(TABLE)}").collect()]
    assert widths == [("k", "varchar(5)"), ("v", "double")]
    spark.sql(f"DROP TABLE {sink.name_of(TABLE)}")


class FailsOn(TableSink):
    """Fails when the named table is to take its place."""

    def __init__(self, spark, root, name):
        super().__init__(spark, root)
        self.fails = f"`default`.`{name}`"

    def rename(self, name, to):
        if to == self.fails:
            self.fails = None
            raise RuntimeError("catalogue unreachable")
        super().rename(name, to)


def test_a_switch_that_fails_leaves_every_served_table(spark, tmp_path):
    tables = [Table(f"pair_{i}", "", (Column("k", "string", 5), Column("odd name", "int")), ("k",))
              for i in (1, 2)]
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, `odd name` int")
    sink = TableSink(spark, str(tmp_path / "it's"))
    for t in tables:
        sink.stage(rows, t, "")
    sink.commit()
    failing = FailsOn(spark, str(tmp_path / "it's"), "pair_2")
    for t in tables:
        failing.stage(rows.where("k = 'a'"), t, "")
    with pytest.raises(RuntimeError, match="unreachable"):
        failing.commit()
    names = sorted(t.name for t in spark.catalog.listTables() if t.name.startswith("pair_"))
    assert names == ["pair_1", "pair_2"]
    for t in tables:
        assert rows_of(spark.table(sink.name_of(t))) == [("a", 1), ("b", 2)]
    failing.commit()
    for t in tables:
        assert rows_of(spark.table(sink.name_of(t))) == [("a", 1)]
        spark.sql(f"DROP TABLE {sink.name_of(t)}")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pair_")]


def recorder():
    """A frame whose writer records its calls; no database is needed."""
    writer = MagicMock()
    for method in ("format", "options", "option", "mode"):
        getattr(writer, method).return_value = writer
    return MagicMock(write=writer), writer


def test_append_options():
    df, writer = recorder()
    append_rows(df, "jdbc:x", "t", {"user": "u"}, batch_size=500, num_partitions=4)
    writer.format.assert_called_once_with("jdbc")
    writer.options.assert_called_once_with(url="jdbc:x", dbtable="t", batchsize=500,
                                           isolationLevel="READ_COMMITTED", user="u")
    writer.option.assert_called_once_with("numPartitions", 4)
    writer.mode.assert_called_once_with("append")
    writer.save.assert_called_once_with()


def test_replace_keeps_the_definition_of_the_target():
    df, writer = recorder()
    replace_rows(df, "jdbc:x", TABLE, {})
    writer.option.assert_any_call("truncate", True)
    writer.option.assert_any_call("createTableColumnTypes", "k VARCHAR(5)")
    writer.mode.assert_called_once_with("overwrite")


def test_reset_statements_hold_types_widths_and_keys():
    got = reset_statements(list(PLAYERS.tables))
    assert got[:3] == ["DROP TABLE IF EXISTS master_player_table",
                       "DROP TABLE IF EXISTS player_metadata",
                       "DROP TABLE IF EXISTS club_metadata"]
    assert got[5] == ("CREATE TABLE club_metadata (club_name VARCHAR(100), "
                      "PRIMARY KEY (club_name))")
    for part in ("full_name VARCHAR(255)", "age INTEGER", "value_eur DOUBLE PRECISION",
                 "preferred_foot VARCHAR(10)", "PRIMARY KEY (full_name)"):
        assert part in got[3]


@pytest.fixture
def calls(monkeypatch):
    seen = []
    monkeypatch.setattr("tallyroom.sinks.jdbc.append_rows",
                        lambda df, url, table, properties, **o: seen.append(("append", table, o)))
    monkeypatch.setattr("tallyroom.sinks.jdbc.replace_rows",
                        lambda df, url, table, properties, **o: seen.append(("replace", table.name)))
    return seen


def test_jdbc_sink_fills_new_tables_and_swaps_them_last(spark, calls):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sink = JdbcSink("jdbc:x", {}, run_statements=lambda s: calls.append(tuple(s)),
                    num_partitions=2)
    sink.stage(df, TABLE, "")
    assert calls == []
    sink.commit()
    assert calls == [
        ("DROP TABLE IF EXISTS served_incoming",
         "CREATE TABLE served_incoming (k VARCHAR(5), v DOUBLE PRECISION, PRIMARY KEY (k))"),
        ("append", "served_incoming", {"num_partitions": 2}),
        ("DROP TABLE IF EXISTS served", "ALTER TABLE served_incoming RENAME TO served")]


def test_a_load_that_fails_never_reaches_the_swap(spark, calls, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("connection lost")
    monkeypatch.setattr("tallyroom.sinks.jdbc.append_rows", fail)
    sink = JdbcSink("jdbc:x", {}, run_statements=lambda s: calls.append(tuple(s)))
    sink.stage(spark.createDataFrame([("a", 1)], "k string, v int"), TABLE, "")
    with pytest.raises(RuntimeError):
        sink.commit()
    assert len(calls) == 1 and not any("ALTER" in s for s in calls[0])


def test_without_a_client_rows_are_replaced(spark, calls):
    sink = JdbcSink("jdbc:x", {})
    sink.stage(spark.createDataFrame([("a", 1)], "k string, v int"), TABLE, "")
    sink.commit()
    assert calls == [("replace", "served")]


def test_statements_are_committed_together_or_not_at_all():
    connection = MagicMock()
    run = in_one_transaction(lambda: connection)
    run(["a", "b"])
    cursor = connection.cursor.return_value
    assert [c.args[0] for c in cursor.execute.call_args_list] == ["a", "b"]
    connection.commit.assert_called_once_with()
    connection.close.assert_called_once_with()
    connection.reset_mock()
    cursor.execute.side_effect = [None, RuntimeError("no such table")]
    with pytest.raises(RuntimeError):
        run(["a", "b", "c"])
    connection.commit.assert_not_called()
    connection.close.assert_called_once_with()
