"""Served views that switch under a journal."""

import pytest

from conftest import rows_of
from tallyroom.contracts import Column, Table
from tallyroom.errors import ContractError
from tallyroom.sinks.tables import TableSink
from tallyroom.sinks.versions import VersionedSink


class Killed(BaseException):
    """The end of a driver."""


class Stops(VersionedSink):
    """Ends, or fails, after a number of steps."""

    def __init__(self, *args, steps=10**6, error=Killed, **kwargs):
        super().__init__(*args, **kwargs)
        self.steps, self.error, self.taken = steps, error, 0

    def _after(self):
        self.taken += 1
        if self.taken == self.steps:
            raise self.error("stopped")

    def record(self, switches):
        super().record(switches)
        self._after()

    def create(self, name, table, folder):
        super().create(name, table, folder)
        self._after()

    def run(self, statement):
        super().run(statement)
        self._after()


def pair(name):
    return [Table(f"{name}_{i}", "", (Column("k", "string", 5), Column("odd name", "int")), ("k",))
            for i in (1, 2)]


def load(sink, tables, rows):
    for t in tables:
        sink.stage(rows, t, "")
    sink.commit()


def entries(spark, name):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith(name)}


@pytest.fixture
def old_new(spark):
    schema = "k string, `odd name` int"
    return (spark.createDataFrame([("a", 1), ("b", 2)], schema), spark.createDataFrame([("c", 3)], schema))


# A second load: journal, two versions, two views, two old entries dropped, journal emptied.
STEPS = 8


@pytest.mark.parametrize("steps", range(1, STEPS + 1))
def test_a_driver_that_dies_leaves_whole_tables_and_is_recovered(spark, tmp_path, old_new, steps):
    old, new = old_new
    tables = pair(f"dies{steps}")
    where = (spark, str(tmp_path / "journal"), str(tmp_path / "it's"))
    sink = VersionedSink(*where)
    load(sink, tables, old)
    before = [spark.table(sink.name_of(t)) for t in tables]
    with pytest.raises(Killed):
        load(Stops(*where, steps=steps), tables, new)
    for t in tables:
        assert rows_of(spark.table(sink.name_of(t))) in (rows_of(old), rows_of(new))
    expected = "undone" if steps < 3 else "nothing" if steps == STEPS else "finished"
    assert sink.recover() == expected and sink.recover() == "nothing"
    for t, df in zip(tables, before, strict=True):
        assert rows_of(spark.table(sink.name_of(t))) == rows_of(old if expected == "undone" else new)
        assert rows_of(df) == rows_of(old)
    assert len(entries(spark, f"dies{steps}")) == 4
    load(sink, tables, old)
    assert rows_of(spark.table(sink.name_of(tables[1]))) == rows_of(old)
    for t in tables:
        sink.remove(t)
    assert entries(spark, f"dies{steps}") == set()


@pytest.mark.parametrize("steps", [1, 2, 3, 4, 5])
def test_a_recovery_that_dies_is_recovered(spark, tmp_path, old_new, steps):
    old, new = old_new
    tables = pair(f"twice{steps}")
    where = (spark, str(tmp_path / "journal"), str(tmp_path / "t"))
    load(VersionedSink(*where), tables, old)
    with pytest.raises(Killed):
        load(Stops(*where, steps=4), tables, new)
    try:
        Stops(*where, steps=steps).recover()
    except Killed:
        pass
    sink = VersionedSink(*where)
    sink.recover()
    assert [rows_of(spark.table(sink.name_of(t))) for t in tables] == [rows_of(new)] * 2
    for t in tables:
        sink.remove(t)


@pytest.mark.parametrize("steps", [2, 4, 5])
def test_a_switch_that_fails_is_undone_at_once(spark, tmp_path, old_new, steps):
    old, new = old_new
    tables = pair(f"fails{steps}")
    where = (spark, str(tmp_path / "journal"), str(tmp_path / "t"))
    sink = VersionedSink(*where)
    load(sink, tables, old)
    with pytest.raises(RuntimeError):
        load(Stops(*where, steps=steps, error=RuntimeError), tables, new)
    assert [rows_of(spark.table(sink.name_of(t))) for t in tables] == [rows_of(old)] * 2
    assert sink.recover() == "nothing" and len(entries(spark, f"fails{steps}")) == 4
    for t in tables:
        sink.remove(t)


def test_a_first_load_that_dies_leaves_no_entries(spark, tmp_path, old_new):
    tables = pair("never")
    where = (spark, str(tmp_path / "journal"), str(tmp_path / "t"))
    with pytest.raises(Killed):
        load(Stops(*where, steps=2), tables, old_new[0])
    assert VersionedSink(*where).recover() == "undone" and entries(spark, "never") == set()


def test_a_plain_table_is_not_replaced_by_a_view(spark, tmp_path, old_new):
    (t, _) = pair("plain")
    plain = TableSink(spark, str(tmp_path / "t"))
    load(plain, [t], old_new[0])
    with pytest.raises(ContractError, match="served by views"):
        load(VersionedSink(spark, str(tmp_path / "journal"), str(tmp_path / "t")), [t], old_new[1])
    assert rows_of(spark.table(plain.name_of(t))) == rows_of(old_new[0])
    spark.sql(f"DROP TABLE {plain.name_of(t)}")
