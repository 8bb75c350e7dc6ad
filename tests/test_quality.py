from dataclasses import replace

import pytest

from conftest import plan_of, rows_of
from tallyroom.contracts import PLAYERS
from tallyroom.errors import ContractError, MissingColumnsError
from tallyroom.operators.quality import (contract_report, counted, key_violations,
                                         length_violations, require_contract)

MASTER = PLAYERS.tables[0]


def master(players, *rows):
    return players(*rows).select(*MASTER.names)


def test_duplicate_and_null_keys_are_listed(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows_of(key_violations(df, ["k"])) == [("a", 2), (None, 1)]


def test_part_of_a_key_may_not_be_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 2)], "k string, j int")
    assert rows_of(key_violations(df, ["k", "j"])) == [("a", None, 1)]


def test_hot_key_is_counted_before_the_shuffle(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(key_violations(df, ["l_orderkey"]), capsys)
    assert plan.index("HashAggregate") < plan.index("Exchange")
    assert plan.count("Exchange\n") == 1


def test_long_text_is_listed(spark, players):
    df = players({"short_name": "x" * 101}, {"short_name": "é" * 100},
                 {"preferred_foot": "x" * 11, "full_name": "g"})
    got = rows_of(length_violations(df, {"short_name": 100, "preferred_foot": 10}, ["full_name"]))
    assert got == [("f", "short_name", "x" * 101, 101, 100), ("g", "preferred_foot", "x" * 11, 11, 10)]


def test_report_has_a_row_per_check(spark, players):
    df = master(players, {"full_name": "a"}, {"full_name": "a", "club_name": "c" * 200})
    report = dict(rows_of(contract_report(df, MASTER)))
    assert report["unique key"] == 1
    assert report["length of club_name over 100"] == 1
    assert report["length of full_name over 255"] == 0
    assert len(report) == 1 + len(MASTER.widths)


def test_contract_without_text_columns(spark):
    table = replace(MASTER, columns=tuple(c for c in MASTER.columns if c.name == "age"),
                    key=("age",))
    df = spark.createDataFrame([(1,), (2,)], "age int")
    assert rows_of(contract_report(df, table)) == [("unique key", 0)]
    require_contract(df, table)


def test_good_rows_pass(spark, players):
    require_contract(master(players, {"full_name": "a"}, {"full_name": "b"}), MASTER)


@pytest.mark.parametrize("rows,message", [
    ([{}, {}], "unique key (1 violations)"),
    ([{"full_name": None}], "unique key (1 violations)"),
    ([{"full_name": "x" * 256}], "length of full_name over 255 (1 violations)")])
def test_bad_rows_are_refused(spark, players, rows, message):
    with pytest.raises(ContractError, match=message.replace("(", r"\(").replace(")", r"\)")):
        require_contract(master(players, *rows), MASTER)


def test_wrong_type_and_missing_column_are_refused(spark, players):
    df = master(players, {})
    with pytest.raises(ContractError, match="age is string, not int"):
        require_contract(df.withColumn("age", df["age"].cast("string")), MASTER)
    with pytest.raises(MissingColumnsError, match="wage_eur"):
        require_contract(df.drop("wage_eur"), MASTER)


def test_rows_are_counted_by_the_action(spark):
    df, seen = counted(spark.range(1234))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 1234
