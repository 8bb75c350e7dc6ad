import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from tallyroom.operators.dedupe import distinct_rows, keep_best, keep_ranked

BOTH = pytest.mark.parametrize("keep", [keep_best, keep_ranked])


def expected(rows):
    """Brute force over (key, rating, tie, text) tuples."""
    best = {}
    for row in rows:
        key, rating, tie, text = row
        order = (rating is None, -(rating or 0), tie is None, tie or 0, text is None, text or "")
        if key not in best or order < best[key][0]:
            best[key] = (order, row)
    return sorted((row for _, row in best.values()), key=str)


@BOTH
@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)"])
def test_against_brute_force(spark, keep, kind):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < .4 else f"k{rng.randrange(40)}",
             rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]),
             rng.choice([None, "a", "B", "b"])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, r int, t int, s string").withColumn(
        "r", F.col("r").cast(kind))
    want = expected(rows)
    for parts in (1, 3, 8):
        got = keep(df.repartition(parts), ["k"], ["r"]).withColumn("r", F.col("r").cast("int"))
        assert rows_of(got) == want


@BOTH
def test_null_rating_loses(spark, players, keep):
    df = players({"overall": None, "short_name": "a"}, {"overall": 70, "short_name": "b"})
    assert [r["short_name"] for r in keep(df, ["full_name"], ["overall"]).collect()] == ["b"]


@BOTH
def test_nan_rating_loses(spark, keep):
    df = spark.createDataFrame([("k", float("nan"), 1), ("k", 2.0, 2)], "k string, r double, t int")
    assert rows_of(keep(df, ["k"], ["r"])) == [("k", 2.0, 2)]


@BOTH
def test_smallest_int_is_a_rating(spark, keep):
    low = -2 ** 31
    df = spark.createDataFrame([("k", low, 1), ("k", None, 2)], "k string, r int, t int")
    assert rows_of(keep(df, ["k"], ["r"])) == [("k", low, 1)]


@BOTH
def test_keys_are_exact(spark, players, keep):
    df = players({"full_name": " Ed "}, {"full_name": "Ed"}, {"full_name": "ED"})
    assert keep(df, ["full_name"], ["overall"]).count() == 3


@BOTH
def test_given_tie_break_comes_first(spark, keep):
    df = spark.createDataFrame([("k", 1, "a", 9), ("k", 1, "z", 3)],
                               "k string, r int, s string, id int")
    assert keep(df, ["k"], ["r"], ["id"]).first()["s"] == "z"
    assert keep(df, ["k"], ["r"]).first()["s"] == "a"


def test_text_rating_and_unorderable_columns(spark):
    df = spark.createDataFrame([("k", "a", {"x": 1}), ("k", "b", {"x": 2})],
                               "k string, r string, m map<string,int>")
    assert [r["r"] for r in keep_best(df, ["k"], ["r"]).collect()] == ["b"]


@BOTH
def test_schema_is_kept(spark, players, keep):
    df = players({})
    out = keep(df, ["full_name"], ["overall"])
    assert out.columns == df.columns and out.dtypes == df.dtypes


def test_one_shuffle_after_a_partial_reduction(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").drop("l_shipdate")
    plan = plan_of(keep_best(df, ["l_orderkey"], ["l_quantity"]), capsys)
    assert plan.count("Exchange\n") == 1 and "partial_min" in plan
    plan = plan_of(keep_ranked(df, ["l_orderkey"], ["l_quantity"]), capsys)
    assert plan.count("Exchange\n") == 1 and plan.count("WindowGroupLimit") >= 2


def test_distinct_after_dedupe_needs_no_second_shuffle(spark, players, capsys):
    best = keep_best(players({}, {}), ["full_name"], ["overall"])
    assert plan_of(distinct_rows(best, ["full_name", "age"]), capsys).count("Exchange\n") == 1


def test_distinct_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert rows_of(distinct_rows(df, ["k"])) == [("a",), (None,)]
    assert rows_of(distinct_rows(df, ["k"], known_only=True)) == [("a",)]
