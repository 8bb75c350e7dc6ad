import pytest

from conftest import plan_of, rows_of
from tallyroom.operators.distributions import category_counts
from tallyroom.operators.region import place, unplaced


def test_every_counted_name_is_kept(spark):
    df = spark.createDataFrame([("x",), ("x",), ("nowhere",), (None,)], "name string")
    dim = spark.createDataFrame([("x", "XX"), ("y", "YY")], "name string, code string")
    counts = category_counts(df, "name", "name", "n")
    assert rows_of(place(counts, dim, "name")) == [("nowhere", 1, None), ("x", 2, "XX")]
    assert rows_of(unplaced(counts, dim, "name")) == [("nowhere", 1)]


def test_broadcast_follows_the_size_limit(spark, sf_dir, capsys):
    """A dimension over the limit is shuffled, and the rows are counted before that."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    dim = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumnRenamed(
        "n_nationkey", "c_nationkey")
    counts = category_counts(rows, "c_nationkey", "c_nationkey", "n")
    assert "BroadcastHashJoin" in plan_of(place(counts, dim, "c_nationkey"), capsys)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (place, unplaced):
            plan = plan_of(join(counts, dim, "c_nationkey"), capsys)
            assert "SortMergeJoin" in plan and "partial_count" in plan
            assert plan.index("HashAggregate") < plan.index("Scan parquet")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_repeated_key_of_the_dimension_fails(spark):
    counts = spark.createDataFrame([("x", 2), (None, 1)], "name string, n int")
    dim = spark.createDataFrame([("x", "XX"), (None, "a"), (None, "b")], "name string, code string")
    assert rows_of(place(counts, dim, "name")) == rows_of(
        spark.createDataFrame([("x", 2, "XX"), (None, 1, None)], "name string, n int, code string"))
    with pytest.raises(Exception, match="holds a key of name twice"):
        place(counts, dim.union(dim), "name").collect()
