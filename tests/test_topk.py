import hashlib
import random

from conftest import plan_of
from tallyroom.operators.topk import sample_rows, top_groups

NAN = float("nan")


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_groups_of_unknowns_come_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", NAN), ("c", 5.0), (None, 9.0)],
                               "k string, v double")
    assert ordered(top_groups(df, "k", "v")) == [("c", 5.0), ("b", 1.0), ("a", None)]
    assert ordered(top_groups(df, "k", "v", 1)) == [("c", 5.0)]


def test_ties_by_key(spark):
    df = spark.createDataFrame([(k, 1) for k in "dbca"], "k string, v int")
    assert [k for k, _ in ordered(top_groups(df, "k", "v", 3))] == ["a", "b", "c"]


def test_top_groups_plan(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(top_groups(df, "l_suppkey", "l_quantity"), capsys)
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange\n") == 1


def brute_sample(keys, n, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))[:n]


def test_sample_is_exact_in_every_partitioning(spark):
    keys = list(range(20_000))
    random.Random(5).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    for n in (1, 10, 1500, 19_999):
        want = brute_sample(keys, n, 42)
        for parts in (1, 5):
            assert [k for k, in ordered(sample_rows(df.repartition(parts), ["k"], ["k"], n))] == want


def test_sample_is_exact_where_the_cut_is_deep(spark):
    df = spark.range(300_000)
    for n in (5, 100):
        got = [k for k, in ordered(sample_rows(df, ["id"], ["id"], n, 7))]
        assert got == brute_sample(range(300_000), n, 7)


def test_sample_over_several_keys(spark):
    df = spark.createDataFrame([(k % 7, str(k), None) for k in range(500)],
                               "a int, b string, c string")
    want = sorted(((k % 7, str(k)) for k in range(500)), key=lambda r: hashlib.md5(
        f"42:{r[0]}\x1f{r[1]}\x1f".encode()).hexdigest())[:20]
    assert ordered(sample_rows(df, ["a", "b", "c"], ["a", "b"], 20)) == want


def test_small_and_empty_frames_are_returned_whole(spark):
    df = spark.range(10)
    assert sorted(r["id"] for r in sample_rows(df, ["id"], ["id"]).collect()) == list(range(10))
    assert sample_rows(df.where("id > 99"), ["id"], ["id"]).count() == 0


def test_repeated_keys_still_give_n_rows(spark):
    """A key that holds every row has one hash; the cut must keep enough rows."""
    df = spark.range(5000).selectExpr("'same' as k", "id")
    assert sample_rows(df, ["k"], ["id"], 1500).count() == 1500
    assert ordered(sample_rows(df, ["k"], ["id"], 3)) == [(0,), (1,), (2,)]


def test_seeds_differ_and_repeat(spark):
    df = spark.range(5000)
    a, b, again = (ordered(sample_rows(df, ["id"], ["id"], 50, s)) for s in (1, 2, 1))
    assert a == again and a != b


def test_sample_reads_only_its_columns(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(sample_rows(df, ["o_orderkey"], ["o_totalprice"], 1500), capsys)
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
