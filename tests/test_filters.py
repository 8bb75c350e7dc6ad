from conftest import plan_of, rows_of
from tallyroom.operators.filters import emptiness, filter_rows, page


def frame(spark):
    return spark.createDataFrame(
        [(1, 1.0, "All"), (2, float("nan"), "x"), (3, None, "x"), (4, 9.0, None)],
        "id int, v double, k string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_range_is_closed_and_drops_unknowns(spark):
    df = frame(spark)
    assert ids(filter_rows(df, {"v": (1.0, 9.0)})) == [1, 4]
    assert ids(filter_rows(df, {"v": (1.5, float("inf"))})) == [4]
    assert ids(filter_rows(df, {"v": (2.0, 8.0)})) == []


def test_none_is_no_filter(spark):
    df = frame(spark)
    assert ids(filter_rows(df)) == [1, 2, 3, 4]
    assert ids(filter_rows(df, {"v": None}, {"k": None})) == [1, 2, 3, 4]


def test_a_value_spelt_like_the_sentinel_can_be_chosen(spark):
    assert ids(filter_rows(frame(spark), equals={"k": "All"})) == [1]


def test_conjunction(spark):
    assert ids(filter_rows(frame(spark), {"id": (2, 4)}, {"k": "x"})) == [2, 3]


def test_emptiness(spark):
    df = frame(spark)
    assert rows_of(emptiness(df)) == [(False,)]
    assert rows_of(emptiness(filter_rows(df, {"id": (7, 9)}))) == [(True,)]


def test_filters_reach_the_parquet_reader(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    plan = plan_of(filter_rows(df, {"p_size": (10, 40)}, {"p_type": "PROMO"}), capsys)
    for pushed in ("GreaterThanOrEqual(p_size,10)", "LessThanOrEqual(p_size,40)",
                   "EqualTo(p_type,PROMO)"):
        assert pushed in plan


def test_pages_cover_every_row_once(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_nationkey", "c_custkey")
    order, seen, after = ["c_nationkey", "c_custkey"], [], None
    while rows := page(df, order, 700, after).collect():
        seen += [tuple(r) for r in rows]
        after = seen[-1]
    assert seen == sorted(tuple(r) for r in df.collect())
    assert "TakeOrderedAndProject" in plan_of(page(df, order, 700, (3, 5)), capsys)


def test_pages_end_with_unknown_keys(spark):
    from tallyroom.operators.filters import page

    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d")], "k int, n string")
    seen, after = [], None
    while rows := page(df, ["k", "n"], 1, after).collect():
        seen += [tuple(r) for r in rows]
        after = seen[-1]
    assert seen == [(1, "a"), (2, "c"), (None, "b"), (None, "d")]
