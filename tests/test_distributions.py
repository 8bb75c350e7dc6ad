from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import plan_of, rows_of
from tallyroom.operators.distributions import category_counts, histogram, options, shares

NAN, INF = float("nan"), float("inf")


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_counts_skip_null_keys_and_sort(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert ordered(category_counts(df, "k")) == [("c", 2), ("a", 1), ("b", 1)]
    assert category_counts(df, "k", "key", "rows").columns == ["key", "rows"]


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    got = ordered(shares(df, "k"))
    assert [(k, n) for k, n, _ in got] == [("a", 2), ("b", 1)]
    assert sum(s for *_, s in got) == pytest.approx(1)
    assert shares(df.where("k = 'zz'"), "k").count() == 0


def test_share_total_is_no_single_task_window(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert "Window" not in plan_of(shares(df, "l_linestatus"), capsys)


def test_options(spark):
    df = spark.createDataFrame([("b",), ("All",), (None,), ("b",)], "k string")
    assert ordered(options(df, "k")) == [(0, "All"), (1, "All"), (1, "b")]
    assert ordered(options(df.where("k is null"), "k")) == [(0, "All")]


def nice_widths(smallest):
    exponent = -12
    while exponent < 20:
        for m in (1, 2, 5):
            width = float(f"{m}e{exponent}")
            if width >= smallest:
                yield m, exponent
        exponent += 1


def brute_histogram(values, nbins, smallest):
    """In exact fractions of the decimal text of each value."""
    if not values:
        return []
    exact = [Fraction(str(v)) for v in values]
    lo, hi = min(exact), max(exact)
    if lo == hi:
        width = Fraction(1)
    else:
        width = next(w for w in (Fraction(m) * Fraction(10) ** e for m, e in nice_widths(smallest))
                     if hi // w - lo // w + 1 <= nbins)
    return sorted(Counter(v // width for v in exact).items())


RELAXED = settings(max_examples=25, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])


@RELAXED
@given(values=st.lists(st.integers(-10 ** 6, 10 ** 6) | st.integers(0, 60), max_size=40),
       nbins=st.integers(2, 30))
def test_whole_number_histogram(spark, values, nbins):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    got = ordered(histogram(df, "v", nbins))
    assert [(b, n) for b, _, n in got] == brute_histogram(values, nbins, 1.0)
    assert sum(n for *_, n in got) == len(values) and len(got) <= nbins


@RELAXED
@given(values=st.lists(st.integers(-10 ** 5, 10 ** 5).map(lambda k: k / 1000)
                       | st.integers(0, 50).map(lambda k: k / 100), max_size=40),
       nbins=st.integers(2, 30))
def test_fraction_histogram(spark, values, nbins):
    df = spark.createDataFrame([(v,) for v in values] + [(NAN,), (INF,), (None,)], "v double")
    got = ordered(histogram(df, "v", nbins))
    assert [(b, n) for b, _, n in got] == brute_histogram(values, nbins, 0.0)
    assert len(got) <= nbins


def test_constant_column_is_one_bin(spark):
    for kind in ("int", "double", "decimal(5,1)"):
        df = spark.range(5).selectExpr(f"cast(7 as {kind}) as v")
        assert ordered(histogram(df, "v")) == [(7, 7, 5)]


def test_no_known_value_is_no_bin(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert histogram(df, "v").count() == 0
    assert histogram(df, "v", fill_empty=True).count() == 0


def test_exact_beyond_double_precision(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(big,), (big + 1,), (big + 9,)], "v bigint")
    assert ordered(histogram(df, "v")) == [(big, big, 1), (big + 1, big + 1, 1),
                                           (big + 9, big + 9, 1)]


def test_decimal_edges_are_clean(spark):
    df = spark.createDataFrame([(k / 10,) for k in range(10)], "v double")
    assert [(s, n) for _, s, n in ordered(histogram(df, "v", 10))] == [
        (k / 10, 1) for k in range(10)]


def test_values_on_an_edge_start_their_bin(spark):
    df = spark.createDataFrame([(k / 100,) for k in range(100)], "v double")
    assert [(s, n) for _, s, n in ordered(histogram(df, "v", 100))] == [
        (k / 100, 1) for k in range(100)]


def test_empty_bins_can_be_filled(spark):
    df = spark.createDataFrame([(1,), (4,)], "v int")
    assert ordered(histogram(df, "v", fill_empty=True)) == [
        (1, 1, 1), (2, 2, 0), (3, 3, 0), (4, 4, 1)]


def test_bad_bin_count(spark):
    with pytest.raises(ValueError):
        histogram(spark.range(3), "id", 1)


def test_histogram_scans_one_column(spark, sf_dir, capsys):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(histogram(df, "l_extendedprice"), capsys)
    assert plan.count("ReadSchema: struct<l_extendedprice:double>") == plan.count("ReadSchema")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_of_counts(spark):
    assert rows_of(category_counts(spark.range(0).selectExpr("'a' as k"), "k")) == []


def test_a_histogram_of_the_whole_64_bit_range(spark):
    from tallyroom.operators.distributions import histogram

    ends = [-2**63, -3 * 10**18, 0, 3 * 10**18, 2**63 - 1]
    got = histogram(spark.createDataFrame([(v,) for v in ends], "v bigint"), "v", 25).collect()
    assert sum(r["n"] for r in got) == len(ends)
    assert [r["bin"] for r in got] == sorted(r["bin"] for r in got) and len(got) <= 25
