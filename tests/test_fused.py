"""The fused dashboard and the cube against the views one by one."""

import re

import pytest

from conftest import plan_of, rows_of
from tallyroom.operators.distributions import histogram
from tallyroom.operators.fused import WHOLE, grouped_together, view_of
from tallyroom.plans.dashboard import Dashboard, Roles
from tallyroom.plans import fused
from tallyroom.plans.fused import build_cube, cube_views, dashboard_facts, views

FILTERS = [{}, {"rating": (62, 80)}, {"region": "Spain"}, {"rating": (1, 2)},
           {"rating": (60, 75), "region": "France"}]
SHARED = ["summary", "category_shares", "region_counts", "top_groups", "age_histogram",
          "rating_histogram"]


@pytest.fixture
def table(players):
    rows = [{"full_name": f"p{i}", "overall": None if i % 13 == 0 else 60 + i % 30,
             "age": None if i % 7 == 0 else 16 + i % 40, "nationality": [None, "Spain", "France"][i % 3],
             "club_name": None if i % 11 == 0 else f"c{i % 20}", "potential": i % 9,
             "preferred_foot": ["Left", "Right", None][i % 5 % 3],
             "value_eur": float("nan") if i % 10 == 0 else float(i % 50)} for i in range(600)]
    return players(*rows)


def parted(df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}")
    return df.sparkSession.read.parquet(f"{tmp_path}/{name}")


@pytest.mark.parametrize("filters", FILTERS)
def test_fused_views_are_the_single_views(spark, table, tmp_path, filters):
    facts = parted(dashboard_facts(table, **filters), tmp_path, "facts")
    cube = parted(build_cube(table), tmp_path, "cube")
    single = Dashboard(table, keep=None).views(**filters)
    for found in (views(facts), cube_views(cube, **filters)):
        for name in SHARED:
            assert found[name].columns == single[name].columns, name
            assert rows_of(found[name]) == rows_of(single[name]), name
        top = single["top_entity"].select("full_name", "short_name", "value_eur")
        assert rows_of(found["top_entity"]) == rows_of(top)
    for name in ("rating_value_sample", "age_potential_sample"):
        assert rows_of(views(facts)[name].select(*single[name].columns)) == rows_of(single[name])


def test_no_rows_give_empty_views(spark, table, tmp_path):
    facts = parted(dashboard_facts(table.where("false")), tmp_path, "facts")
    cube = parted(build_cube(table.where("false")), tmp_path, "cube")
    for found in (views(facts), cube_views(cube)):
        assert [tuple(r) for r in found["summary"].collect()] == [(0, None, None, None)]
        assert all(found[name].count() == 0 for name in [*SHARED[1:], "top_entity"])


def test_a_sample_holds_every_one_of_equal_rows(spark, players, tmp_path):
    table = players(*[{"full_name": "same"}] * 2000)
    facts = parted(dashboard_facts(table), tmp_path, "facts")
    assert views(facts)["rating_value_sample"].count() == 1500


def test_facts_take_two_scans_and_one_shuffle_of_groups(spark, table, tmp_path, capsys):
    stored = parted(table, tmp_path, "table")
    plan = plan_of(dashboard_facts(stored, rating=(60, 80)), capsys)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 2
    assert plan.count("Exchange hashpartitioning") + plan.count("Arguments: hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(overall), GreaterThanOrEqual(overall,60)" in plan
    cube = parted(build_cube(stored), tmp_path, "cube")
    for view in cube_views(cube, rating=(60, 80)).values():
        assert f"{tmp_path}/table" not in plan_of(view, capsys)


def test_groupings_do_not_mix(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "x int, y string")
    from pyspark.sql import functions as F

    got = grouped_together(df, {"by_x": ["x"], "by_y": ["y"]}, {"n": F.count(F.lit(1))})
    assert rows_of(got) == rows_of(spark.createDataFrame(
        [(WHOLE, None, None, 3), ("by_x", 1, None, 2), ("by_x", None, None, 1), ("by_y", None, "a", 2),
         ("by_y", None, "b", 1)], "view string, x int, y string, n bigint"))
    assert rows_of(view_of(got, "by_x", ["x"]).select("x", "n")) == [(1, 2)]
    with pytest.raises(ValueError):
        grouped_together(df, {"a": ["x"], "b": ["x"]}, {"n": F.count(F.lit(1))})


def test_a_weighted_histogram_counts_rows(spark):
    df = spark.createDataFrame([(1, 3), (30, 2), (None, 9)], "v int, n bigint")
    plain = spark.createDataFrame([(1,)] * 3 + [(30,)] * 2 + [(None,)] * 9, "v int")
    assert rows_of(histogram(df, "v", weight="n")) == rows_of(histogram(plain, "v"))


@pytest.mark.parametrize("buckets", [1, 3])
def test_tops_of_a_cube_are_right_when_cells_share_a_bucket(spark, table, tmp_path, monkeypatch, buckets):
    monkeypatch.setattr(fused, "_BUCKETS", buckets)
    cube = parted(build_cube(table), tmp_path, "cube")
    for filters in (FILTERS[0], FILTERS[4]):
        top = Dashboard(table, keep=None).views(**filters)["top_entity"]
        assert rows_of(cube_views(cube, **filters)["top_entity"]) == rows_of(
            top.select("full_name", "short_name", "value_eur")), filters
    cells = view_of(cube, WHOLE, []).select("region", "rating", "n")
    assert rows_of(cells) == rows_of(table.groupBy("nationality", "overall").count())


def test_all_rows_of_a_cube_are_grouped_without_a_sort(spark, table, tmp_path, capsys):
    # A sort of all rows, once a grouping, in the tasks that read them spills many times the input.
    plan = plan_of(build_cube(parted(table, tmp_path, "table")), capsys)
    above = re.findall(r"(\w+) \(\d+\)\n((?:[ :+-]*(?:Project|Filter|Expand) \(\d+\)\n)*)[ :+-]*Scan parquet",
                       plan)
    assert "HashAggregate" in {name for name, _ in above}
    # What is sorted are the rows that pass the bounds.
    assert all("Filter" in between for name, between in above if name == "Sort")


def test_few_rows_are_looked_at_for_the_tops(spark, players):
    table = players(*[{"full_name": f"p{i}", "overall": 60 + i % 3, "value_eur": float(i % 97)}
                      for i in range(600)])
    rows = table.selectExpr("nationality AS region", "overall AS rating", "-value_eur AS negative")
    kept = rows.where(rows["negative"] <= fused._weakest_top(rows, ["region", "rating"]))
    assert {tuple(r) for r in kept.collect()} == {("N", r, -96.0) for r in (60, 61, 62)}
