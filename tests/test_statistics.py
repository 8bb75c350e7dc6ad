"""Bounds from footers against bounds by scanning."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import plan_of, rows_of
from tallyroom.operators.summary import bounds
from tallyroom.sources.statistics import footer_bounds, stored_bounds, stored_rows

NAN, INF = float("nan"), float("inf")
COLUMNS = {
    "plain": pa.array([1.5, -2.5, None]),
    "nan": pa.array([1.5, NAN, 3.9]),
    "only nan": pa.array([NAN, NAN]),
    "unknown": pa.array([None, None], pa.float64()),
    "none": pa.array([], pa.float64()),
    "infinite": pa.array([1.0, INF, -INF, -7.0]),
    "only infinite": pa.array([INF]),
    "huge": pa.array([1e300, -1e300]),
    "single": pa.array([0.5, 99.5], pa.float32()),
    "small": pa.array([-128, 127], pa.int8()),
    "whole": pa.array([2**63 - 1, -(2**63), None]),
    "exact": pa.array([1, 2], pa.decimal128(10, 2)),
}


def answer(df):
    return [(r.lo, r.hi) for r in df.collect()]


@pytest.mark.parametrize("name", COLUMNS)
@pytest.mark.parametrize("statistics", [True, False])
def test_footers_answer_like_a_scan(spark, tmp_path, name, statistics):
    for i, values in enumerate((COLUMNS[name], COLUMNS[name][:1])):
        pq.write_table(pa.table({"a.b": values}), tmp_path / f"{i}.parquet", row_group_size=2,
                       write_statistics=statistics)
    path = str(tmp_path)
    rows = spark.read.parquet(path)
    assert answer(stored_bounds(spark, path, "a.b")) == answer(bounds(rows, "a.b"))
    assert stored_rows(spark, path) == rows.count()


def test_files_of_spark_with_nan_and_without_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.createDataFrame([(1.0,), (NAN,), (3.5,)], "v double").repartition(4)
    rows.write.parquet(path)
    rows.where("v > 5 and not isnan(v)").write.mode("append").parquet(path)
    assert rows_of(stored_bounds(spark, path, "v")) == [(1, 3)]
    assert stored_rows(spark, path) == 3


def test_only_footers_are_read_and_the_session_is_left_alone(spark, sf_dir, capsys):
    before = spark.conf.getAll
    plan = plan_of(footer_bounds(spark, f"{sf_dir}/lineitem.parquet", "l_extendedprice"), capsys)
    assert "PushedAggregation: [MIN(l_extendedprice), MAX(l_extendedprice)]" in plan
    assert spark.conf.getAll == before


def test_a_file_that_is_not_there_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stored_bounds(spark, str(tmp_path / "nothing"), "v")
