"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry_point
from tallyroom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = oracle.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert oracle.compare(df, duck, entry_point.oracle_sql()[name]) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 15


@pytest.mark.parametrize("name", ["dedupe_best_large", "sample_xy_value", "histogram_value",
                                  "share_of_total", "top_groups", "pk_violations"])
def test_partitioning_never_changes_a_result(spark, sf_dir, duck, name, tmp_path):
    """The same rows in 1, 3 and 8 files, in another order each time."""
    for parts in (1, 3, 8):
        for table in ("part", "orders", "lineitem"):
            (spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(parts)
             .write.parquet(str(tmp_path / str(parts) / f"{table}.parquet")))
        df = entry_point.queries()[name](spark, str(tmp_path / str(parts)))
        oracle.compare(df, duck, entry_point.oracle_sql()[name])
