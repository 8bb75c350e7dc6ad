"""The dashboard by one aggregate and by a cube; both store their groups and read them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import fused
from ..plans.dashboard import Roles, long_form
from ..session import scratch_dir
from ..sinks.parquet import write_parquet
from ..sources.parquet import read_parquet
from .registry import ORACLES, query, table
from .storage import ORDER_ROLES

CUBE_ROLES = Roles(key="l_orderkey", label="l_returnflag", rating="l_quantity",
                   potential="l_linenumber", value="l_extendedprice", age="l_linenumber",
                   region="l_returnflag", category="l_linestatus", group="l_suppkey")
CUBE_FILTERS = {"all": (None, None), "range": ((10, 40), None), "one": ((5, 30), "R")}


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(spark, label)
    write_parquet(df, path)
    return read_parquet(spark, path, df.schema)


def _numbers(views: dict[str, DataFrame], roles: Roles) -> DataFrame:
    """The views in long form, means and shares to four places."""
    one_row = views["summary"].select(F.lit("rows").alias("k"), "n", F.round("mean", 4).alias("mean"))
    named = {
        "count": (one_row, "k", "n"), "mean": (one_row, "k", "mean"),
        "top_entity": (views["top_entity"], roles.key, roles.value),
        "age_histogram": (views["age_histogram"], "bin", "n"),
        "rating_histogram": (views["rating_histogram"], "bin", "n"),
        "category_shares": (views["category_shares"].withColumn("share", F.round("share", 4)),
                            "k", "share"),
        "region_counts": (views["region_counts"], roles.region, "count"),
        "top_groups": (views["top_groups"].withColumn("mean", F.round("mean", 4)),
                       roles.group, "mean"),
    }
    if "rating_value_sample" in views:
        named["rating_value_sample"] = (views["rating_value_sample"], roles.label, roles.value)
        named["age_potential_sample"] = (views["age_potential_sample"], roles.label, roles.potential)
    return long_form(named)


@query(ORACLES["dashboard_bundle"])
def dashboard_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view of ``dashboard_bundle`` out of one aggregate over one filtered scan."""
    facts = fused.dashboard_facts(table(spark, sf_dir, "orders"), ORDER_ROLES, (50_000, 400_000))
    return _numbers(fused.views(_stored(spark, facts, "facts"), ORDER_ROLES), ORDER_ROLES)


def _cube_sql(name: str, condition: str) -> str:
    # Widths by the rule of the histograms: l_quantity takes 5 or 2, l_linenumber 1.
    return f"""
SELECT '{name}' AS filter, * FROM (
WITH f AS (SELECT * FROM lineitem WHERE {condition}),
edges AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM f),
width AS (SELECT min(w) AS w FROM edges CROSS JOIN (VALUES (1.0E0), (2.0E0), (5.0E0), (10.0E0)) AS c(w)
          WHERE floor(hi / w) - floor(lo / w) + 1 <= 25)
SELECT 'count' AS view, 'rows' AS key, CAST(count(*) AS DOUBLE) AS number FROM f
UNION ALL SELECT 'mean', 'rows', round(avg(l_quantity), 4) FROM f
UNION ALL SELECT * FROM (SELECT 'top_entity', CAST(l_orderkey AS VARCHAR), l_extendedprice FROM f
  ORDER BY l_extendedprice DESC, l_orderkey LIMIT 1) t
UNION ALL SELECT 'age_histogram', CAST(l_linenumber AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM f GROUP BY l_linenumber
UNION ALL SELECT 'rating_histogram', CAST(CAST(floor(l_quantity / w) AS BIGINT) AS VARCHAR),
  CAST(count(*) AS DOUBLE) FROM f CROSS JOIN width GROUP BY 2
UNION ALL SELECT 'category_shares', k, round(n * 1.0E0 / sum(n) OVER (), 4)
  FROM (SELECT l_linestatus AS k, count(*) AS n FROM f GROUP BY 1) t
UNION ALL SELECT 'region_counts', l_returnflag, CAST(count(*) AS DOUBLE) FROM f GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_groups', CAST(l_suppkey AS VARCHAR), round(avg(l_quantity), 4)
  FROM f GROUP BY l_suppkey ORDER BY avg(l_quantity) DESC, l_suppkey LIMIT 15) t
) {name}_views"""


@query(" UNION ALL ".join([
    _cube_sql("all", "true"), _cube_sql("range", "l_quantity BETWEEN 10 AND 40"),
    _cube_sql("one", "l_quantity BETWEEN 5 AND 30 AND l_returnflag = 'R'")]))
def dashboard_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views under three filters, each from the stored cube alone."""
    cube = _stored(spark, fused.build_cube(table(spark, sf_dir, "lineitem"), CUBE_ROLES), "cube")
    out = None
    for name, (rating, region) in CUBE_FILTERS.items():
        part = _numbers(fused.cube_views(cube, CUBE_ROLES, rating, region), CUBE_ROLES).select(
            F.lit(name).alias("filter"), "view", "key", "number")
        out = part if out is None else out.unionByName(part)
    return out
