"""Summary, distribution, top-k, sample and lookup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_best
from ..operators.distributions import category_counts, histogram, options, shares
from ..operators.filters import filter_rows
from ..operators.region import place, unplaced
from ..operators import summary
from ..operators.clean import drop_incomplete
from ..operators.topk import sample_rows
from ..operators import topk
from .registry import query, table


@query("SELECT CAST(min(p_size) AS BIGINT) AS lo, CAST(max(p_size) AS BIGINT) AS hi FROM part")
def value_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.bounds(table(spark, sf_dir, "part"), "p_size")


@query("""
SELECT CAST(trunc(min(l_extendedprice)) AS BIGINT) AS lo,
       CAST(trunc(max(l_extendedprice)) AS BIGINT) AS hi FROM lineitem
""")
def value_bounds_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.bounds(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("""
SELECT count(*) AS n, round(avg(p_size), 6) AS mean, min(p_size) AS lo, max(p_size) AS hi
FROM part WHERE p_size BETWEEN 10 AND 40 AND p_type = 'PROMO'
""")
def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_rows(table(spark, sf_dir, "part"), {"p_size": (10, 40)}, {"p_type": "PROMO"})
    return summary.summarise(rows, "p_size").withColumn("mean", F.round("mean", 6))


@query("""
SELECT format('{:,}', count(*)) AS count_label, printf('%.1f', avg(l_quantity)) AS mean_label,
       '€' || format('{:,.0f}', max(l_extendedprice)) AS top_label
FROM lineitem WHERE l_quantity BETWEEN 5 AND 45
""")
def metric_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_rows(table(spark, sf_dir, "lineitem"), {"l_quantity": (5, 45)})
    return summary.metric_labels(rows, "l_quantity", "l_extendedprice")


@query("""
SELECT p_name, p_partkey, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 40
ORDER BY p_retailprice DESC NULLS LAST, p_partkey ASC NULLS LAST LIMIT 1
""")
def top_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_rows(table(spark, sf_dir, "part"), {"p_size": (10, 40)})
    return summary.top_row(rows, "p_retailprice", ["p_partkey"]).select(
        "p_name", "p_partkey", "p_retailprice")


@query("""
SELECT 0 AS pos, 'All' AS label
UNION ALL SELECT DISTINCT 1 AS pos, p_type AS label FROM part WHERE p_type IS NOT NULL
""")
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options(table(spark, sf_dir, "part"), "p_type")


@query("""
SELECT l_returnflag AS k, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL
GROUP BY l_returnflag
""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("""
SELECT k, n, round(n * 1.0E0 / sum(n) OVER (), 6) AS share FROM (
  SELECT l_linestatus AS k, count(*) AS n FROM lineitem WHERE l_linestatus IS NOT NULL
  GROUP BY l_linestatus) t
""")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(table(spark, sf_dir, "lineitem"), "l_linestatus").withColumn(
        "share", F.round("share", 6))


def _customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_counts(table(spark, sf_dir, "customer"), "c_nationkey", "c_nationkey", "cnt")


@query("""
SELECT n.n_name AS nationality, c.n AS cnt
FROM (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey IS NOT NULL
      GROUP BY c_nationkey) c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def count_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return place(_customer_counts(spark, sf_dir), nations, "c_nationkey").select(
        F.col("n_name").alias("nationality"), "cnt")


@query("""
SELECT c_nationkey, count(*) AS cnt FROM customer
WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey <> 0)
GROUP BY c_nationkey
""")
def unmatched_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "nation").where("n_regionkey <> 0").withColumnRenamed(
        "n_nationkey", "c_nationkey")
    return unplaced(_customer_counts(spark, sf_dir), known, "c_nationkey")


@query("""
SELECT CAST(floor(p_size / 5.0E0) AS BIGINT) AS bin,
       CAST(floor(p_size / 5.0E0) AS BIGINT) * 5 AS bin_start, count(*) AS n
FROM part WHERE p_size IS NOT NULL GROUP BY 1, 2
""")
def histogram_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(table(spark, sf_dir, "part"), "p_size")


@query("""
SELECT CAST(l_partkey % 19 - 9 AS BIGINT) AS bin,
       CAST(l_partkey % 19 - 9 AS BIGINT) * 1000000000000000000 AS bin_start, count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def histogram_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers over nearly all 64 bits."""
    rows = table(spark, sf_dir, "lineitem").select(
        ((F.col("l_partkey").cast("bigint") % 19 - 9) * 10**18).alias("v"))
    return histogram(rows, "v")


_WIDTH = """
WITH b AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}),
w AS (SELECT min(c.w) AS w FROM b CROSS JOIN (VALUES (1.0E0), (2.0E0), (5.0E0), (10.0E0),
  (20.0E0), (50.0E0), (100.0E0), (200.0E0), (500.0E0), (1000.0E0), (2000.0E0), (5000.0E0),
  (10000.0E0), (20000.0E0), (50000.0E0), (100000.0E0)) AS c(w)
  WHERE floor(b.hi / c.w) - floor(b.lo / c.w) + 1 <= 25)
"""


@query(_WIDTH.format(c="l_extendedprice", t="lineitem") + """
SELECT CAST(floor(l_extendedprice / w.w) AS BIGINT) AS bin,
       CAST(floor(l_extendedprice / w.w) * w.w AS DOUBLE) AS bin_start, count(*) AS n
FROM lineitem CROSS JOIN w WHERE l_extendedprice IS NOT NULL GROUP BY 1, 2
""")
def histogram_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("""
SELECT CAST(round(l_discount * 200) AS BIGINT) AS bin,
       round(l_discount * 200) / 200 AS bin_start, count(*) AS n
FROM lineitem GROUP BY 1, 2
UNION ALL
SELECT CAST(i AS BIGINT), i / 200.0E0, 0 FROM range(0, 21) r(i)
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE round(l_discount * 200) = i)
""")
def histogram_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins narrower than 1, with the empty ones between the used ones."""
    return histogram(table(spark, sf_dir, "lineitem"), "l_discount", fill_empty=True)


@query("""
SELECT p_brand, round(avg(p_size), 6) AS mean FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY avg(p_size) DESC NULLS LAST, p_brand ASC NULLS LAST LIMIT 15
""")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_groups(table(spark, sf_dir, "part"), "p_brand", "p_size").withColumn(
        "mean", F.round("mean", 6))


@query("""
SELECT l_suppkey, round(avg(l_quantity), 6) AS mean FROM lineitem WHERE l_suppkey IS NOT NULL
GROUP BY l_suppkey ORDER BY avg(l_quantity) DESC NULLS LAST, l_suppkey ASC NULLS LAST LIMIT 15
""")
def top_groups_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_groups(table(spark, sf_dir, "lineitem"), "l_suppkey",
                           "l_quantity").withColumn("mean", F.round("mean", 6))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5(concat('42:', CAST(o_orderkey AS VARCHAR(20)))), o_orderkey LIMIT 1500
""")
def sample_xy_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"],
                       ["o_orderkey", "o_custkey", "o_totalprice"], 1500, 42)


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
ORDER BY md5(concat('43:', CAST(o_orderkey AS VARCHAR(20)))), o_orderkey LIMIT 1500
""")
def sample_xy_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"],
                       ["o_orderkey", "o_totalprice", "o_orderpriority"], 1500, 43)


@query("""
WITH best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS LAST, p_partkey ASC NULLS LAST) AS rn
  FROM part WHERE p_name IS NOT NULL AND p_brand IS NOT NULL) t WHERE rn = 1)
SELECT p_brand, round(avg(p_size), 6) AS mean FROM best
GROUP BY p_brand ORDER BY avg(p_size) DESC NULLS LAST, p_brand ASC NULLS LAST LIMIT 15
""")
def top_groups_of_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, keep the best row per name, rank the brands: the flow end to end."""
    complete = drop_incomplete(table(spark, sf_dir, "part"), ["p_name", "p_brand"])
    best = keep_best(complete, ["p_name"], ["p_size"], ["p_partkey"])
    return topk.top_groups(best, "p_brand", "p_size").withColumn("mean", F.round("mean", 6))
