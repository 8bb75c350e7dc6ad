"""Row-level queries: clean, dedupe, project, conform, check, filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Column, Contract, Table
from ..operators.clean import clean, conform
from ..operators.dedupe import distinct_rows, keep_best, keep_ranked
from ..operators.filters import emptiness, filter_rows, page
from ..operators.quality import contract_report, key_violations, length_violations
from ..plans.stages import load_audit as audit, served_rows
from .registry import query, table

_NAME = Column("short_name", "string", 100)
_CLUB = Column("club_name", "string", 100)
_RATING = Column("overall", "int")
_VALUE = Column("value_num", "double")

PART_CLEANING = Contract(
    headers={"p_name": "short_name", "p_brand": "club_name", "p_size": "overall",
             "p_retailprice": "value_num"},
    columns=(_NAME, _CLUB, _RATING, _VALUE),
    required=("short_name", "club_name", "value_num"),
    key=("short_name",), highest=("overall",), cleaned_folder="stage1/parts", tables=())


def with_gaps(df: DataFrame) -> DataFrame:
    """Part rows with some values unknown; the test tables hold no nulls."""
    return df.withColumns({
        "p_name": F.nullif("p_name", F.lit("small ring")),
        "p_brand": F.nullif("p_brand", F.lit("Brand#7")),
        "p_size": F.nullif("p_size", F.lit(50)),
        "p_retailprice": F.when(F.col("p_retailprice") == 900.0, F.lit(float("nan")))
                          .otherwise(F.col("p_retailprice")),
    })


@query("""
SELECT p_name AS short_name, p_brand AS club_name, nullif(p_size, 50) AS overall,
       p_retailprice AS value_num
FROM part
WHERE p_name <> 'small ring' AND p_brand <> 'Brand#7' AND p_retailprice <> 900.0
""")
def clean_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(with_gaps(table(spark, sf_dir, "part")), PART_CLEANING)


@query("""
SELECT p_name, p_partkey, p_size, p_brand, p_type, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS LAST, p_partkey ASC NULLS LAST) AS rn FROM part) t
WHERE rn = 1
""")
def dedupe_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_ranked(table(spark, sf_dir, "part"), ["p_name"], ["p_size"], ["p_partkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_partkey, l_suppkey) AS rn FROM lineitem) t
WHERE rn = 1
""")
def dedupe_best_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey")
    return keep_best(rows, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"])


@query("""
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) AS rn FROM lineitem) t
WHERE rn = 1
""")
def dedupe_best_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys for the whole table: each holds a third of the rows."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return keep_best(rows, ["l_returnflag"], ["l_extendedprice"])


PART_MASTER = Table("part_master", "stage2/part_master", (
    Column("p_name", "string", 255), Column("p_brand", "string", 100),
    Column("p_size", "int"), Column("p_retailprice", "double")), ("p_name",),
    sort=("p_brand", "p_size"))
PART_METADATA = Table("part_metadata", "stage3/part_metadata", (
    Column("p_name", "string", 255), Column("p_type", "string", 100),
    Column("p_size", "int")), ("p_name",))
BRAND_METADATA = Table("brand_metadata", "stage3/brand_metadata", (
    Column("p_brand", "string", 100),), ("p_brand",))

PARTS = Contract(
    headers={c: c for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                            "p_retailprice")},
    columns=(Column("p_partkey", "bigint"), Column("p_name", "string", 255),
             Column("p_brand", "string", 100), Column("p_type", "string", 100),
             Column("p_size", "int"), Column("p_retailprice", "double")),
    required=("p_name", "p_brand", "p_retailprice"),
    key=("p_name",), highest=("p_size",), tie_break=("p_partkey",),
    cleaned_folder="stage1/parts", tables=(PART_MASTER, PART_METADATA, BRAND_METADATA))


@query("""
SELECT p_name, p_brand, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS LAST, p_partkey ASC NULLS LAST) AS rn FROM part) t
WHERE rn = 1
""")
def master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = keep_best(table(spark, sf_dir, "part"), PARTS.key, PARTS.highest, PARTS.tie_break)
    return served_rows(best, PARTS, PART_MASTER)


@query("""
WITH complete AS (SELECT p_name FROM part
  WHERE p_name <> 'small ring' AND p_brand <> 'Brand#7' AND p_retailprice <> 900.0)
SELECT a.n AS n_read, a.n - c.n AS n_incomplete, c.n - c.k AS n_duplicate, c.k AS n_kept
FROM (SELECT count(*) AS n FROM part) a
CROSS JOIN (SELECT count(*) AS n, count(DISTINCT p_name) AS k FROM complete) c
""")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, incomplete, duplicate and kept."""
    return audit(with_gaps(table(spark, sf_dir, "part")), PART_CLEANING)


@query("SELECT DISTINCT p_name, p_type, p_size FROM part")
def entity_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "part"), ["p_name", "p_type", "p_size"])


@query("SELECT DISTINCT p_brand AS club_name FROM part WHERE p_brand IS NOT NULL")
def group_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "part"), ["p_brand"], known_only=True).toDF(
        "club_name")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_linenumber AS DOUBLE) AS line_num,
       CAST(l_quantity AS INT) AS quantity, TRY_CAST(l_returnflag AS INT) AS flag_number,
       l_extendedprice AS price
FROM lineitem
""")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widening, narrowing and text that is no number."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_text"), F.col("l_linenumber").alias("line_num"),
        F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag_number"),
        F.col("l_extendedprice").alias("price"))
    return conform(rows, [Column("order_text", "string", 20), Column("line_num", "double"),
                          Column("quantity", "int"), Column("flag_number", "int"),
                          Column("price", "double")])


@query("""
SELECT l_linenumber, 9007199254740993 + l_orderkey AS from_decimal,
       9007199254740993 + l_orderkey AS from_text FROM lineitem
""")
def conform_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers that no double holds, as decimals and as text with a fraction of zero."""
    big = (F.lit(9007199254740993) + F.col("l_orderkey")).cast("decimal(20, 0)")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_linenumber", big.alias("from_decimal"),
        F.concat(big.cast("string"), F.lit(".0")).alias("from_text"))
    return conform(rows, [Column("l_linenumber", "int"), Column("from_decimal", "bigint"),
                          Column("from_text", "bigint")])


@query("""
SELECT * FROM orders WHERE o_totalprice BETWEEN 50000 AND 400000 AND o_orderkey > 500
ORDER BY o_orderkey LIMIT 200
""")
def rows_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page behind the first one, with every column."""
    rows = filter_rows(table(spark, sf_dir, "orders"), {"o_totalprice": (50_000, 400_000)})
    return page(rows, ["o_orderkey"], 200, after=(500,))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT c_custkey, 'c_mktsegment' AS column_name, c_mktsegment AS value,
       CAST(length(c_mktsegment) AS INT) AS len, 8 AS max_len
FROM customer WHERE length(c_mktsegment) > 8
UNION ALL
SELECT c_custkey, 'c_name' AS column_name, c_name AS value,
       CAST(length(c_name) AS INT) AS len, 10 AS max_len
FROM customer WHERE length(c_name) > 10
""")
def length_violations_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_violations(table(spark, sf_dir, "customer"),
                             {"c_mktsegment": 8, "c_name": 10}, ["c_custkey"])


@query("""
SELECT p_partkey, 'p_name' AS column_name, p_name AS value,
       CAST(length(p_name) AS INT) AS len, 10 AS max_len
FROM part WHERE length(p_name) > 10
""", name="length_violations")
def length_violations_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_violations(table(spark, sf_dir, "part"), {"p_name": 10}, ["p_partkey"])


@query("""
SELECT 'unique key' AS "check", (SELECT count(*) FROM (
  SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1) d) AS n_bad
UNION ALL SELECT 'length of p_name over 10', count(*) FROM part WHERE length(p_name) > 10
UNION ALL SELECT 'length of p_brand over 100', count(*) FROM part WHERE length(p_brand) > 100
""")
def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = Table("part", "part", (Column("p_name", "string", 10),
                                    Column("p_brand", "string", 100)), ("p_name",))
    return contract_report(table(spark, sf_dir, "part"), strict)


@query("SELECT * FROM part WHERE p_size >= 10 AND p_size <= 40 AND p_type = 'PROMO'")
def filtered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_rows(table(spark, sf_dir, "part"), {"p_size": (10, 40)}, {"p_type": "PROMO"})


@query("""
SELECT * FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.05
  AND l_returnflag = 'R'
""")
def filtered_rows_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_rows(table(spark, sf_dir, "lineitem"),
                       {"l_quantity": (10, 20), "l_discount": (0.02, 0.05), "l_tax": None},
                       {"l_returnflag": "R", "l_linestatus": None})


@query("""
SELECT 'every row' AS subset, (SELECT count(*) FROM lineitem) = 0 AS is_empty
UNION ALL SELECT 'quantity over range',
  (SELECT count(*) FROM lineitem WHERE l_quantity BETWEEN 1000 AND 2000) = 0
""")
def is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    none = filter_rows(rows, {"l_quantity": (1000, 2000)})
    return (emptiness(rows).select(F.lit("every row").alias("subset"), "is_empty")
            .union(emptiness(none).select(F.lit("quantity over range"), "is_empty")))
