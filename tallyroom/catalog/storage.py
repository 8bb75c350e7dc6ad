"""Queries that write and read back: files, archives, tables, stages, dashboard.

Each one derives its files from a test table, into a new folder under the shared
scratch folder of the session, and returns what it reads back.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Column, Contract, Table
from ..plans.dashboard import Dashboard, Roles, long_form
from ..plans.publish import publish
from ..plans.stages import build_stages, folder_of
from ..session import scratch_dir
from ..sinks.parquet import write_parquet
from ..sinks.tables import TableSink
from ..sources import archive
from ..sources.delimited import read_delimited
from ..sources.parquet import read_parquet
from .registry import query, table
from .rows import PARTS

ORDER_COLUMNS = [Column("o_orderkey", "bigint"), Column("o_custkey", "bigint"),
                 Column("o_orderstatus", "string", 1), Column("o_totalprice", "double"),
                 Column("o_orderpriority", "string", 20)]
_ORDER_NAMES = [c.name for c in ORDER_COLUMNS]
_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"

LINES = Contract(
    headers={c: c for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                            "l_extendedprice", "l_returnflag")},
    columns=(Column("l_orderkey", "bigint"), Column("l_linenumber", "int"),
             Column("l_partkey", "bigint"), Column("l_suppkey", "bigint"),
             Column("l_quantity", "double"), Column("l_extendedprice", "double"),
             Column("l_returnflag", "string", 10)),
    required=("l_orderkey", "l_linenumber", "l_extendedprice"),
    key=("l_orderkey", "l_linenumber"), highest=("l_quantity", "l_extendedprice"),
    cleaned_folder="stage1/lines",
    tables=(
        Table("line_master", "stage2/line_master",
              (Column("l_orderkey", "bigint"), Column("l_linenumber", "int"),
               Column("l_quantity", "double"), Column("l_extendedprice", "double"),
               Column("l_returnflag", "string", 10)), ("l_orderkey", "l_linenumber"),
              sort=("l_returnflag", "l_quantity")),
        Table("line_metadata", "stage3/line_metadata",
              (Column("l_orderkey", "bigint"), Column("l_linenumber", "int"),
               Column("l_partkey", "bigint"), Column("l_suppkey", "bigint")),
              ("l_orderkey", "l_linenumber")),
        Table("supplier_metadata", "stage3/supplier_metadata",
              (Column("l_suppkey", "bigint"),), ("l_suppkey",)),
    ))


@query(_ORDER_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    (table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", *_ORDER_NAMES[:4])
     .write.option("header", True).option("escape", '"').csv(path))
    return read_delimited(spark, path, ORDER_COLUMNS)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem
""")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    rows = table(spark, sf_dir, "lineitem")
    write_parquet(rows, path, partition_by=["l_returnflag"], max_records_per_file=5_000_000)
    return read_parquet(spark, path, rows.schema).select(*rows.columns)


def pack_archives(df: DataFrame, out_dir: str) -> None:
    """Write a frame as zip archives of CSV members, one archive per shuffle task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    header = ",".join(df.columns)

    def run(batches):
        import uuid
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}.zip"
        # Spark settings name a local folder without a scheme.
        if "://" in out_dir or out_dir.startswith("file:"):
            system, folder = fs.FileSystem.from_uri(out_dir)
        else:
            system, folder = fs.LocalFileSystem(), out_dir
        system.create_dir(folder, recursive=True)
        # Under its name only once complete: a task that runs again replaces it whole.
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with (system.open_output_stream(partial) as raw,
              zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as packed):
            for i, batch in enumerate(batches):
                lines = [header, *batch.column(0).to_pylist(), ""]
                packed.writestr(f"rows/member-{i:05d}.csv", "\n".join(lines))
        system.move(partial, f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"archive": [name]})

    lines = df.select(F.to_csv(F.struct(*df.columns)).alias("line"))
    (lines.repartition(parts).mapInArrow(run, "archive string")
     .write.format("noop").mode("overwrite").save())


@query("""
SELECT concat_ws(',', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS line
FROM lineitem
""")
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    pack_archives(rows, path)
    return archive.archive_lines(spark, path).where("line_no > 1").select("line")


@query(_ORDER_SQL)
def archive_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    out = scratch_dir(spark, "extracted")
    pack_archives(table(spark, sf_dir, "orders").select(*_ORDER_NAMES), path)
    archive.extract_archives(spark, path, out, folder_per_archive=True)
    return read_delimited(spark, out, ORDER_COLUMNS, recursiveFileLookup="true")


def fresh_names(tables: tuple[Table, ...]) -> tuple[Table, ...]:
    """The tables under names no other run uses in a shared catalogue."""
    run = uuid.uuid4().hex[:12]
    return tuple(replace(t, name=f"{t.name}_{run}") for t in tables)


def _published(spark: SparkSession, sink: TableSink, published: Table,
               others: tuple[Table, ...] = ()) -> DataFrame:
    """The rows of a published table; the catalogue entries are not left behind."""
    df = spark.table(sink.name_of(published))
    for t in (published, *others):
        spark.sql(f"DROP TABLE IF EXISTS {sink.name_of(t)}")
    return df


@query(_ORDER_SQL + " WHERE o_orderstatus = 'F'")
def target_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces the first, rows and definition."""
    (target,) = fresh_names((Table("orders_served", "", tuple(ORDER_COLUMNS), ("o_orderkey",)),))
    sink = TableSink(spark, scratch_dir(spark, "tables"))
    rows = table(spark, sf_dir, "orders").select(*_ORDER_NAMES)
    for load in (rows, rows.where("o_orderstatus = 'F'")):
        sink.stage(load, target, "")
        sink.commit()
    return _published(spark, sink, target)


@query("""
WITH best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS LAST, p_partkey ASC NULLS LAST) AS rn FROM part) t WHERE rn = 1)
SELECT 'cleaned' AS stage, count(*) AS n FROM best
UNION ALL SELECT 'part_master', count(*) FROM best
UNION ALL SELECT 'part_metadata', count(*) FROM best
UNION ALL SELECT 'brand_metadata', count(DISTINCT p_brand) FROM best
""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build_stages(spark, table(spark, sf_dir, "part"), PARTS, scratch_dir(spark, "stages"))
    return spark.createDataFrame(list(rows.items()), "stage string, n bigint")


def _stage_and_publish(spark: SparkSession, source: DataFrame, contract: Contract,
                       copies: str | None = None) -> DataFrame:
    contract = replace(contract, tables=fresh_names(contract.tables))
    root = scratch_dir(spark, "stages")
    build_stages(spark, source, contract, root)
    sink = TableSink(spark, copies)
    publish(spark, contract, root, sink)
    return _published(spark, sink, contract.tables[0], contract.tables[1:])


@query("""
SELECT p_name, p_brand, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS LAST, p_partkey ASC NULLS LAST) AS rn FROM part) t
WHERE rn = 1
""")
def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_and_publish(spark, table(spark, sf_dir, "part"), PARTS,
                              scratch_dir(spark, "tables"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_partkey, l_suppkey, l_returnflag) AS rn FROM lineitem) t
WHERE rn = 1
""")
def staged_publish_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_and_publish(spark, table(spark, sf_dir, "lineitem"), LINES)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_partkey, l_suppkey, l_returnflag) AS rn FROM lineitem) t
WHERE rn = 1
""")
def staged_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third stage, read as its own Parquet folder."""
    root = scratch_dir(spark, "stages")
    build_stages(spark, table(spark, sf_dir, "lineitem"), LINES, root)
    return read_parquet(spark, folder_of(root, LINES.tables[1]))


ORDER_ROLES = Roles(key="o_orderkey", label="o_orderpriority", rating="o_totalprice",
                    potential="o_custkey", value="o_totalprice", age="o_custkey",
                    region="o_orderpriority", category="o_orderstatus", group="o_custkey")


@query("""
WITH f AS (SELECT * FROM orders WHERE o_totalprice BETWEEN 50000 AND 400000),
edges AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_custkey) AS klo,
                 max(o_custkey) AS khi FROM f),
widths AS (SELECT * FROM (VALUES (1.0E0), (2.0E0), (5.0E0), (10.0E0), (20.0E0), (50.0E0),
  (100.0E0), (200.0E0), (500.0E0), (1000.0E0), (2000.0E0), (5000.0E0), (10000.0E0),
  (20000.0E0), (50000.0E0), (100000.0E0)) AS c(w)),
pw AS (SELECT min(w) AS w FROM edges CROSS JOIN widths
       WHERE floor(hi / w) - floor(lo / w) + 1 <= 25),
kw AS (SELECT min(w) AS w FROM edges CROSS JOIN widths
       WHERE floor(khi / w) - floor(klo / w) + 1 <= 25)
SELECT 'count' AS view, 'rows' AS key, CAST(count(*) AS DOUBLE) AS number FROM f
UNION ALL SELECT 'mean', 'rows', round(avg(o_totalprice), 4) FROM f
UNION ALL SELECT * FROM (SELECT 'top_entity', CAST(o_orderkey AS VARCHAR), o_totalprice FROM f
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) t
UNION ALL SELECT 'age_histogram', CAST(CAST(floor(o_custkey / w) AS BIGINT) AS VARCHAR),
  CAST(count(*) AS DOUBLE) FROM f CROSS JOIN kw GROUP BY 2
UNION ALL SELECT 'rating_histogram', CAST(CAST(floor(o_totalprice / w) AS BIGINT) AS VARCHAR),
  CAST(count(*) AS DOUBLE) FROM f CROSS JOIN pw GROUP BY 2
UNION ALL SELECT 'category_shares', k, round(n * 1.0E0 / sum(n) OVER (), 4)
  FROM (SELECT o_orderstatus AS k, count(*) AS n FROM f GROUP BY 1) t
UNION ALL SELECT * FROM (SELECT 'rating_value_sample', o_orderpriority, o_totalprice FROM f
  ORDER BY md5(concat('42:', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 1500) t
UNION ALL SELECT * FROM (SELECT 'age_potential_sample', o_orderpriority,
  CAST(o_custkey AS DOUBLE) FROM f
  ORDER BY md5(concat('43:', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 1500) t
UNION ALL SELECT 'region_counts', o_orderpriority, CAST(count(*) AS DOUBLE) FROM f GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_groups', CAST(o_custkey AS VARCHAR),
  round(avg(o_totalprice), 4) FROM f GROUP BY o_custkey
  ORDER BY avg(o_totalprice) DESC, o_custkey LIMIT 15) t
""")
def dashboard_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view over one kept frame, written out before the frame is released."""
    board = Dashboard(table(spark, sf_dir, "orders"), ORDER_ROLES)
    try:
        views = board.views(rating=(50_000, 400_000))
        one_row = views["summary"].select(F.lit("rows").alias("k"), "n", "mean")
        everything = long_form({
            "count": (one_row, "k", "n"),
            "mean": (one_row.withColumn("mean", F.round("mean", 4)), "k", "mean"),
            "top_entity": (views["top_entity"], "o_orderkey", "o_totalprice"),
            "age_histogram": (views["age_histogram"], "bin", "n"),
            "rating_histogram": (views["rating_histogram"], "bin", "n"),
            "category_shares": (views["category_shares"].withColumn(
                "share", F.round("share", 4)), "k", "share"),
            "rating_value_sample": (views["rating_value_sample"],
                                    "o_orderpriority", "o_totalprice"),
            "age_potential_sample": (views["age_potential_sample"],
                                     "o_orderpriority", "o_custkey"),
            "region_counts": (views["region_counts"], "o_orderpriority", "count"),
            "top_groups": (views["top_groups"].withColumn("mean", F.round("mean", 4)),
                           "o_custkey", "mean"),
        })
        path = scratch_dir(spark, "dashboard")
        write_parquet(everything, path)
    finally:
        board.close()
    return read_parquet(spark, path, everything.schema)
