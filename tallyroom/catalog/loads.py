"""Queries on what can go wrong with a load, and on the layout of served rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Column, Table
from ..errors import MissingColumnsError
from ..operators.aliases import place_by_pattern
from ..operators.clean import require_columns
from ..operators.filters import filter_rows
from ..operators.layout import clustered
from ..operators.paging import store_pages
from ..operators.quality import fingerprint
from ..plans.quarantine import quarantine
from ..plans.stages import build_stages, folder_of, manifest
from ..session import scratch_dir
from ..sinks.parquet import write_parquet
from ..sinks.versions import VersionedSink
from ..sources.delimited import malformed_rows, read_with_records
from ..sources.parquet import read_parquet
from ..sources.statistics import stored_bounds, stored_rows
from .registry import query, table
from .storage import LINES, ORDER_COLUMNS, fresh_names

#: What the columns of ``loaded_orders`` must be.
LOADED = Table("orders_loaded", "", (
    Column("o_orderkey", "bigint"), Column("o_custkey", "int"), Column("o_orderstatus", "string", 1),
    Column("o_orderpriority", "string", 8)), ("o_orderkey",))

# Orders as they might arrive: some without a key, some twice, customers that are no number.
_LOADED_SQL = """
loaded AS (
    SELECT CASE WHEN o_orderkey % 29 = 3 THEN NULL ELSE o_orderkey END AS k,
           CASE WHEN o_custkey % 31 = 7 THEN 'no ' || o_custkey::VARCHAR ELSE o_custkey::VARCHAR END AS c,
           o_orderstatus AS s, o_orderpriority AS p FROM orders
    UNION ALL SELECT o_orderkey, o_custkey::VARCHAR, o_orderstatus, o_orderpriority
    FROM orders WHERE o_orderkey % 41 = 5)"""


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
        "o_orderpriority")
    damaged = orders.withColumns({
        "o_orderkey": F.when(F.col("o_orderkey") % 29 != 3, F.col("o_orderkey")),
        "o_custkey": F.when(F.col("o_custkey").cast("bigint") % 31 == 7,
                            F.concat(F.lit("no "), F.col("o_custkey"))).otherwise(F.col("o_custkey"))})
    return damaged.unionByName(orders.where("o_orderkey % 41 = 5"))


@query(f"""
WITH {_LOADED_SQL},
marked AS (
    SELECT *, concat_ws('; ',
        CASE WHEN k IS NULL THEN 'o_orderkey is null' END,
        CASE WHEN c LIKE 'no %' THEN 'o_custkey is no int: ' || c END,
        CASE WHEN length(p) > 8 THEN 'o_orderpriority is longer than 8' END,
        CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN 'key is repeated' END) AS reasons
    FROM loaded)
SELECT k AS o_orderkey, TRY_CAST(c AS INTEGER) AS o_custkey, p AS o_orderpriority, reasons
FROM marked
UNION ALL SELECT count(*) FILTER (reasons = ''), count(*)::INTEGER, 'good of read', 'counted' FROM marked
""")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected rows of a damaged load, and how many the write counted."""
    found = quarantine(loaded_orders(spark, sf_dir), LOADED, scratch_dir(spark, "quarantine"))
    shown = ["o_orderkey", "o_custkey", "o_orderpriority"]
    counted = spark.createDataFrame(
        [(found.n_good, found.n_read, "good of read", "counted")],
        "o_orderkey bigint, o_custkey int, o_orderpriority string, reasons string")
    return (found.good.select(*shown, F.lit("").alias("reasons"))
            .unionByName(found.rejected.select(*shown, F.concat_ws("; ", "reasons").alias("reasons")))
            .unionByName(counted))


_CSV_HEADER = "o_orderkey,o_custkey,o_orderstatus,o_orderpriority"


@query("""
WITH lines AS (
    SELECT o_orderkey, concat_ws(',', o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE o_orderpriority END,
        CASE WHEN o_orderkey % 23 = 6 THEN 'one more' END) AS line,
        (o_orderkey % 19 = 4) <> (o_orderkey % 23 = 6) AS bad FROM orders)
SELECT line AS record, 1::BIGINT AS n FROM lines WHERE bad
UNION ALL SELECT 'rows read', count(*) FROM lines
""")
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole records of rows with a field too few or too many, and the rows read."""
    path = scratch_dir(spark, "ragged")
    key = F.col("o_orderkey")
    line = F.concat_ws(",", key, "o_custkey", "o_orderstatus",
                       F.when(key % 19 != 4, F.col("o_orderpriority")),
                       F.when(key % 23 == 6, F.lit("one more")))
    # As one column whose name is the header and whose separator never occurs.
    (table(spark, sf_dir, "orders").select(line.alias(_CSV_HEADER))
     .write.option("header", True).option("sep", "\x01").csv(path))
    rows = read_with_records(spark, path)
    bad = malformed_rows(rows).select("record", F.lit(1).cast("bigint").alias("n"))
    read = rows.agg(F.lit("rows read").alias("record"), F.count(F.lit(1)).alias("n"))
    return bad.unionByName(read)


#: Files that the clustered rows are dealt to.
CLUSTERED_FILES = 16


@query("SELECT * FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'R'")
def clustered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered rows of a table that is stored in Z-order of the two filter columns."""
    path = scratch_dir(spark, "clustered")
    rows = table(spark, sf_dir, "lineitem")
    write_parquet(clustered(rows, ["l_returnflag", "l_quantity"], CLUSTERED_FILES), path)
    return filter_rows(read_parquet(spark, path, rows.schema), {"l_quantity": (10, 20)},
                       {"l_returnflag": "R"})


@query("SELECT s_suppkey, s_name FROM supplier")
def missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two optional sources, of which one is not there and skipped."""
    found = [read_parquet(spark, path, on_missing="skip")
             for path in (f"{sf_dir.rstrip('/')}/supplier.parquet", scratch_dir(spark, "nothing"))]
    (rows,) = [df for df in found if df is not None]
    return rows.select("s_suppkey", "s_name")


@query("SELECT count(*) AS n, 0::BIGINT AS n_missing FROM nation")
def empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing source reads as no rows of its schema, so the flow behind it runs."""
    nation = table(spark, sf_dir, "nation")
    none = read_parquet(spark, scratch_dir(spark, "nothing"), nation.schema, on_missing="empty")
    both = nation.withColumn("__n", F.lit(1)).unionByName(none.withColumn("__n", F.lit(0)))
    return both.agg(F.count_if(F.col("__n") == 1).alias("n"), F.count_if(F.col("__n") == 0).alias("n_missing"))


@query("""
SELECT name, (SELECT count(*) FROM region) AS n_rows
FROM (VALUES ('population'), ('area')) AS t(name)
""")
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All missing columns are named in one error, before any row is read."""
    rows = table(spark, sf_dir, "region")
    try:
        require_columns(rows, ["r_name", "population", "r_regionkey", "area"])
        named = []
    except MissingColumnsError as error:
        named = str(error).split(": ", 1)[1].split(", ")
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.lit(n) for n in named])).alias("name"), "n_rows")


#: Ranges that the pages are stored in, and rows of a page.
PAGE_RANGES, PAGE_ROWS = 12, 50


@query(f"""
WITH numbered AS (
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place,
           count(*) OVER () AS n FROM orders)
SELECT page, o_orderkey, o_totalprice FROM numbered
JOIN (SELECT unnest(['first', 'middle', 'last']) AS page) AS pages
  ON place // {PAGE_ROWS} = CASE page WHEN 'first' THEN 0
     WHEN 'middle' THEN (n // {PAGE_ROWS}) // 2 ELSE (n - 1) // {PAGE_ROWS} END
""")
def rows_page_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first, the middle and the last page of all orders by price."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    pages = store_pages(orders, ["o_totalprice"], scratch_dir(spark, "pages"), PAGE_RANGES)
    n = pages.directory.agg(F.sum("n")).first()[0]
    out = None
    for name, number in (("first", 0), ("middle", n // PAGE_ROWS // 2), ("last", (n - 1) // PAGE_ROWS)):
        part = pages.page(number, PAGE_ROWS).select(F.lit(name).alias("page"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
WITH best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_partkey, l_suppkey, l_returnflag) AS rn FROM lineitem) t WHERE rn = 1)
SELECT 'line_master' AS stage, count(*) AS n, true AS unchanged, 0::BIGINT AS n_after_loss FROM best
UNION ALL SELECT 'line_metadata', count(*), true, 0 FROM best
UNION ALL SELECT 'supplier_metadata', count(DISTINCT l_suppkey), true, 0 FROM best
""")
def stage_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says of each stage, whether the stored rows still are those, and how many of them
    a fingerprint without its first rows would still match (none)."""
    root = scratch_dir(spark, "stages")
    build_stages(spark, table(spark, sf_dir, "lineitem"), LINES, root)
    known = manifest(spark, root)
    out = []
    for t in LINES.tables:
        rows = read_parquet(spark, folder_of(root, t))
        least = rows.agg(F.min(t.key[-1])).first()[0]
        fewer = fingerprint(rows.where(F.col(t.key[-1]) != least))
        out.append((t.name, known[t.name][0].n, fingerprint(rows) == known[t.name][0],
                    fewer.n if fewer == known[t.name][0] else 0))
    return spark.createDataFrame(out, "stage string, n bigint, unchanged boolean, n_after_loss bigint")


class _Killed(BaseException):
    """The end of a driver, which no handler sees."""


class _DiesBetweenViews(VersionedSink):
    """A driver that ends when the first view shows its new version."""

    def run(self, statement: str) -> None:
        super().run(statement)
        raise _Killed


@query("""
WITH loads AS (
    SELECT 'first' AS load, * FROM orders UNION ALL SELECT 'second', * FROM orders WHERE o_orderstatus = 'F'),
shown AS (SELECT * FROM (VALUES ('first', 'orders', 'first'), ('first', 'prices', 'first'),
    ('killed', 'orders', 'second'), ('killed', 'prices', 'first'),
    ('recovered', 'orders', 'second'), ('recovered', 'prices', 'second')) AS t(moment, served, load))
SELECT moment, served, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum, 'finished' AS recovery
FROM shown JOIN loads USING (load) GROUP BY moment, served
""")
def publish_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two served tables after a load, after a second one that ends between its views, and recovered."""
    columns = {"orders": ORDER_COLUMNS, "prices": [c for c in ORDER_COLUMNS if c.name in (
        "o_orderkey", "o_totalprice")]}
    tables = fresh_names(tuple(Table(f"{name}_switched", "", tuple(cs), ("o_orderkey",))
                               for name, cs in columns.items()))
    journal, root = scratch_dir(spark, "journal"), scratch_dir(spark, "versions")
    rows = table(spark, sf_dir, "orders")
    moments: list[DataFrame] = []

    def look(moment: str, recovery: str = "finished") -> None:
        for name, t in zip(columns, tables, strict=True):
            moments.append(spark.table(sink.name_of(t)).agg(
                F.lit(moment).alias("moment"), F.lit(name).alias("served"),
                F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"),
                F.lit(recovery).alias("recovery")))

    def load(kind: type[VersionedSink], df: DataFrame) -> None:
        loader = kind(spark, journal, root)
        for t in tables:
            loader.stage(df.select(*t.names), t, "")
        loader.commit()

    sink = VersionedSink(spark, journal, root)
    load(VersionedSink, rows)
    look("first")
    try:
        load(_DiesBetweenViews, rows.where("o_orderstatus = 'F'"))
    except _Killed:
        look("killed")
    look("recovered", sink.recover())
    for t in tables:
        sink.remove(t)
    out = moments[0]
    for part in moments[1:]:
        out = out.unionByName(part)
    return out


# Names as people might write them: by the remainder of the customer's key, from the name NATION_<i>.
_NAME_FORMS = ("NATION_{}", "  nation-{} ", "NTION_{}", "Republic of Nation {}", "Nat. {}", "{}, NATIONS",
               "Atlantis {}", "Nation")


@query(f"""
WITH named AS (
    SELECT n_nationkey AS k, c_custkey % {len(_NAME_FORMS)} AS form, replace(n_name, 'NATION_', '') AS i
    FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CASE form {' '.join(f"WHEN {f} THEN replace('{text}', '{{}}', i)" for f, text in enumerate(_NAME_FORMS))}
       END AS name, CASE WHEN form < 6 THEN k END AS n_nationkey, count(*) AS n
FROM named GROUP BY 1, 2
""")
def region_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by the name of their nation as written, and the nation it is found to be."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("pattern"))
    number = F.replace("pattern", F.lit("NATION_"), F.lit(""))
    form = F.col("c_custkey") % len(_NAME_FORMS)
    name = F.lit(None).cast("string")
    for f, text in enumerate(_NAME_FORMS):
        name = F.when(form == f, F.replace(F.lit(text), F.lit("{}"), number)).otherwise(name)
    counts = (table(spark, sf_dir, "customer")
              .join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
              .groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n")))
    return place_by_pattern(counts, nation, "name", "n_nationkey")


@query("""
SELECT 'price' AS name, CAST(trunc(min(l_extendedprice)) AS BIGINT) AS lo,
       CAST(trunc(max(l_extendedprice)) AS BIGINT) AS hi, count(*) AS n FROM lineitem
UNION ALL SELECT 'size', min(p_size)::BIGINT, max(p_size)::BIGINT, count(*) FROM part
UNION ALL SELECT 'key', min(o_orderkey)::BIGINT, max(o_orderkey)::BIGINT, count(*) FROM orders
""")
def value_bounds_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and row counts of stored tables, from the footers of their files."""
    out = None
    for name, stored, value in (("price", "lineitem", "l_extendedprice"), ("size", "part", "p_size"),
                                ("key", "orders", "o_orderkey")):
        path = f"{sf_dir.rstrip('/')}/{stored}.parquet"
        part = stored_bounds(spark, path, value).select(
            F.lit(name).alias("name"), "lo", "hi",
            F.lit(stored_rows(spark, path)).cast("bigint").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out
