"""Pages of an ordered table by their number: stored ranges and a directory of their counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..sources.parquet import read_parquet

RANGE = "__range"
#: Ranges whose counts are summed together before the sums of such blocks are.
BLOCK = 1024


def _order(schema: T.StructType, order_by: Sequence[str]) -> list:
    """The order of the pages: as asked for, then by every other column that has one, so that
    pages do not depend on how rows are stored."""
    rest = [f.name for f in schema if f.name not in order_by
            and not isinstance(f.dataType, (T.MapType, T.VariantType, T.StructType, T.ArrayType))]
    return [col(c).asc_nulls_last() for c in [*order_by, *rest]]


@dataclass(frozen=True)
class Pages:
    """Rows stored by range of the order, and a directory (range, n, first) of them."""

    rows: DataFrame
    directory: DataFrame
    order_by: tuple[str, ...]

    def page(self, number: int, size: int) -> DataFrame:
        """The rows ``number * size`` onwards, at most ``size``; reads the ranges that hold them only."""
        start = number * size
        # As many rows as a page touches ranges.
        held = self.directory.where((F.col("first") < start + size)
                                    & (F.col("first") + F.col("n") > start)).collect()
        if not held:
            return self.rows.drop(RANGE).limit(0)
        rows = self.rows.where(F.col(RANGE).isin([r[RANGE] for r in held]))
        skip = start - min(r["first"] for r in held)
        plain = rows.drop(RANGE)
        return plain.orderBy(*_order(plain.schema, self.order_by)).offset(skip).limit(size)


def store_pages(df: DataFrame, order_by: Sequence[str], path: str, ranges: int) -> Pages:
    """Write the rows under ``path`` in ``ranges`` ranges of the order and count each of them.

    One range partitioning of the rows, which a page then never sorts as a whole. Prefix sums come
    in two levels, inside blocks of ranges and over the few blocks, so no window spans them all.
    """
    spark = df.sparkSession
    order = _order(df.schema, order_by)
    (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .withColumn(RANGE, F.spark_partition_id()).write.partitionBy(RANGE).parquet(f"{path}/rows"))
    schema = T.StructType([*df.schema.fields, T.StructField(RANGE, T.IntegerType())])
    rows = read_parquet(spark, f"{path}/rows", schema)
    counts = (rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("block", F.floor(F.col(RANGE) / BLOCK)))
    inside = Window.partitionBy("block").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n")).agg(
        F.array_agg(F.struct("block", "n"))).scalar()
    before = F.aggregate(F.filter(F.col("__blocks"), lambda b: b["block"] < F.col("block")),
                         F.lit(0).cast("bigint"), lambda total, b: total + b["n"])
    directory = (counts.withColumn("__blocks", blocks)
                 .select(RANGE, "n", (F.coalesce(F.sum("n").over(inside), F.lit(0)) + before).alias("first")))
    directory.write.parquet(f"{path}/directory")
    return Pages(rows, read_parquet(spark, f"{path}/directory", directory.schema), tuple(order_by))
