"""Delimited files with a header row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Column
from ..operators.clean import conform


def read_delimited(spark: SparkSession, path: str | list[str],
                   columns: Iterable[Column] | None = None, infer: bool = False,
                   multi_line: bool = False, **options: str) -> DataFrame:
    """CSV with quotes escaped by doubling; columns are matched by header name.

    Without ``infer`` the only extra work is one header line: everything is read
    as text and ``columns``, if given, are cast where they are used. A reader
    schema would be matched by position, so a file with other columns in between
    would be read wrongly; inference would scan the whole input twice.

    Headers that differ between files are an error, not a silent shift.
    ``multi_line`` keeps line breaks inside quotes but makes each file one task.

    Rows with too few fields get nulls and surplus fields are cut, as the reader does;
    ``read_with_records`` tells which rows these are and what stood there.
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", multi_line).option("inferSchema", infer)
              .option("enforceSchema", False).options(**options))
    df = reader.csv(path)
    return df if columns is None else conform(df, columns)


#: Columns that ``read_with_records`` adds: the file, and the whole record of a malformed row.
SOURCE, RECORD = "__source", "__record"


def read_with_records(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                      **options: str) -> DataFrame:
    """All columns as text in header order, the file as ``SOURCE``, and as ``RECORD`` the text
    of a malformed row, null for any other.

    Malformed is a row with more or fewer fields than the header. Every field is parsed, since
    a reader that skips columns does not see them missing.
    """
    header = read_delimited(spark, path, multi_line=multi_line, **options).schema
    reader = (spark.read.schema(T.StructType(header.fields).add(RECORD, "string")).option("header", True)
              .option("escape", '"').option("multiLine", multi_line)
              .option("enforceSchema", False).option("columnPruning", False)
              .option("columnNameOfCorruptRecord", RECORD).options(**options))
    # Spark refuses to read the record without any field, so it is tied to the first one.
    first = F.col("`" + header.names[0].replace("`", "``") + "`")
    record = F.when(first.isNull() | (F.length(first) >= 0), F.col(RECORD))
    return (reader.csv(path).withColumn(SOURCE, F.col("_metadata.file_path"))
            .withColumn(RECORD, record))


def malformed_rows(rows: DataFrame) -> DataFrame:
    """(source, record): the malformed rows of ``read_with_records``, whole."""
    return (rows.where(F.col(RECORD).isNotNull())
            .select(F.col(SOURCE).alias("source"), F.col(RECORD).alias("record")))
