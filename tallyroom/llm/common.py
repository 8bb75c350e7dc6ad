"""Shared pieces of the corpus operators: words, text batches, tables written for reuse."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: A word is a run without space, tab, line feed, vertical tab, form feed, carriage return.
#: On UTF-8 bytes that is exactly ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one step inside a task holds in Python at a time (one text at least).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: For rows of several MB: a row group and a page for every row, no dictionary and no least and
#: largest values, which would be copies of whole rows. Else a page takes up to 100 rows and a
#: reader all rows of a group at once.
_ALONE = {"parquet.block.row.count.limit": 1, "parquet.enable.dictionary": False,
          "parquet.column.statistics.enabled": False}


def written(df: DataFrame, label: str, compact: bool = False, alone: bool = False) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read these files, not the
    steps before. The folder goes when the driver's JVM ends. ``compact``: for narrow
    rows; the last stage runs in two tasks per core of the cluster, not in one per shuffle
    partition, so a small result is not spread over as many files. ``alone``: for rows of
    several MB; writers and readers then hold one row at a time.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if compact:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    df.write.options(**_ALONE if alone else {}).parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forgotten(df: DataFrame) -> None:
    """Delete the folder of a frame from ``written`` that nothing reads any more."""
    files = df.inputFiles()
    if files:
        removed(df.sparkSession, files[0].rsplit("/", 1)[0])


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a query when it ends: for rounds of queries whose
    results are all written, so that disk does not grow with the rounds."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """The frame itself, for tasks that take whole texts: a batch is then limited by its bytes,
    not only by 10,000 rows, which would hold hundreds of MB of long texts. A limit that the
    user has set stays."""
    spark = df.sparkSession
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{column}`").cast("string")), F.lit(divisor)).cast("int")


#: Bits of the map that ``perhaps_named`` broadcasts: half a megabyte.
NAME_BITS = 1 << 22


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no column that is spelt like it in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(column) -> Iterator[bytes]:
    """The texts of an Arrow column as bytes, whether they are UTF-8 or not; null as empty."""
    import pyarrow as pa

    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    for text in column:
        value = text.as_py()
        yield b"" if value is None else value if isinstance(value, bytes) else str(value).encode()


def perhaps_named(rows: DataFrame, key: str, named: DataFrame, flag: str) -> DataFrame:
    """``rows`` and a column ``flag``, false only where the key is none of ``named``.

    ``named`` has one column. Its hashes are set in a map of ``NAME_BITS`` bits, which is broadcast:
    the size is fixed, and with more names the answer is only less sharp. So a join of
    whole texts with few names need not send the other texts to the shuffle.
    """
    def bit(column: Column) -> Column:
        return F.pmod(F.xxhash64(column.cast("bigint")), F.lit(NAME_BITS))

    name = F.col(f"`{named.columns[0]}`")
    place, of, word, marks = unused(rows, "__place", "__of", "__word", "__marks")
    marked = (named.select(bit(name).alias("bit"))
              .groupBy(F.floor(F.col("bit") / 64).cast("int").alias(word))
              .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias(marks)))
    own = bit(F.col(f"`{key}`"))
    here = F.expr(f"shiftright(`{marks}`, `{place}`) & 1L = 1")
    # At most NAME_BITS / 64 rows.
    return (rows.withColumn(place, (own % 64).cast("int"))
            .withColumn(of, F.floor(own / 64).cast("int"))
            .join(F.broadcast(marked), F.col(of) == F.col(word), "left")
            .select(*[F.col(f"`{c}`") for c in rows.columns],
                    F.coalesce(here, F.lit(False)).alias(flag)))


def slices(batches: Iterable, text: int = -1) -> Iterator[tuple[list, ...]]:
    """Arrow batches as column lists, cut so that a piece holds SLICE_BYTES of text.

    ``text``: the position of the bytes column that is measured. A single longer
    text comes alone, whole.
    """
    import pyarrow.compute as pc

    for batch in batches:
        columns = batch.columns
        sizes = pc.fill_null(pc.binary_length(columns[text]), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > SLICE_BYTES:
                yield tuple(c.slice(start, i - start).to_pylist() for c in columns)
                start, held = i, 0
            held += size
        if len(sizes) > start:
            yield tuple(c.slice(start).to_pylist() for c in columns)
