"""Line deduplication on levelled sorted runs of line hashes, without Python on the executors.

A run is a table of (h1, h2, doc): 128-bit hashes of line keys, each with the first document that
holds the line, in hash buckets that are sorted inside. A batch of documents reduces its lines
to one row per hash, merge-anti-joins the runs bucket by bucket (the runs are not shuffled
again), and what is left, the lines never seen before, becomes a run of level 0. ``FAN_OUT`` runs of a
level are compacted into one of the next, so there are few runs to join however many batches
have come. Batches come in ascending order of id; so a run names the smallest id of each key, and
a line stays exactly where (hash, document) stands in a run.

``dedup_lines`` deals a whole table to ``BATCHES`` batches by quantiles of the id. Lines meet
in shuffles by hash after a combination in the map tasks, and by (hash, document) afterwards: a line that
a third of all documents hold is no hot key in either. Only positions of dropped lines travel
to the texts.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of
fewer than ``LEAST_CHARS`` code points are never dropped. Lines whose 128 bits agree count as
equal.

Defined results: a null or empty text is one empty line; rows that share an id are one
document, of which every row keeps what the document keeps; rows with a null id are one document
after all others; a text that loses every line is empty; bytes that are no UTF-8 come out as
U+FFFD; an empty table gives no rows. Ids are whole numbers. Only the two named columns
are read, so clashing names cannot matter.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import forgotten, removed, written

LEAST_CHARS = 10
BATCHES = 4
#: Runs of one level that are compacted into a run of the next.
FAN_OUT = 3
SPACE = " \t\n\x0b\x0c\r"

_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line stripped and with A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is that of Unicode; among ASCII characters both are the same.
    return (F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare))
            .otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text, part): ``part`` only tells different texts of one document apart."""
    return (docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
            .withColumn("part", F.xxhash64("text")))


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, part, pos, h1, h2) of every line whose key is long enough; ``pos`` from 0."""
    lines = _rows(docs, id_col, text_col).select(
        "doc", "part", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc", "part", "pos", line_key(F.col("line")).alias("key"))
    return (keys.where(F.char_length("key") >= least_chars)
            .select("doc", "part", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), "key").alias("h2")))


class LineRuns:
    """The runs seen so far, as bucketed tables in the shared scratch folder until ``close``."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        # As many as a shuffle has partitions: then the rows of an aggregate are in their buckets.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    @property
    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _store(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
         .option("path", scratch_dir(self.spark, "line-run")).saveAsTable(name))
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fan_out:
            self.compact(level)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            files = self.spark.table(name)
            forgotten(files)
            self.spark.sql(f"DROP TABLE {name}")

    def compact(self, level: int) -> None:
        """Merge the runs of a level into one run of the next."""
        names = self.levels[level]
        merged = self.seen(names).groupBy(*_HASH).agg(F.min("doc").alias("doc"))
        self.levels[level] = []
        self._store(merged, level + 1)
        self._drop(names)

    def seen(self, names: list[str] | None = None) -> DataFrame:
        """(h1, h2, doc) of all runs: every key once, with its first document."""
        rows = self.spark.createDataFrame([], "h1 bigint, h2 bigint, doc bigint")
        for name in self.tables if names is None else names:
            rows = rows.unionByName(self.spark.table(name))
        return rows

    def fresh(self, lines: DataFrame) -> DataFrame:
        """(h1, h2, doc): the keys of ``lines`` that no run holds, with their first document."""
        own = lines.groupBy(*_HASH).agg(F.min("doc").alias("doc"))
        for name in self.tables:
            own = own.join(self.spark.table(name).select(*_HASH).hint("merge"), _HASH, "left_anti")
        return own

    def add(self, lines: DataFrame) -> None:
        """Take in a batch, whose ids must not be smaller than those of the batches before."""
        self._store(self.fresh(lines), 0)

    def close(self) -> None:
        self._drop(self.tables)
        self.levels = []


def batch_of(docs: DataFrame, id_col: str, batches: int) -> Column:
    """The batch of ``doc``, by quantiles of the ids; null ids belong to the last one."""
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.select(F.percentile_approx(F.col(f"`{id_col}`").cast("bigint"),
                                             shares, 1000)).first()[0] if shares else None
    batch = F.lit(0)
    for bound in sorted(bounds or []):
        batch = batch + (F.col("doc") > bound).cast("int")
    return F.coalesce(batch, F.lit(batches - 1))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_chars: int = LEAST_CHARS, batches: int = BATCHES,
                  fan_out: int = FAN_OUT) -> DataFrame:
    """(doc, part, gone): the sorted positions of the lines that each text loses."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "line-hashes")
    (hashed_lines(docs, id_col, text_col, least_chars)
     .withColumn("batch", batch_of(docs, id_col, batches)).write.partitionBy("batch").parquet(path))
    lines = spark.read.schema("doc bigint, part bigint, pos int, h1 bigint, h2 bigint, "
                              "batch int").parquet(path)
    runs = LineRuns(spark, fan_out=fan_out)
    try:
        for batch in range(batches):
            runs.add(lines.where(F.col("batch") == batch))
        first = runs.seen().withColumnRenamed("doc", "owner")
        same = ((lines["h1"] == first["h1"]) & (lines["h2"] == first["h2"])
                & lines["doc"].eqNullSafe(first["owner"]))
        gone = (lines.join(first, same, "left_anti").groupBy("doc", "part")
                .agg(F.array_sort(F.collect_set("pos")).alias("gone")))
        return written(gone, "lines-gone")
    finally:
        runs.close()
        removed(spark, path)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS, batches: int = BATCHES,
                fan_out: int = FAN_OUT) -> DataFrame:
    """Per row of ``docs``: id, kept (the text that stays), n_lines, n_dropped."""
    gone = dropped_lines(docs, id_col, text_col, least_chars, batches, fan_out)
    gone = gone.select(F.col("doc").alias("of"), F.col("part").alias("of_part"), "gone")
    rows = _rows(docs, id_col, text_col)
    joined = rows.join(gone, rows["doc"].eqNullSafe(gone["of"])
                       & (rows["part"] == gone["of_part"]), "left")
    # What stays are the stretches between dropped lines: linear in the number of lines.
    cuts = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines")))
    stays = F.expr("flatten(transform(sequence(0, size(cuts) - 2), i -> slice(lines, cuts[i] + 2, "
                   "cuts[i + 1] - cuts[i] - 1)))")
    return (joined.withColumn("lines", F.split("text", "\n")).withColumn("cuts", cuts)
            .select(F.col("doc").alias("id"),
                    F.when(F.col("gone").isNull(), F.col("text"))
                    .otherwise(F.array_join(stays, "\n")).alias("kept"),
                    F.size("lines").cast("bigint").alias("n_lines"),
                    F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
                    .cast("bigint").alias("n_dropped")))
